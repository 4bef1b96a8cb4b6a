"""Folder trees listed level by level.

The folders of a level are a table. Each task takes its share of them and passes on what they hold in bounded batches,
so neither a folder with millions of files nor a tree with millions of folders has to fit anywhere; what was found is
written, and the folders among it are the next level. A lost task lists its own folders again, nothing else.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.session import fresh_folder

ENTRIES = 4096  # rows passed on at once
FOLDERS_A_TASK = 256
FOLDER_ERROR = "folder"  # how errors of folders begin
ENTRY = "path string, size long, error string, is_folder boolean"
SCHEMA = pa.schema([("path", pa.string()), ("size", pa.int64()), ("error", pa.string()), ("is_folder", pa.bool_())])


def split_base(root: str) -> tuple[str, str]:
    """The folder without a trailing slash, and what stands before a file system's own path in a full one."""
    plain = re.sub(r"^file:/+", "/", root.rstrip("/"))
    if not urlparse(plain).scheme:
        return plain, ""
    return plain, plain[: -len(fs.FileSystem.from_uri(plain)[1])]


def file_system(root: str) -> tuple[fs.FileSystem, str]:
    """File system of a folder and its path there."""
    base, _ = split_base(root)
    return fs.FileSystem.from_uri(base) if urlparse(base).scheme else (fs.LocalFileSystem(), base)


def _entries(files: fs.FileSystem, folder: str) -> Iterator[tuple]:
    """What a folder holds, as it is read: links to folders are not followed, broken links are unreadable files."""
    if isinstance(files, fs.LocalFileSystem):  # the general listing leaves out broken links
        with os.scandir(folder) as found:
            for entry in found:
                try:
                    if entry.is_dir(follow_symlinks=False):
                        yield entry.path, 0, None, True
                    elif entry.is_dir():
                        yield entry.path, 0, f"{FOLDER_ERROR}: a link", False
                    else:
                        yield entry.path, entry.stat().st_size, None, False
                except OSError:
                    yield entry.path, 0, "unreadable", False
        return
    for found in files.get_file_info(fs.FileSelector(folder)):
        known = found.type in (fs.FileType.File, fs.FileType.Directory)
        yield found.path, found.size or 0, None if known else "unreadable", found.type == fs.FileType.Directory


def _listed(files: fs.FileSystem, folder: str, top: bool) -> Iterator[tuple]:
    try:
        yield from _entries(files, folder)
    except OSError as problem:
        if top:
            raise
        yield folder, 0, f"{FOLDER_ERROR}: {type(problem).__name__}", False


def _batches(rows: Iterator[tuple], prefix: str) -> Iterator[pa.RecordBatch]:
    block: list[tuple] = []
    for path, *rest in rows:
        block.append((prefix + path, *rest))
        if len(block) == ENTRIES:
            yield _batch(block)
            block = []
    if block:
        yield _batch(block)


def _batch(block: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block), SCHEMA.types)], schema=SCHEMA)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, error) of everything below ``root`` but folders, empty files and broken links included.

    Folders that cannot be read and links to folders, which are not followed, are rows whose error begins with "folder".
    The tree is walked once, when this is called; the table returned is a written one.
    """
    base, prefix = split_base(root)
    top = file_system(base)[1] or "/"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = file_system(base)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                folder = path.removeprefix(prefix)
                yield from _batches(_listed(files, folder, folder == top), prefix)

    level, written = spark.createDataFrame([(prefix + top,)], "path string"), []
    while True:
        written.append(fresh_folder(spark, "listing"))
        level.mapInArrow(step, ENTRY).write.parquet(written[-1])
        folders = spark.read.schema(ENTRY).parquet(written[-1]).where("is_folder").select("path")
        count = folders.count()
        if not count:
            break
        # By hash: neighbouring folders, of which some hold much more than others, come apart.
        level = folders.repartition(min(count, max(spark.sparkContext.defaultParallelism, -(-count // FOLDERS_A_TASK))), "path")
    return spark.read.schema(ENTRY).parquet(*written).where("NOT is_folder").select("path", "size", "error")


def spread_by_size(listed: DataFrame, files_a_task: int = 4096, bytes_a_task: int = 1 << 27) -> DataFrame:
    """Listed files dealt out by hash to as many tasks as their number and size ask for."""
    files, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(listed.sparkSession.sparkContext.defaultParallelism, -(-files // files_a_task), -(-size // bytes_a_task))
    return listed.repartition(max(1, min(tasks, files)), "path")
