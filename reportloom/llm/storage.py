"""Intermediate tables and files in the folder that all executors share.

Nothing here is removed by the library, as the tables returned to a caller read from it: whoever owns the folder of
``spark.checkpoint.dir`` clears it after the job.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportloom.session import fresh_folder

Batches = Iterator[pa.RecordBatch]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back: lineage ends there and a lost executor loses nothing."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_places(df: DataFrame, file: str, row: str) -> DataFrame:
    """``df`` and where each row stands: the number of its file in the order of writing, and of the row in it.

    A scan deals files out by size, so this is what is left of an order after a table has been read back. Of a table that
    was not read from files, the number of its partition and the place in it.
    """
    try:
        where = df.metadataColumn("_metadata")
        at, place = where["file_name"], where["row_index"]
        found = df.withColumns({file: F.regexp_extract(at, r"part-(\d+)", 1).cast("long") * 1_000_000
                                + F.coalesce(F.regexp_extract(at, r"-c(\d+)", 1).try_cast("long"), F.lit(0)), row: place})
        _ = found.schema
        return found
    except AnalysisException:
        number = F.monotonically_increasing_id()
        return df.withColumns({file: F.shiftright(number, 33), row: number.bitwiseAND(F.lit((1 << 33) - 1))})


def shared_files(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path for use inside tasks; a path without a scheme is one all tasks see under that name."""
    if not urlparse(path).scheme:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def write_attempt(files: fs.FileSystem, folder: str, suffix: str) -> str:
    """A file name no other attempt of the task uses; only names in a written manifest count, so leftovers of lost
    or repeated attempts are never read."""
    files.create_dir(folder, recursive=True)
    return f"{folder}/part-{uuid.uuid4().hex}{suffix}"


def sliced(batches: Batches, rows: int = 512) -> Batches:
    """The batches in shorter ones, so that few rows at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def rows_of(batches: Batches, *names: str) -> Iterator[tuple]:
    """The named columns of Arrow batches as Python rows; strings come as bytes."""
    for batch in sliced(batches):
        columns = []
        for name in names:
            column = batch.column(name)
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
            columns.append(column.to_pylist())
        yield from zip(*columns, strict=True)


def mapped(df: DataFrame, work: Callable[[Batches], Batches], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` whose workers, which Spark keeps for later tasks, give free memory back at the end of a task."""

    def work_and_tidy(batches: Batches) -> Batches:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, where it has one
        if trim:
            trim(0)

    return df.mapInArrow(work_and_tidy, schema)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048, weight: Callable[[tuple], int] | None = None,
               most: int = 1 << 24) -> Batches:
    """Python rows as Arrow batches of bounded length and, with ``weight``, of bounded bytes."""
    block, heavy = [], 0
    for row in rows:
        block.append(row)
        heavy += weight(row) if weight else 0
        if len(block) >= size or heavy >= most:
            yield _batch(block, schema)
            block, heavy = [], 0
    if block:
        yield _batch(block, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def public_vocabulary(name: str) -> str:
    """Path of a vocabulary of the installed package, the same on every machine that has it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def checksum(df: DataFrame, *columns: str) -> tuple[int, int]:
    """Row count and an order-free sum over hashed rows, to see whether a table still changes."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    return row[0], row[1]
