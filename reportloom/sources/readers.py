"""Readers for report folders, result tables and prompt files."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Mapping
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.fixed_values import RESULT_COLUMNS, RESULT_FILES
from reportloom.functions.modality import folder_of, path_part
from reportloom.functions.text import or_empty, utf8_dropping_bad_bytes
from reportloom.operators.compiling import ORIGIN, distinct_names, header_union, inference_rows, with_origin
from reportloom.operators.redaction import with_status
from reportloom.sources.listing import FOLDER_ERROR, file_system, list_files, split_base, spread_by_size
from reportloom.sources.runs import read_runs

CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "inferSchema": False,
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
ROWS_AT_ONCE, CHARACTERS_AT_ONCE = 1024, 1 << 22  # CSV rows of a batch
FILES_AT_ONCE, BYTES_AT_ONCE = 1024, 1 << 22  # files of a batch; one that is larger has a batch of its own


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(path, bytes, error) of many small files or a large one at once."""
    block, held = [], 0
    for row in rows:
        size = len(row[1] or b"")
        if block and (len(block) == FILES_AT_ONCE or held + size > BYTES_AT_ONCE):
            yield _batch_of(block, schema)
            block, held = [], 0
        block.append(row)
        held += size
    if block:
        yield _batch_of(block, schema)


def _contents(listed: DataFrame, root: str) -> DataFrame:
    """Adds ``bytes`` to listed files and ``error`` where one cannot be read."""
    base, prefix = split_base(root)
    schema = pa.schema([("path", pa.string()), ("bytes", pa.binary()), ("error", pa.string())])

    def one(files: fs.FileSystem, path: str) -> tuple:
        try:
            with files.open_input_stream(path.removeprefix(prefix), compression=None) as source:
                return path, source.read(), None
        except OSError as problem:
            return path, None, f"unreadable: {type(problem).__name__}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = file_system(base)
        for batch in batches:
            named = zip(batch.column("path").to_pylist(), batch.column("error").to_pylist())
            yield from _in_batches(((path, None, error) if error else one(files, path) for path, error in named), schema)

    return spread_by_size(listed).select("path", "error").mapInArrow(read, "path string, bytes binary, error string")


def read_report_files(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root``: path, rel_path, folder, content, ext, status, error.

    Text files are decoded, malformed bytes dropped; empty ones have an empty text, unreadable ones status
    ``failed``. Other files are listed without being opened. Folders that cannot be read and links to folders are rows
    with status ``failed``.
    """
    base, _ = split_base(root)
    listed = list_files(spark, root)
    broken = F.coalesce(F.col("error"), F.lit("")).startswith(FOLDER_ERROR)
    texts = F.lower("path").endswith(".txt") & ~broken
    read = _contents(listed.filter(texts), root).select("path", utf8_dropping_bad_bytes(F.col("bytes")).alias("content"), "error")
    others = listed.filter(~texts).select("path", F.lit(None).cast("string").alias("content"), "error")
    found = read.unionByName(others).withColumnRenamed("error", "__error")
    files = found.select("path", F.substring(F.col("path"), F.lit(len(base) + 2), F.length("path")).alias("rel_path"),
                         folder_of(F.col("path")).alias("folder"), "content", "__error")
    status = F.when(F.coalesce(F.col("__error"), F.lit("")).startswith(FOLDER_ERROR), "failed").otherwise(F.col("status"))
    return with_status(files).withColumn("status", status).withColumn(
        "error", F.when(F.col("status") == "failed", F.coalesce("__error", "error"))).drop("__error")


def read_text_reports(spark: SparkSession, root: str) -> DataFrame:
    """Non-empty ``.txt`` files: path, folder, content. Unreadable files are skipped."""
    found = _contents(list_files(spark, root).filter(F.col("path").endswith(".txt") & (F.col("size") > 0)), root)
    return found.filter(F.col("bytes").isNotNull()).select(
        "path", folder_of(F.col("path")).alias("folder"), utf8_dropping_bad_bytes(F.col("bytes")).alias("content"))


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header row, every column a string, empty cells as empty strings."""
    return spark.read.options(**CSV_OPTIONS).csv(path).fillna("")


def read_csv_runs(spark: SparkSession, folder: str) -> DataFrame:
    """All published runs of a growing CSV table; a run with other columns than the first one fails the read."""
    return read_runs(spark, folder, lambda paths: spark.read.options(**CSV_OPTIONS, enforceSchema=False).csv(paths).fillna(""))


def read_log_runs(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    """All published runs of an inference log."""
    return read_runs(spark, folder, lambda paths: read_jsonl(spark, paths, schema), schema)


def read_pairs_by_folder(spark: SparkSession, path: str) -> DataFrame:
    """(finding, file_name, result, folder) from CSV files in one directory per folder; folder names stay texts."""
    schema = ", ".join(f"{c} string" for c in [*RESULT_COLUMNS, "folder"])
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path).fillna("")


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """One object per line; blank lines are skipped, a bad line fails the read."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_rows(spark: SparkSession, path: str, *, fmt: str = "auto", columns: Mapping[str, str] | None = None,
              index: str | None = None) -> DataFrame:
    """Inference rows from CSV or JSONL; "auto" decides by the file name."""
    kind = fmt.lower() if fmt else "auto"
    if kind == "auto":
        kind = "jsonl" if path.lower().endswith(".jsonl") else "csv"
    if kind not in ("csv", "jsonl"):
        raise ValueError(f"unknown format {fmt!r}")
    rows = read_jsonl(spark, path) if kind == "jsonl" else read_csv(spark, path)
    return inference_rows(rows, columns, index=index)


def find_result_tables(spark: SparkSession, root: str) -> DataFrame:
    """(path) of the per-folder result tables, by file name in any case."""
    return list_files(spark, root).filter(F.lower(path_part(F.col("path"), 1)).isin(RESULT_FILES)).select("path")


def _records(source: BinaryIO) -> Iterator[list[str]]:
    """The records of a CSV file as it streams by, quoted line breaks included; bad bytes become U+FFFD."""
    csv.field_size_limit(sys.maxsize)
    return csv.reader(io.TextIOWrapper(source, encoding="utf-8-sig", errors="replace", newline=""))


def _rows_by_name(listed: DataFrame, root: str, headers_only: bool = False) -> DataFrame:
    """(path, cells): every row of the listed result tables as a map from column name to cell; with ``headers_only`` one
    row a file, without cells' values. Of equal names in a header the first counts, blank ones do not, and a file
    without names or that cannot be opened has no rows."""
    base, prefix = split_base(root)
    schema = pa.schema([("path", pa.string()), ("cells", pa.map_(pa.string(), pa.string()))])

    def of_file(files: fs.FileSystem, path: str) -> Iterator[tuple]:
        try:
            source = files.open_input_stream(path.removeprefix(prefix), compression=None)
        except OSError:
            return
        with source:
            records = _records(source)
            places: dict[str, int] = {}
            for place, name in enumerate(next(records, [])):
                if name.strip():
                    places.setdefault(name, place)
            if headers_only or not places:
                if places:
                    yield path, [(name, None) for name in places]
                return
            for record in records:
                if record:
                    yield path, [(name, record[place]) for name, place in places.items() if place < len(record)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = file_system(base)
        block, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in of_file(files, path):
                    block.append(row)
                    held += sum(len(cell or "") for _, cell in row[1])
                    if len(block) >= ROWS_AT_ONCE or held >= CHARACTERS_AT_ONCE:
                        yield _batch_of(block, schema)
                        block, held = [], 0
        if block:
            yield _batch_of(block, schema)

    return spread_by_size(listed).select("path").mapInArrow(read, "path string, cells map<string,string>")


def _batch_of(block: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*block), schema.types)], schema=schema)


def compile_result_tables(spark: SparkSession, root: str) -> DataFrame | None:
    """All result tables below ``root`` as one table; None if there is none.

    Headers may differ from file to file, however many there are: a row is a map from name to cell until the columns,
    all names there are, are read out of it. Only these names reach the driver, and only result tables are opened.
    """
    listed = list_files(spark, root).filter(F.lower(path_part(F.col("path"), 1)).isin(RESULT_FILES) & F.col("error").isNull())
    names = _rows_by_name(listed, root, headers_only=True).select(F.explode(F.map_keys("cells")).alias("name")).distinct()
    columns = header_union([[r["name"] for r in names.collect()]])
    if len(columns) == len(ORIGIN) and names.isEmpty():
        return None
    rows = with_origin(_rows_by_name(listed, root), path="path")
    return rows.select(*ORIGIN, *[or_empty(F.col("cells")[n]).alias(out) for n, out in distinct_names(columns).items() if n not in ORIGIN])


def read_splits(spark: SparkSession, path: str | None = None, *, train: str | None = None,
                eval_: str | None = None) -> dict[str, DataFrame]:
    """Train and eval tables from a table folder partitioned by ``split`` or from JSONL files."""
    if path:
        table = spark.read.parquet(path)
        parts = {s: table.filter(F.col("split") == s).drop("split") for s in ("train", "eval")}
        return {s: part for s, part in parts.items() if not part.isEmpty()}
    return {name: read_jsonl(spark, p) for name, p in (("train", train), ("eval", eval_)) if p}
