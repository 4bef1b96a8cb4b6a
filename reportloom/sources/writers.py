"""Writers. Results stay tables; text formats get their formatting here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.fixed_values import RESULT_COLUMNS
from reportloom.operators.redaction import counts_by_label, failures, totals
from reportloom.sources.runs import append_run, with_run

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "emptyValue": "",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def redacted_path(df: DataFrame, *, path: str = "rel_path", out: str = "out_path") -> DataFrame:
    """Mirrored path with a ``.txt`` suffix; the full relative path stays the key, so a.pdf and a.txt both keep a row."""
    return df.withColumn(out, F.concat(F.regexp_replace(path, r"(?<=[^/.])\.[^./]+$", ""), F.lit(".txt")))


def write_redacted(df: DataFrame, folder: str, *, path: str = "rel_path", text: str = "redacted") -> None:
    table = redacted_path(df.select(F.col(path).alias("rel_path"), F.col(text).alias("text")))
    table.write.mode("overwrite").parquet(folder)


def write_redaction_summary(df: DataFrame, folder: str, *, path: str = "rel_path") -> None:
    """Counts by label, totals and failures as three small JSON tables."""
    ok = df.filter(F.col("status") != "failed")
    counts_by_label(ok).write.mode("overwrite").json(f"{folder}/labels")
    totals(df, status="status").write.mode("overwrite").json(f"{folder}/totals")
    failures(df, path=path).write.mode("overwrite").json(f"{folder}/failures")


def write_pairs_by_folder(pairs: DataFrame, folder: str) -> None:
    """CSV files of (finding, file_name, result), one directory per report folder.

    Rows are rebalanced by folder: small folders get one file, a large one is split over tasks.
    """
    pairs.select("folder", *RESULT_COLUMNS).hint("rebalance", "folder").write.mode("overwrite").partitionBy("folder").options(**CSV_OPTIONS).csv(folder)


def write_pairs(pairs: DataFrame, folder: str) -> None:
    pairs.select(*RESULT_COLUMNS).write.mode("overwrite").options(**CSV_OPTIONS).csv(folder)


def write_compiled(table: DataFrame | None, folder: str, spark: SparkSession) -> int:
    """Combined CSV in fixed column order and its row count; no input gives an empty table and 0."""
    if table is None:
        spark.createDataFrame([], "origin_folder string, modality string").write.mode("overwrite").options(
            **CSV_OPTIONS).csv(folder)
        return 0
    from pyspark.sql import Observation

    written = Observation()
    table.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(**CSV_OPTIONS).csv(folder)
    return int(written.get["rows"])


def write_jsonl(df: DataFrame, folder: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(folder)


def write_splits(df: DataFrame, folder: str, *, split: str = "split") -> None:
    """Parquet partitioned by split. The whole folder is replaced, so no older eval part survives."""
    df.withColumnRenamed(split, "split").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "split").parquet(folder)


def append_csv(df: DataFrame, folder: str, *, run_id: str) -> None:
    """Add a run's rows to a growing CSV table, marked by ``run_id``; a run done again takes its earlier rows' place."""
    append_run(with_run(df, run_id), folder, run_id, lambda rows, path: rows.write.options(**CSV_OPTIONS).csv(path))


def append_log(df: DataFrame, folder: str, *, run_id: str) -> None:
    """Nested inference log as JSON, marked by ``run_id``; a run done again takes its earlier rows' place."""
    append_run(with_run(df, run_id), folder, run_id, write_jsonl)


def write_summary(one_row: DataFrame, folder: str) -> None:
    one_row.write.mode("overwrite").json(folder)
