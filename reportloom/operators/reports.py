"""Folder-level views of a report table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.fixed_values import EXTRACTION_REQUEST
from reportloom.functions.answers import parse_extraction
from reportloom.functions.modality import folder_of, path_part
from reportloom.functions.text import fill, or_empty


def text_reports(reports: DataFrame, *, path: str = "path", content: str = "content") -> DataFrame:
    """Non-empty ``.txt`` reports with their folder."""
    return reports.filter(F.col(path).endswith(".txt") & (F.length(content) > 0)).withColumn(
        "folder", folder_of(F.col(path))
    )


def folder_counts(reports: DataFrame) -> DataFrame:
    return reports.groupBy("folder").agg(F.count("*").alias("n_reports"))


def extraction_requests(reports: DataFrame, *, content: str = "content") -> DataFrame:
    return reports.withColumn("prompt", fill(EXTRACTION_REQUEST, report=F.col(content)))


def extracted_pairs(reports: DataFrame, responses: DataFrame, *, key: str, content: str = "content") -> DataFrame:
    """(finding, file_name, result, folder, status) per report.

    A report whose call failed stays, with empty fields and status ``failed``. Of several answers to
    a report the last in order of their text counts.
    """
    single = responses.groupBy(key).agg(F.max(content).alias("__answer"))
    joined = reports.join(single, key, "left")
    return joined.withColumn("__pair", parse_extraction(F.col("__answer"))).select(
        key,
        or_empty(F.col("__pair.finding")).alias("finding"),
        path_part(F.col("path"), 1).alias("file_name"),
        or_empty(F.col("__pair.conclusion")).alias("result"),
        "folder",
        F.when(F.col("__answer").isNull(), "failed").otherwise("ok").alias("status"),
    )


def unprocessed(reports: DataFrame, processed: DataFrame, *, key: str) -> DataFrame:
    """Reports found but without a processed row."""
    return reports.join(processed.select(key), key, "left_anti")


def run_summary(reports: DataFrame, processed: DataFrame, *, key: str) -> DataFrame:
    """One row: reports found, processed, folders processed, missing."""
    done = processed.select(key).distinct().withColumn("__done", F.lit(1))
    return reports.join(done, key, "left").agg(
        F.count("*").alias("found"),
        F.count("__done").alias("processed"),
        F.count_distinct(F.when(F.col("__done") == 1, F.col("folder"))).alias("folders"),
        (F.count("*") - F.count("__done")).alias("missing"),
    )
