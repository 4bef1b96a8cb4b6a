"""Anonymise a folder of reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.operators.redaction import RegexStage, redact
from reportloom.session import fresh_folder
from reportloom.sources.readers import read_report_files
from reportloom.sources.writers import write_redaction_summary, write_redacted


def anonymise_reports(reports: DataFrame, stage: RegexStage | None = None) -> DataFrame:
    """Reports with spans and redacted text; skipped and failed ones keep a row without text."""
    usable = F.when(F.col("status") == "ok", F.col("content"))
    return redact(reports.withColumn("text", usable), stage)


def anonymise_folder(spark: SparkSession, source: str, target: str, stage: RegexStage | None = None) -> None:
    """Read, redact and write a folder tree; the redacted table is written once and summarised from there."""
    work = fresh_folder(spark, "anonymised")
    anonymise_reports(read_report_files(spark, source), stage).drop("content", "text").write.parquet(work)
    done = spark.read.parquet(work)
    write_redacted(done.filter(F.col("status") == "ok"), f"{target}/texts")
    write_redaction_summary(done, f"{target}/summary")
