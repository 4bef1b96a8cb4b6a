"""Continuous redaction of arriving reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reportloom.operators.redaction import RegexStage, counts_by_label, redact
from reportloom.sources.runs import append_run, read_runs, remove_superseded

COUNTS_RUN = "counts"


def redact_stream(arriving: DataFrame, target: str, checkpoint: str, stage: RegexStage | None = None, *,
                  text: str = "text") -> StreamingQuery:
    """Append redacted rows to a Parquet table until the input at hand is used up."""
    return (
        redact(arriving, stage, text=text).writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def count_labels_stream(arriving: DataFrame, target: str, checkpoint: str, stage: RegexStage | None = None, *,
                        text: str = "text") -> StreamingQuery:
    """Keep a table of running counts by label. The state holds one row per label.

    Every batch writes its counts to a folder of its own and publishes that, so a reader always sees one whole state;
    the one before stays for readers still at it.
    """

    def replace(counts: DataFrame, _: int) -> None:
        append_run(counts.repartition(1), target, COUNTS_RUN, lambda df, path: df.write.parquet(path))
        remove_superseded(counts.sparkSession, target, keep=2)

    return (
        counts_by_label(redact(arriving, stage, text=text)).writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(replace).start()
    )


def read_label_counts(spark: SparkSession, target: str) -> DataFrame:
    """The counts as of the last whole batch."""
    return read_runs(spark, target, lambda paths: spark.read.parquet(*paths), "label string, n bigint")
