"""Reports that are sent again: of every path the latest version counts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reportloom.operators.redaction import RegexStage, redact
from reportloom.session import shuffles_dropped

STATE = "micros bigint, digest string"
BUCKETS = 4096  # of paths; a call of a state function costs as much as some hundred reports
BUCKET_STATE = "paths array<string>, micros array<bigint>, digests array<string>"


def _newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The newest row of one path if it is newer than all before; of equal times the larger digest counts."""
    if state.hasTimedOut:
        state.remove()
        return
    best: tuple[Any, Any] | None = tuple(state.get) if state.exists else None
    newest, given = None, False
    for frame in frames:
        # Sorting or cutting a frame costs a path more than all else here.
        rows = list(zip(frame["micros"].tolist(), frame["digest"].tolist()))
        at = max(range(len(rows)), key=rows.__getitem__)
        if best is None or rows[at] > best:
            best, newest = rows[at], frame["content"].iat[at]
            given = True
    state.update(best)
    # Rows older than the watermark never get here, so a path older than it needs no state.
    state.setTimeoutTimestamp(max(best[0] // 1000, state.getCurrentWatermarkMs()) + 1)
    if given:
        yield pd.DataFrame({"path": [key[0]], "micros": [best[0]], "content": [newest]})


def _newest_of_bucket(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """As ``_newest`` for all paths of a bucket in one call."""
    known = {p: (micros, digest) for p, micros, digest in zip(*state.get)} if state.exists else {}
    newest: dict[str, tuple[int, Any]] = {}
    if not state.hasTimedOut:
        for frame in frames:
            rows = zip(frame["path"].tolist(), frame["micros"].tolist(), frame["digest"].tolist(), frame["content"].tolist())
            for path, micros, digest, content in rows:
                if path not in known or (micros, digest) > known[path]:
                    known[path], newest[path] = (micros, digest), (micros, content)
    # Rows older than the watermark do not get here in later batches, so a path older than it needs no state.
    watermark = state.getCurrentWatermarkMs()
    kept = {p: at for p, at in known.items() if at[0] // 1000 >= watermark} if watermark > 0 else known
    if kept:
        state.update((list(kept), *(list(x) for x in zip(*kept.values()))))
        state.setTimeoutTimestamp(max(min(micros for micros, _ in kept.values()) // 1000, watermark) + 1)
    else:
        state.remove()
    if newest:
        micros, contents = zip(*newest.values())
        yield pd.DataFrame({"path": list(newest), "micros": micros, "content": pd.Series(contents, dtype=object)})


def latest_versions(arriving: DataFrame, *, path: str = "path", version: str = "modified", content: str = "content",
                    lateness: str = "1 day", buckets: int | None = BUCKETS) -> DataFrame:
    """(path, modified, content) of every report that is newer than those of its path before.

    Repeated and older versions are dropped. State is the time and digest of a path, kept until the
    watermark, the latest time seen less ``lateness``, has passed it; a report older than the
    watermark is not taken any more. Rows without a path or a time pass unchanged.

    Paths share one state per bucket, by hash. A checkpoint goes on only with the number of buckets it
    was begun with; None is a state per path, as checkpoints from before there were buckets have.
    """
    rows = arriving.select(F.col(path).cast("string").alias("path"), F.col(version).cast("timestamp").alias("modified"),
                           F.col(content).cast("string").alias("content"))
    known = F.col("path").isNotNull() & F.col("modified").isNotNull()
    told = rows.filter(known).withWatermark("modified", lateness).select(
        "path", "modified", "content", F.unix_micros("modified").alias("micros"),
        F.coalesce(F.md5("content"), F.lit("")).alias("digest"))
    grouped, function, kept = told.groupBy("path"), _newest, STATE
    if buckets is not None:
        bucket = F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int")
        grouped, function, kept = told.withColumn("bucket", bucket).groupBy("bucket"), _newest_of_bucket, BUCKET_STATE
    newest = grouped.applyInPandasWithState(
        function, "path string, micros bigint, content string", kept, "append", GroupStateTimeout.EventTimeTimeout)
    return newest.select("path", F.timestamp_micros("micros").alias("modified"), "content").unionByName(rows.filter(~known))


def redact_latest_stream(arriving: DataFrame, target: str, checkpoint: str, stage: RegexStage | None = None,
                         **columns: Any) -> StreamingQuery:
    """Append the redacted new versions to a Parquet table until the input at hand is used up.

    Started again with its checkpoint it goes on where it stopped.
    """
    versions = redact(latest_versions(arriving, **columns), stage, text="content").withColumn("digest", F.md5("content"))
    writer = versions.drop("content").writeStream.format("parquet").outputMode("append").options(
        path=target, checkpointLocation=checkpoint, compression="zstd").trigger(availableNow=True)
    with shuffles_dropped(arriving.sparkSession):  # a query keeps the settings it is started with
        return writer.start()


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    """(path, modified, redacted, spans, n_versions): the latest version of every path; rows without a path or a time
    are not compared and come one by one."""
    kept = spark.read.parquet(target)
    known = F.col("path").isNotNull() & F.col("modified").isNotNull()
    order = F.struct("modified", F.coalesce("digest", F.lit("")))
    latest = kept.filter(known).groupBy("path").agg(
        F.max_by(F.struct("modified", "redacted", "spans"), order).alias("r"), F.count("*").alias("n_versions"))
    single = kept.filter(~known).select("path", "modified", "redacted", "spans", F.lit(1).cast("bigint").alias("n_versions"))
    return latest.select("path", "r.*", "n_versions").unionByName(single)
