"""Redaction of report tables and its summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.fixed_values import LABEL_TOKENS, REDACTION_REQUEST, REPORT_EXTENSIONS
from reportloom.functions.answers import parse_redaction
from reportloom.functions.modality import extension_of
from reportloom.functions.pii import (
    DEFAULT_PATTERNS, SPANS, Pattern, find_spans, merge_spans, replace_spans,
)
from reportloom.functions.text import cut, fill

CHUNK_CHARS = 750


@dataclass(frozen=True)
class RegexStage:
    patterns: Sequence[Pattern] = DEFAULT_PATTERNS
    tokens: Mapping[str, str] = field(default_factory=lambda: LABEL_TOKENS)


def redact(df: DataFrame, stage: RegexStage | None = None, *, text: str = "text",
           out: str = "redacted", spans: str = "spans") -> DataFrame:
    """Add the merged spans of ``text`` and the text with tokens in their place.

    Row-wise: no shuffle, valid on streaming tables too.
    """
    stage = stage or RegexStage()
    found = df.withColumn(spans, merge_spans(find_spans(F.col(text), stage.patterns)))
    return found.withColumn(out, replace_spans(F.col(text), F.col(spans), stage.tokens))


def redact_in_stages(df: DataFrame, stages: Sequence[RegexStage], *, text: str = "text",
                     out: str = "redacted", spans: str = "spans") -> DataFrame:
    """Run stages one after another, each on the text the previous one left.

    Every span carries the ``stage`` whose input its offsets refer to. No
    stages means the text passes through unchanged.
    """
    staged = df.withColumn(out, F.col(text))
    parts = []
    for number, stage in enumerate(stages):
        part = f"__stage_{number}"
        staged = staged.withColumn(part, merge_spans(find_spans(F.col(out), stage.patterns)))
        staged = staged.withColumn(out, replace_spans(F.col(out), F.col(part), stage.tokens))
        parts.append(F.transform(part, _staged(number)))
    empty = F.array().cast("array<struct<stage:int,start:int,end:int,label:string,original:string>>")
    staged = staged.withColumn(spans, F.concat(empty, *parts))
    return staged.drop(*[f"__stage_{i}" for i in range(len(stages))])


def _staged(number: int):
    return lambda s: F.struct(F.lit(number).alias("stage"), s["start"].alias("start"), s["end"].alias("end"),
                              s["label"].alias("label"), s["original"].alias("original"))


def chunks(df: DataFrame, *, key: str, text: str = "text", size: int = CHUNK_CHARS) -> DataFrame:
    """One row per piece of ``size`` characters: (key, chunk_no, chunk_start, chunk)."""
    pieces = df.select(key, F.posexplode_outer(cut(F.col(text), size)).alias("chunk_no", "chunk"))
    return pieces.filter(F.col("chunk_no").isNotNull()).select(
        key, "chunk_no", (F.col("chunk_no") * size).alias("chunk_start"), "chunk"
    )


def redaction_requests(pieces: DataFrame) -> DataFrame:
    """Add the request wording for a model that redacts one chunk."""
    return pieces.withColumn("prompt", fill(REDACTION_REQUEST, chunk=F.col("chunk")))


def apply_chunk_responses(df: DataFrame, responses: DataFrame, *, key: str, text: str = "text",
                          content: str = "content", size: int = CHUNK_CHARS) -> DataFrame:
    """Add ``redacted`` and ``spans`` from model responses to the chunks of each text.

    ``responses`` holds (key, chunk_no, content). Spans move by their chunk's start. A
    chunk without a response, or whose response lacks a text, stays as it was. Of several
    responses to a chunk the last in order of their text counts. Responses
    are gathered per text, at most one per chunk, and meet the text in one join; the
    chunks are cut again in the row and never shuffled.
    """
    answer = parse_redaction(F.col(content))
    given = responses.filter(F.col(content).isNotNull() & F.col(key).isNotNull())
    single = given.groupBy(key, "chunk_no").agg(F.max(content).alias(content))
    answers = single.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("chunk_no", answer.alias("answer")))).alias("__answers")
    )

    def settled(chunk: Column, i: Column) -> Column:
        given = F.col("__answers")[i]
        moved = F.transform(given["spans"], lambda s: F.struct(
            (s["start"] + i * size).alias("start"), (s["end"] + i * size).alias("end"),
            s["label"].alias("label"), s["original"].alias("original"),
        ))
        return F.struct(F.coalesce(given["text"], chunk).alias("text"), F.coalesce(moved, F.array().cast(SPANS)).alias("spans"))

    joined = df.join(answers, key, "left").withColumn("__parts", F.transform(cut(F.col(text), size), settled))
    return joined.withColumns({
        "redacted": F.array_join("__parts.text", ""), "spans": F.flatten("__parts.spans"),
    }).drop("__answers", "__parts")


def span_rows(df: DataFrame, *keep: str, spans: str = "spans") -> DataFrame:
    """One row per span: kept columns, label, span_start, span_end, original.

    An inner explode makes the optimizer add a filter on the array's size, which would
    evaluate the whole pattern search a second time; the outer form does not.
    """
    rows = df.select(*keep, F.explode_outer(spans).alias("__s")).filter(F.col("__s.label").isNotNull())
    return rows.select(*keep, "__s.label", F.col("__s.start").alias("span_start"), F.col("__s.end").alias("span_end"),
                       "__s.original")


def counts_per_text(df: DataFrame, *, key: str, spans: str = "spans") -> DataFrame:
    """(key, label, n): counted inside each row, without a shuffle."""
    labels = F.transform(spans, lambda s: s["label"])
    counted = F.transform(
        F.array_distinct(labels),
        lambda name: F.struct(
            name.alias("label"),
            F.size(F.filter(spans, lambda s: s["label"] == name)).cast("bigint").alias("n"),
        ),
    )
    return df.select(key, F.explode_outer(counted).alias("c")).filter("c.n > 0").select(key, "c.label", "c.n")


def counts_by_label(df: DataFrame, *, spans: str = "spans") -> DataFrame:
    """(label, n) over all texts."""
    return span_rows(df, spans=spans).groupBy("label").agg(F.count("*").alias("n"))


def totals(df: DataFrame, *, spans: str = "spans", status: str | None = None) -> DataFrame:
    """One row: files processed (skipped included, failed not) and replacements made."""
    done = F.lit(True) if status is None else F.col(status) != "failed"
    return df.agg(
        F.count(F.when(done, 1)).alias("files_processed"),
        F.coalesce(F.sum(F.when(done, F.size(spans))), F.lit(0)).cast("bigint").alias("total_replacements"),
    )


def with_status(reports: DataFrame, *, path: str = "path", content: str = "content") -> DataFrame:
    """Mark each report ``ok``, ``skipped`` (unsupported extension) or ``failed`` (unreadable)."""
    ext = extension_of(F.col(path))
    return (
        reports.withColumn("ext", ext)
        .withColumn(
            "status",
            F.when(~F.col("ext").isin(REPORT_EXTENSIONS), "skipped")
            .when((F.col("ext") != "txt") | F.col(content).isNull(), "failed")
            .otherwise("ok"),
        )
        .withColumn(
            "error",
            F.when(F.col("status") == "failed",
                   F.when(F.col("ext") != "txt", F.concat(F.lit("no decoder for ."), F.col("ext")))
                   .otherwise("unreadable")),
        )
    )


def failures(reports: DataFrame, *, path: str = "path") -> DataFrame:
    return reports.filter(F.col("status") == "failed").select(path, "error")
