"""The retrieval corpus as a table of pairs and vectors with its settings."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.operators.compiling import first_filled, indexable_pairs

SETTINGS = "model_name string, normalize boolean, part string"


def corpus_pairs(df: DataFrame, *, finding_key: str = "finding_text", result_key: str = "result_text") -> DataFrame:
    """Indexable pairs; each side may stand under its long or short name."""

    def pick(long: str, short: str):
        return first_filled(*[F.col(c) for c in (long, short) if c in df.columns])

    return indexable_pairs(df, finding=pick(finding_key, "finding"), result=pick(result_key, "result"))


def build_index(df: DataFrame, encode: Callable[[DataFrame], DataFrame], *, key: str, finding_key: str = "finding_text",
                result_key: str = "result_text") -> DataFrame:
    """(vec_id, finding, result, embedding). ``encode`` adds ``embedding`` from ``finding``."""
    pairs = corpus_pairs(df, finding_key=finding_key, result_key=result_key)
    return encode(pairs.select(F.col(key).alias("vec_id"), "finding", "result"))


def save_index(index: DataFrame, folder: str, *, model_name: str, normalize: bool = True) -> None:
    """Write vectors and settings; an index without a row is an error and leaves an older one as it was.

    Vectors go to a folder of their own; the settings, written last, name the folder that counts.
    """
    spark, part = index.sparkSession, f"vectors-{uuid.uuid4().hex}"
    index.select("vec_id", "finding", "result", "embedding").write.parquet(f"{folder}/{part}")
    if spark.read.parquet(f"{folder}/{part}").isEmpty():
        raise ValueError("nothing to index: every pair lacks a finding or a result")
    spark.createDataFrame([(model_name, normalize, part)], SETTINGS).coalesce(1).write.mode("overwrite").json(f"{folder}/settings")


def load_index(spark: SparkSession, folder: str, *, model_name: str | None = None) -> tuple[DataFrame, dict]:
    """The vector table and its settings; a different ``model_name`` is an error."""
    settings = spark.read.schema(SETTINGS).json(f"{folder}/settings").first().asDict()
    if model_name is not None and settings["model_name"] != model_name:
        raise ValueError(f"index was built with {settings['model_name']!r}, not {model_name!r}")
    return spark.read.parquet(f"{folder}/{settings.pop('part')}"), settings
