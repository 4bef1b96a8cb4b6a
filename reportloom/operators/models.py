"""Where a user-supplied model meets the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportloom.functions.vectors import unit
from reportloom.session import fresh_folder
from reportloom.sources.runs import append_run, read_runs

ENCODE_BATCH = 64
SCORE_BATCH = 64
REQUESTS_PER_COMMIT = 100_000
ANSWERS = "request string, content string, status string, error string"


def score_requests(df: DataFrame, make_scorer: Callable[[], Callable[[Sequence[str]], Sequence[str]]], *,
                   prompt: str = "prompt", batch_size: int = SCORE_BATCH) -> DataFrame:
    """Add ``content``, ``status`` and ``error`` from a scorer over prompts.

    ``make_scorer`` runs once per task and gets ``batch_size`` prompts at a time. A batch that fails
    is halved until the failing prompts stand alone, so one costs two calls per halving at most; such
    a row keeps NULL content and status ``failed``. Only the prompt column travels to Python, in Arrow batches of bounded
    bytes; of these, ``batch_size`` prompts at a time become Python texts.
    """

    def answers(scorer: Callable, texts: list) -> list[tuple]:
        try:
            found = [(answer, "ok", None) for answer in scorer(texts)]
            if len(found) != len(texts):
                raise ValueError("the scorer must return one answer per prompt")
            return found
        except Exception as problem:  # a failed request is a row, not a failed job
            if len(texts) == 1:
                return [(None, "failed", f"{type(problem).__name__}: {problem}")]
            half = len(texts) // 2
            return answers(scorer, texts[:half]) + answers(scorer, texts[half:])

    fields = ["content", "status", "error"]

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = make_scorer()

        def answered(prompts: pa.Array) -> pa.Array:
            rows = [row for at in range(0, len(prompts), batch_size) for row in answers(scorer, prompts.slice(at, batch_size).to_pylist())]
            return pa.StructArray.from_arrays([pa.array([row[i] for row in rows], pa.string(), from_pandas=True) for i in range(len(fields))], fields)

        yield from map(answered, batches)  # no name holds a batch while the next one is read

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    answer = F.arrow_udf(score, "content string, status string, error string").asNondeterministic()
    return df.withColumn("__a", answer(F.col(prompt))).select(
        *[F.col(c) for c in df.columns], "__a.content", "__a.status", "__a.error"
    )


def request_key(prompt: Column, asker: str = "") -> Column:
    """What an answer is kept under: a digest of the model's name and the prompt; NULL is not the empty prompt."""
    return F.sha2(F.concat(F.lit(asker), F.lit("\0"), F.coalesce(F.concat(F.lit("="), prompt), F.lit(""))), 256)


def answer_log(spark: SparkSession, log: str) -> DataFrame:
    """(request, content, status, error): all answers kept so far, failed tries included."""
    return read_runs(spark, log, lambda paths: spark.read.schema(ANSWERS).parquet(*paths), ANSWERS)


def score_once(df: DataFrame, make_scorer: Callable[[], Callable[[Sequence[str]], Sequence[str]]], log: str, *,
               prompt: str = "prompt", asker: str = "", batch_size: int = SCORE_BATCH,
               requests_per_commit: int = REQUESTS_PER_COMMIT) -> DataFrame:
    """As ``score_requests``, with a log of answers that outlives the run: what it holds is not asked again.

    Each distinct prompt is asked once, whatever the number of its rows. Answers are published in the log slice by
    slice, about ``requests_per_commit`` prompts each, so a run that breaks off loses one slice at most. Failed
    requests are asked again by the next run. The log may be shared by several tables; ``asker`` names the model and its
    settings. ``df`` is read three times: pass a stored table. First only keys meet the log; prompts are then shuffled
    for open keys alone (a semi-join by a written table of keys, which Spark turns into a Bloom filter or a broadcast
    where they are few).
    """
    spark = df.sparkSession
    key = request_key(F.col(prompt), asker)
    asked = df.select(key.alias("request"), F.col(prompt).alias("prompt"))
    got = answer_log(spark, log).filter(F.col("status") == "ok").select("request")
    keys, todo = fresh_folder(spark, "open-requests"), fresh_folder(spark, "open-prompts")
    asked.select("request").distinct().join(got, "request", "left_anti").write.parquet(keys)
    still_open = spark.read.parquet(keys)
    slices = -(-still_open.count() // requests_per_commit)
    if slices:
        once = asked.join(still_open, "request", "left_semi").dropDuplicates(["request"])
        once.withColumn("slice", F.pmod(F.xxhash64("request"), F.lit(slices))).repartition("slice").write.partitionBy("slice").parquet(todo)
        prompts = spark.read.schema("request string, prompt string, slice long").parquet(todo)
        for number in range(slices):
            part = prompts.filter(F.col("slice") == number).drop("slice").repartition(spark.sparkContext.defaultParallelism)
            answers = score_requests(part, make_scorer, batch_size=batch_size).drop("prompt")
            append_run(answers, log, uuid.uuid4().hex, lambda rows, path: rows.write.parquet(path))
    best = answer_log(spark, log).groupBy(F.col("request").alias("__request")).agg(
        F.max(F.struct((F.col("status") == "ok").alias("ok"), "content", "status", "error")).alias("__a"))
    return df.withColumn("__request", key).join(best, "__request", "left").select(
        *[F.col(f"`{c}`") for c in df.columns], "__a.content", "__a.status", "__a.error")


def encode(df: DataFrame, make_model: Callable[[], Callable[[np.ndarray], np.ndarray]], *, text: str = "text",
           out: str = "embedding", normalize: bool = True, batch_size: int = ENCODE_BATCH) -> DataFrame:
    """Add a vector column from a user-supplied encoder, called on batches of texts."""
    predict = predict_batch_udf(make_model, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    vector = predict(F.coalesce(F.col(text), F.lit("")))
    encoded = df.withColumn(out, vector)
    return encoded.withColumn(out, unit(F.col(out)).cast("array<float>")) if normalize else encoded


def fit_offline_encoder(df: DataFrame, *, text: str = "text", dimensions: int = 256):
    """Hashed bag of words with inverse document frequency, for use without a neural model."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"[^\p{L}\p{N}_]+"),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=dimensions),
        IDF(inputCol="__tf", outputCol="__idf"),
        Normalizer(inputCol="__idf", outputCol="__unit"),
    ]).fit(df)


def encode_offline(df: DataFrame, model, *, out: str = "embedding") -> DataFrame:
    return model.transform(df).withColumn(out, vector_to_array("__unit", "float32")).drop(
        "__words", "__tf", "__idf", "__unit"
    )
