"""Retrieve, prompt, score, parse and measure."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.functions.answers import parse_answer
from reportloom.functions.modality import modality
from reportloom.functions.text import has_text, or_empty
from reportloom.operators.evaluation import class_metrics, evaluation_rows, mean_metrics, text_metrics, with_soft_organ
from reportloom.operators.fewshot import PromptStyle, gather_examples, with_prompts
from reportloom.operators.models import score_once, score_requests
from reportloom.operators.neighbours import top_k
from reportloom.session import fresh_folder

SUMMARY = {
    "accuracy": "is_exact_match", "bleu": "bleu", "rougeL": "rouge", "meteor": "meteor",
    "acc_has_finding": "acc_has_finding", "acc_organ_exact": "acc_organ_exact",
    "acc_organ_cosine": "acc_organ_cosine", "acc_modality": "acc_modality",
}


def few_shot_requests(rows: DataFrame, corpus: DataFrame, *, k: int = 5, style: PromptStyle | None = None,
                      normalized: bool = True) -> DataFrame:
    """Rows (id, organ, finding, ..., embedding) with ``examples`` and ``prompt``.

    ``corpus`` holds (corpus_id, finding, result, embedding). The neighbours, k short rows
    per query, are written once: their size is then known, and a small table is broadcast to
    the corpus instead of shuffling the corpus texts.
    """
    style = style or PromptStyle(max_examples=k)
    keyed = rows.filter(has_text(F.col("finding"))).withColumnRenamed("id", "query_id")
    folder = fresh_folder(rows.sparkSession, "neighbours")
    top_k(keyed, corpus, k, normalized=normalized).write.parquet(folder)
    near = rows.sparkSession.read.parquet(folder)
    examples = gather_examples(near, corpus)
    return with_prompts(keyed.drop("embedding"), examples, style=style).withColumnRenamed("query_id", "id")


def answered(requests: DataFrame, make_scorer: Callable[[], Callable[[Sequence[str]], Sequence[str]]], *,
             json_output: bool = True, log: str | None = None, asker: str = "") -> DataFrame:
    """Requests with raw ``content`` and parsed ``answer``.

    The scored table is written once: a model must not be asked again when a later step is retried. With ``log``, a
    folder that outlives the run, it is not asked again by a later run either (see ``score_once``).
    """
    spark = requests.sparkSession
    folder = fresh_folder(spark, "answers")
    if log is None:
        score_requests(requests, make_scorer).write.parquet(folder)
        scored = spark.read.parquet(folder)
    else:
        requests.write.parquet(folder)
        scored = score_once(spark.read.parquet(folder), make_scorer, log, asker=asker)
    return scored.withColumn("answer", parse_answer(F.col("content"), json_output)).withColumn(
        "predicted", F.col("answer.result")
    )


def evaluate(rows: DataFrame, corpus: DataFrame, make_scorer: Callable, *, k: int = 5,
             style: PromptStyle | None = None, organ_similarity: Callable[[DataFrame], DataFrame] | None = None,
             log: str | None = None, asker: str = "") -> DataFrame:
    """The evaluation table; ``organ_similarity`` adds ``acc_organ_cosine`` where an encoder is at hand. ``log`` and
    ``asker``: see ``answered``."""
    style = style or PromptStyle(max_examples=k)
    requests = few_shot_requests(rows, corpus, k=k, style=style)
    measured = class_metrics(text_metrics(answered(requests, make_scorer, json_output=style.json_output, log=log, asker=asker)))
    soft = organ_similarity(measured) if organ_similarity else with_soft_organ(measured, F.lit(0.0))
    return evaluation_rows(soft)


def summary(evaluated: DataFrame, columns: Mapping[str, str] = SUMMARY) -> DataFrame:
    return mean_metrics(evaluated, columns)


def infer(rows: DataFrame, corpus: DataFrame, make_scorer: Callable, *, k: int = 5, style: PromptStyle | None = None,
          default_organ: str = "", log: str | None = None, asker: str = "") -> DataFrame:
    """One nested row per input: input, prediction, metrics, examples, prompt and raw response. ``log`` and ``asker``:
    see ``answered``."""
    style = style or PromptStyle(max_examples=k)
    stated = F.nullif(or_empty(F.col("organ")), F.lit(""))
    filled = rows.withColumn("organ", F.coalesce(stated, F.lit(default_organ))).withColumn(
        "modality", F.coalesce(F.nullif(or_empty(F.col("modality")), F.lit("")), modality(F.col("finding")))
    )
    scored = answered(few_shot_requests(filled, corpus, k=k, style=style), make_scorer, json_output=style.json_output, log=log,
                      asker=asker)
    measured = class_metrics(text_metrics(scored, zero_without_reference=True), finding_longer_than=0)
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyyMMdd'T'HHmmss'Z'")
    return measured.select(
        "id",
        now.alias("timestamp"),
        F.struct("id", "organ", "finding", "reference", "modality").alias("input"),
        "predicted",
        F.struct("bleu", "rouge", "meteor", "levenshtein", "exact_match").alias("metrics"),
        F.struct("acc_has_finding", "acc_organ", "acc_modality").alias("class_metrics"),
        "examples", "prompt", F.col("content").alias("raw_response"),
        F.col("answer.reasoning").alias("reasoning"), F.col("answer.has_finding").alias("has_finding"),
        F.col("answer.organ").alias("organ_pred"), F.col("answer.modality").alias("modality_pred"),
        "status", "error",
    )


def inference_table(inferred: DataFrame) -> DataFrame:
    """The flat columns of an inference run."""
    return inferred.select(
        "id", F.col("input.finding").alias("finding"), F.col("input.modality").alias("gt_modality"),
        F.col("input.organ").alias("gt_organ"), F.col("input.reference").alias("gt_result"),
        or_empty(F.col("modality_pred")).alias("pred_modality"), or_empty(F.col("organ_pred")).alias("pred_organ"),
        F.col("predicted").alias("pred_result"),
    )
