"""Metric tables and their summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.functions.similarity import (
    edit_similarity, exact_match, has_finding_hit, modality_hit, organ_hit, true_has_finding,
)
from reportloom.functions.text import four_decimals, or_empty, words
from reportloom.functions.text_scores import text_scores
from reportloom.operators.overlap import COUNT_FIELDS, bleu, bleu_of, counts_of
from reportloom.operators.split import with_row_id

TEXT_METRICS = ["bleu", "rouge", "meteor", "levenshtein", "exact_match"]
CLASS_METRICS = ["acc_has_finding", "acc_organ", "acc_modality"]


def align(references: DataFrame, predictions: DataFrame, *, key: str = "id") -> DataFrame:
    """References and predictions by key: a table has no positions to pair up by.

    Of several predictions for a key the smallest row counts, so the references are not multiplied.
    """
    others = [c for c in predictions.columns if c != key]
    single = predictions.groupBy(key).agg(F.min(F.struct(*others)).alias("__p")).select(key, *[F.col(f"__p.{c}").alias(c) for c in others])
    return references.join(single, key)


def text_metrics(df: DataFrame, *, reference: str = "reference", prediction: str = "predicted",
                 zero_without_reference: bool = False,
                 synonyms: DataFrame | None = None) -> DataFrame:
    """Add BLEU, LCS F-score, METEOR, edit similarity and exact match.

    ``synonyms`` is a table (word, synonym) of any size; each row gets those of its own words.
    """
    ref, pred = F.col(reference), F.col(prediction)
    counted, known = df, None
    if synonyms is not None:
        rows = with_row_id(df, out="__row")
        counted, known = rows.join(_own_synonyms(rows, synonyms, prediction), "__row", "left"), F.col("__synonyms")
    scored = counted.withColumn("__scores", text_scores(ref, pred, synonyms=known))
    metrics = {
        "bleu": bleu(ref, pred),
        "rouge": F.col("__scores.rouge"),
        "meteor": F.col("__scores.meteor"),
        "levenshtein": edit_similarity(ref, pred),
        "exact_match": exact_match(ref, pred),
    }
    if zero_without_reference:
        metrics = {n: F.when(or_empty(ref) != "", c).otherwise(0.0) for n, c in metrics.items()}
    return scored.withColumns(metrics).drop("__scores", "__row", "__synonyms")


def _own_synonyms(rows: DataFrame, synonyms: DataFrame, prediction: str) -> DataFrame:
    """(__row, __synonyms): for each row a map from the words of its prediction to their synonyms."""
    word, other = synonyms.columns[:2]
    asked = rows.select("__row", F.explode(F.array_distinct(words(F.lower(or_empty(F.col(prediction)))))).alias("__w"))
    known = synonyms.select(F.lower(word).alias("__w"), F.lower(other).alias("__s")).dropna().distinct()
    by_word = asked.join(known, "__w").groupBy("__row", "__w").agg(F.sort_array(F.collect_list("__s")).alias("__s"))
    return by_word.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("__w", "__s"))).alias("__synonyms"))


def class_metrics(df: DataFrame, *, finding: str = "finding", organ: str = "organ", modality: str = "modality",
                  answer: str = "answer", finding_longer_than: int = 15) -> DataFrame:
    """Add 0/1 columns: finding stated, organ and modality as expected."""
    truth = true_has_finding(F.col(finding), finding_longer_than)
    return df.withColumns({
        "acc_has_finding": has_finding_hit(truth, F.col(f"{answer}.has_finding")),
        "acc_organ": organ_hit(F.col(organ), F.col(f"{answer}.organ")),
        "acc_modality": modality_hit(F.col(modality), F.col(f"{answer}.modality")),
    })


def mean_metrics(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row with the mean of each column (output name -> column); no rows give 0.0."""
    return df.agg(*[F.coalesce(F.avg(F.col(c)), F.lit(0.0)).alias(name) for name, c in columns.items()])


def corpus_bleu(df: DataFrame, *, reference: str = "reference", prediction: str = "predicted") -> DataFrame:
    """One row: BLEU over the summed counts of all rows."""
    counted = df.select(counts_of(F.col(reference), F.col(prediction)).alias("n"))
    summed = counted.agg(*[F.coalesce(F.sum(F.col("n")[f]), F.lit(0)).alias(f) for f in COUNT_FIELDS])
    return summed.select(bleu_of(F.struct(*COUNT_FIELDS)).alias("bleu"))


def sentence_bleu(df: DataFrame, *, reference: str = "reference", prediction: str = "predicted",
                  out: str = "bleu") -> DataFrame:
    """Add the BLEU score of each row alone."""
    return df.withColumn(out, bleu(F.col(reference), F.col(prediction)))


def with_soft_organ(df: DataFrame, similarity: Column) -> DataFrame:
    """Add the cosine of the true and the predicted organ's vectors."""
    return df.withColumn("acc_organ_cosine", F.coalesce(similarity, F.lit(0.0)))


def evaluation_rows(df: DataFrame) -> DataFrame:
    """The thirteen columns of the evaluation table, numbers kept numeric."""
    return df.select(
        "id", "modality", "organ", "finding", F.col("predicted").alias("predicted_result"),
        F.col("exact_match").cast("int").alias("is_exact_match"), "bleu", "rouge", "meteor",
        "acc_has_finding", F.col("acc_organ").alias("acc_organ_exact"), "acc_organ_cosine", "acc_modality",
    )


def formatted(df: DataFrame, columns: Sequence[str] = ("bleu", "rouge", "meteor", "acc_organ_cosine")) -> DataFrame:
    """Scores as text with four decimals, for a text sink."""
    return df.withColumns({c: four_decimals(F.col(c)) for c in columns})
