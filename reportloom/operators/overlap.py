"""Word and n-gram overlap of two texts per row: n-grams in the JVM, equal words in Arrow batches.

n-grams are counted inside the row in the JVM, without a shuffle. For the alignment rows are dealt out by their key once, and
words are aligned row by row in Arrow batches. Definitions: Papineni et al. 2002, exponential smoothing after Chen & Cherry
2014, tokens after Post 2018; Banerjee & Lavie 2005.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportloom.fixed_values import METEOR_ALPHA, METEOR_BETA, METEOR_GAMMA, SCORE_LITERALS, SCORE_RULES
from reportloom.functions.shared_runs import shared_runs
from reportloom.functions.text import WHITESPACE, let, words

ORDERS = 4
ALIGNED = ["n_ref", "n_cand", "m", "chunks"]
ROWS_ALIGNED = 512  # texts as Python objects at once
COUNT_FIELDS = ["ref_len", "sys_len"] + [f"{p}{n}" for p in "mt" for n in range(1, ORDERS + 1)]
BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]+"
# What SCORE_RULES set apart: marks but for points and commas between digits, and a dash behind a digit.
SET_APART = r"[!-&(-+:-@/\[-`{-~]|[.,](?:(?<![0-9][.,])|(?![0-9]))|-(?<=[0-9]-)"


def score_tokens(text: Column) -> Column:
    """Tokens for n-gram scores; none for NULL.

    Where no two points or commas stand side by side, no match of a rule takes a character that another one needs, and one
    pass does what the rules do.
    """
    text = F.rtrim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE))
    for old, new in SCORE_LITERALS:
        text = F.replace(text, F.lit(old), F.lit(new))

    def by_rules(padded: Column) -> Column:
        for pattern, new in SCORE_RULES:
            padded = F.regexp_replace(padded, pattern, new.replace("\\", "$"))
        return padded

    padded = let(F.concat(F.lit(" "), text, F.lit(" ")), lambda t: F.when(
        t.rlike(r"[.,][.,]"), by_rules(t)).otherwise(F.regexp_replace(t, SET_APART, " $0 ")))
    return F.array_remove(F.split(padded, BLANKS), "")


def counts_of(reference: Column, prediction: Column) -> Column:
    """Struct of COUNT_FIELDS: lengths, clipped n-gram matches and n-gram totals of the two texts."""
    orders = range(1, ORDERS + 1)
    size = lambda t, n: F.greatest(F.size(t) - (n - 1), F.lit(0)).cast("bigint")

    def fields(r: Column, c: Column) -> Column:
        same = F.array(*[size(c, n) for n in orders])
        return let(F.when(r == c, same).otherwise(shared_runs(r, c)), lambda m: F.struct(
            size(r, 1).alias("ref_len"), size(c, 1).alias("sys_len"), *[F.get(m, F.lit(n - 1)).alias(f"m{n}") for n in orders],
            *[size(c, n).alias(f"t{n}") for n in orders]))

    return let(score_tokens(reference), lambda r: let(score_tokens(prediction), lambda c: fields(r, c)))


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows by key over all shuffle partitions: small tables grow a hundredfold here, so they must not be put together."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def bleu(reference: Column, prediction: Column) -> Column:
    """BLEU of the row's two texts alone."""
    return let(counts_of(reference, prediction), bleu_of)


def bleu_of(counts: Column) -> Column:
    """Score 0-100 over the orders that have n-grams; an order without a match is smoothed."""
    matches = [counts[f"m{n}"] for n in range(1, ORDERS + 1)]
    totals = [counts[f"t{n}"] for n in range(1, ORDERS + 1)]
    log_sum, used, misses = F.lit(0.0), F.lit(0), F.lit(0)
    for m, t in zip(matches, totals, strict=True):
        misses = misses + F.when(m == 0, 1).otherwise(0)
        smoothed = F.lit(100.0) / (F.pow(F.lit(2.0), misses) * F.greatest(t, F.lit(1)))
        precision = F.when(m > 0, F.lit(100.0) * m / F.greatest(t, F.lit(1))).otherwise(smoothed)
        log_sum = log_sum + F.when(t > 0, F.ln(precision)).otherwise(0.0)
        used = used + F.when(t > 0, 1).otherwise(0)
    longer = counts["sys_len"] >= counts["ref_len"]
    shortfall = F.exp(F.lit(1.0) - counts["ref_len"] / F.greatest(counts["sys_len"], F.lit(1)))
    brevity = F.when(longer, 1.0).when(counts["sys_len"] > 0, shortfall).otherwise(0.0)
    any_match = matches[0] + matches[1] + matches[2] + matches[3] > 0
    return F.when(any_match, brevity * F.exp(log_sum / F.greatest(used, F.lit(1)))).otherwise(0.0)


def _aligned(pairs: list[tuple[list[str], list[str]]]) -> list[tuple[int, int, int, int]]:
    """(words of the reference, words of the prediction, matches, chunks) of the texts of one key; words meet only where
    texts of equal lengths hold them."""
    places: tuple[dict, dict] = defaultdict(list), defaultdict(list)
    for texts in pairs:
        sizes = len(texts[0]), len(texts[1])
        for side, listed in zip(places, texts):
            for i, word in enumerate(listed):
                side[word].append((i, sizes))
    found = []
    for word, left in places[0].items():
        right = places[1].get(word)
        if right:
            if len(pairs) > 1:
                left, right = sorted(left), sorted(right)
            found += [(i, j, sizes) for (j, sizes), (i, other) in zip(reversed(left), reversed(right)) if sizes == other]
    found.sort()
    summed = {(len(r), len(c)): [0, 0] for r, c in pairs}
    last = None
    for i, j, sizes in found:
        counts = summed[sizes]
        counts[0] += 1
        counts[1] += (i - 1, j - 1) != last
        last = i, j
    return [(*sizes, *counts) for sizes, counts in summed.items()]


def equal_word_scores(df: DataFrame, *, key: str, reference: str = "reference", prediction: str = "predicted") -> DataFrame:
    """(key, meteor): alignment of equal words, the last with the last; ``key`` must be unique.

    Texts are cut into words where the rows are read; the texts of a key meet once and are aligned in one Arrow call per batch.
    """
    def listed(column: str) -> Column:
        # No word holds a blank.
        return F.array_join(words(F.lower(F.coalesce(F.col(column), F.lit("")))), " ")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_ALIGNED):
                part = batch.slice(at, ROWS_ALIGNED)
                rows, found = [], []
                for row, pairs in enumerate(part.column("p").to_pylist()):
                    for counts in _aligned([(pair["r"].split(), pair["c"].split()) for pair in pairs]):
                        rows.append(row)
                        found.append(counts)
                columns = [pa.array(column, pa.int64()) for column in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), *columns], [key, *ALIGNED])

    sides = df.select(F.col(key), F.struct(listed(reference).alias("r"), listed(prediction).alias("c")).alias("p"))
    met = _dealt(sides, key).groupBy(key).agg(F.collect_list("p").alias("p"))
    schema = T.StructType([met.schema[key], *[T.StructField(name, T.LongType()) for name in ALIGNED]])
    summed = met.mapInArrow(align, schema)
    precision, recall = F.col("m") / F.col("n_cand"), F.col("m") / F.col("n_ref")
    mean = precision * recall / (METEOR_ALPHA * precision + (1 - METEOR_ALPHA) * recall)
    penalty = METEOR_GAMMA * F.pow(F.col("chunks") / F.col("m"), F.lit(METEOR_BETA))
    return summed.select(key, F.when(F.col("m") > 0, (1 - penalty) * mean).otherwise(0.0).alias("meteor"))
