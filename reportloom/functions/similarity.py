"""Row-wise comparison of a reference with a prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportloom.functions.modality import modality
from reportloom.functions.text import let, or_empty, strip

BANDS = (64, 1024)  # distances looked for before the full table of both texts is worked out


def exact_match(reference: Column, prediction: Column) -> Column:
    return (strip(or_empty(reference)) == strip(or_empty(prediction))).cast("double")


def edit_distance(a: Column, b: Column, bands: Sequence[int] = BANDS) -> Column:
    """Insertions, deletions and replacements from ``a`` to ``b``.

    A distance within a band needs only the cells near the diagonal. Bands that are narrow beside
    the texts are tried first; other texts, and those that differ by more, take the full table.
    """
    longest = F.greatest(F.length(a), F.length(b))
    narrow = F.filter(F.array(*[F.lit(band) for band in bands]), lambda band: band * 8 <= longest)
    tried = F.aggregate(
        narrow, F.lit(-1),
        lambda found, band: F.when(found >= 0, found).otherwise(F.call_function("levenshtein", a, b, band)),
    )
    return let(tried, lambda found: F.when(found >= 0, found).otherwise(F.levenshtein(a, b)))


def edit_similarity(reference: Column, prediction: Column) -> Column:
    """1 - edit distance / longer length; two empty texts are alike."""
    a, b = or_empty(reference), or_empty(prediction)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, 1.0).otherwise(1.0 - edit_distance(a, b) / F.greatest(longest, F.lit(1)))


def true_has_finding(finding: Column, longer_than: int = 15) -> Column:
    return F.length(strip(or_empty(finding))) > longer_than


def has_finding_hit(truth: Column, predicted: Column) -> Column:
    return F.coalesce(truth == predicted, F.lit(False)).cast("int")


def organ_hit(truth: Column, predicted: Column) -> Column:
    plain = lambda c: F.lower(strip(c))
    return F.coalesce(plain(or_empty(truth)) == plain(predicted), F.lit(False)).cast("int")


def modality_hit(truth: Column, predicted: Column) -> Column:
    t, p = modality(truth), modality(predicted)
    return ((t != "") & (p != "") & (t == p)).cast("int")
