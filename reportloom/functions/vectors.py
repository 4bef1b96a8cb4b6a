"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportloom.functions.text import let


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_distance(a: Column, b: Column) -> Column:
    def squared(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    return _sum(F.zip_with(a, b, squared))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def unit(a: Column) -> Column:
    """Vector of length one; the zero vector stays zero."""
    return let(norm(a), lambda n: F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + F.lit(1e-12))
