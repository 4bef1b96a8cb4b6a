"""Name -> (Spark query, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from queries.tables import flat, standard

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may name the given tables as ``{documents}`` etc."""

    def add(make: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: flat(make(spark, sf_dir))
        if sql is not None:
            SQL[name] = standard(sql)
        return make

    return add
