"""Registered queries with equivalent SQL."""

from queries import preparing, redaction, retrieval, scoring, storage, terms  # noqa: F401
from queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
