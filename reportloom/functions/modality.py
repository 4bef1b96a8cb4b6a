"""Modality and path-derived columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportloom.fixed_values import CT, FOLDER_MODALITY, MR, TEXT_MODALITY
from reportloom.functions.text import strip


def _any_of(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def modality(text: Column, words: tuple[list[str], list[str]] = TEXT_MODALITY, fallback: str | None = None) -> Column:
    """MR or CT by substring; ``fallback`` None means the upper-cased text itself.

    Substrings count inside words too ("ct" in "fracture").
    """
    low = F.lower(strip(F.coalesce(text, F.lit(""))))
    other = F.upper(low) if fallback is None else F.lit(fallback)
    return F.when(_any_of(low, words[0]), MR).when(_any_of(low, words[1]), CT).otherwise(other)


def folder_modality(name: Column) -> Column:
    return modality(name, FOLDER_MODALITY)


def modality_hint(finding: Column) -> Column:
    """Case-sensitive hint used inside prompts."""
    return F.when(F.coalesce(finding, F.lit("")).contains("МР"), MR).otherwise(CT)


def path_part(path: Column, from_end: int) -> Column:
    """The ``from_end``-th path segment counted from the end (1 = file name); '' if absent."""
    return F.coalesce(F.get(F.reverse(F.split(path, "/")), F.lit(from_end - 1)), F.lit(""))


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def extension_of(path: Column) -> Column:
    """Lower-cased suffix of the file name without the dot; '' if it has none."""
    return F.lower(F.regexp_extract(path_part(path, 1), r"^.+\.([^.]+)$", 1))
