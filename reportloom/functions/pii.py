"""Finding, merging and replacing personal-data spans as JVM expressions.

Spans are ``struct<start, order, end, label, original>`` with code-point offsets;
``order`` is the pattern's position and decides ties at equal start.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportloom.fixed_values import LABEL_TOKENS, NAME_STRICT, PII_PATTERNS
from reportloom.functions.text import CHUNK, between, cut, let

FOUND = "array<struct<start:int,order:int,end:int,label:string,original:string>>"
SPANS = "array<struct<start:int,end:int,label:string,original:string>>"

# Noncharacters reserved for process-internal use: one marks match borders inside an
# expression, the other stands in for the mark should a text hold it.
MARK, STAND_IN = "\ufdd0", "\ufdd1"
BLOCK = 256


@dataclass(frozen=True)
class Pattern:
    """One labelled pattern.

    The optional hints state what every match must have; they save time and change no result:
    ``needles`` literals of which the text holds at least one, ``digits`` a decimal digit
    somewhere in the text, ``start`` a zero-width condition at a match's first character.
    """

    label: str
    regex: str
    needles: Sequence[str] = ()
    digits: bool = False
    start: str = ""
    ignore_case: bool = False

    @property
    def java_regex(self) -> str:
        flags = "(?iuU)" if self.ignore_case else "(?U)"
        return f"{flags}{self.start}(?:{self.regex})"


# What the default patterns need, by label. An address can only start where its run of
# characters does or where the last match ended; trying every character of a long run
# without an @ would take quadratic time.
_HINTS = {
    "EMAIL": {"needles": ["@"], "start": r"(?:\G|(?<![a-zA-Z0-9._%+-]))"},
    "PHONE": {"digits": True, "start": r"(?=[+(\d])"},
    "DATE": {"digits": True, "start": r"(?=[\dа-я])"},
    "DOB": {"digits": True, "needles": ["Дата", "дата"]},
    "POLICY": {"needles": ["полис"]},
    "SNILS": {"digits": True, "start": r"(?=\d)"},
    "NAME": {"start": "(?=[А-ЯЁ])"},
    "ADDRESS": {"needles": ["ул", "просп", "пл", "пер", "г"]},
    "ORG": {"needles": ["ФГБУ", "ООО", "ЗАО", "ОАО", "Больница", "линика", "Лаборатория"]},
    "LOCATION": {"needles": ["г"]},
}
DEFAULT_PATTERNS: tuple[Pattern, ...] = tuple(
    Pattern(label, regex, **_HINTS[label]) for label, regex in PII_PATTERNS
)
STRICT_PATTERNS: tuple[Pattern, ...] = tuple(
    Pattern("NAME", NAME_STRICT, start="(?=[А-ЯЁ])") if p.label == "NAME" else p for p in DEFAULT_PATTERNS
)


def with_user_patterns(extra: Sequence[tuple[str, str]]) -> tuple[Pattern, ...]:
    """The default patterns followed by user ones, which ignore case."""
    return DEFAULT_PATTERNS + tuple(Pattern(label, regex, ignore_case=True) for label, regex in extra)


def _scan(n: Column, carry: Column, empty: Column, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Sequential pass over 0..n-1: ``step(carry, i) -> (carry, items to append)``.

    Returns ``struct<carry, items>``. Appending to an array copies it, so the
    pass collects items per block of ``BLOCK`` steps: a text with very many
    matches costs n * BLOCK copies and not n * n.
    """

    def block(state: Column, b: Column) -> Column:
        last = F.least((b + 1) * BLOCK, n) - 1
        inner = F.aggregate(
            F.sequence(b * BLOCK, last),
            F.struct(state["carry"].alias("carry"), empty.alias("items")),
            lambda s, i: _advance(s, step(s["carry"], i)),
        )
        return let(inner, lambda r: _advance(state, (r["carry"], r["items"])))

    blocks = F.floor((n - 1) / BLOCK).cast("int")
    return F.aggregate(
        F.sequence(F.lit(0), blocks), F.struct(carry.alias("carry"), empty.alias("items")), block
    )


def _advance(state: Column, result: tuple[Column, Column]) -> Column:
    return F.struct(result[0].alias("carry"), F.concat(state["items"], result[1]).alias("items"))


def _cut_at_matches(text: Column, pattern: Pattern, order: int, any_digit: Column) -> Column:
    """``struct<order, label, parts>``; parts alternate text, match, text, match, ..., text."""
    marked = F.regexp_replace(text, F.lit(pattern.java_regex), F.lit(f"{MARK}$0{MARK}"))
    parts = F.split(marked, MARK, -1)
    needs = [any_digit] if pattern.digits else []
    if pattern.needles:
        needs.append(reduce(lambda a, b: a | b, [text.contains(n) for n in pattern.needles]))
    if needs:
        parts = F.when(reduce(lambda a, b: a & b, needs), parts).otherwise(F.array().cast("array<string>"))
    return F.struct(F.lit(order).alias("order"), F.lit(pattern.label).alias("label"), parts.alias("parts"))


def _located(cuts: Column) -> Column:
    """Spans of one pattern from its ``struct<order, label, parts>``."""
    parts = cuts["parts"]
    none = F.array().cast(FOUND)

    def step(position: Column, i: Column) -> tuple[Column, Column]:
        hit = F.get(parts, 2 * i + 1)
        start = position + F.length(F.get(parts, 2 * i))
        end = start + F.length(hit)
        span = F.struct(
            start.alias("start"), cuts["order"].alias("order"), end.alias("end"), cuts["label"].alias("label"),
            F.replace(hit, F.lit(STAND_IN), F.lit(MARK)).alias("original"),
        )
        return end, F.array(span)

    matches = F.floor((F.size(parts) - 1) / 2).cast("int")
    return F.when(F.size(parts) > 1, _scan(matches, F.lit(0), none, step)["items"]).otherwise(none)


def find_spans(text: Column, patterns: Sequence[Pattern] = DEFAULT_PATTERNS) -> Column:
    """Matches of all patterns, sorted by start, ties in pattern order."""
    clean = F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(STAND_IN))

    def all_patterns(t: Column, any_digit: Column) -> Column:
        cuts = F.array(*[_cut_at_matches(t, p, i, any_digit) for i, p in enumerate(patterns)])
        return F.flatten(F.transform(cuts, _located))

    return F.sort_array(let(clean, lambda t: let(t.rlike(r"\p{Nd}"), lambda d: all_patterns(t, d))))


def merge_spans(found: Column) -> Column:
    """Union overlapping spans; the first label wins and originals are joined with '|'.

    ``found`` must be sorted as ``find_spans`` returns it. The end of a merged
    span is the running maximum, so a nested span never shortens its cover.
    """
    plain = lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"), s["original"].alias("original")
    )
    none = F.array().cast(SPANS)

    def sweep(spans: Column) -> Column:
        def step(open_: Column, i: Column) -> tuple[Column, Column]:
            span = F.get(spans, i + 1)
            apart = span["start"] >= open_["end"]
            longer = span["end"] > open_["end"]
            grown = F.struct(
                open_["start"].alias("start"),
                F.greatest(open_["end"], span["end"]).alias("end"),
                open_["label"].alias("label"),
                F.when(longer, F.concat(open_["original"], F.lit("|"), span["original"]))
                .otherwise(open_["original"]).alias("original"),
            )
            return F.when(apart, plain(span)).otherwise(grown), F.when(apart, F.array(open_)).otherwise(none)

        first = plain(F.get(spans, F.lit(0)))
        swept = _scan(F.size(spans) - 1, first, none, step)
        return (
            F.when(F.size(spans) > 1, let(swept, lambda r: F.concat(r["items"], F.array(r["carry"]))))
            .otherwise(F.transform(spans, plain))
        )

    return let(found, sweep)


def token_for(label: Column, tokens: Mapping[str, str] = LABEL_TOKENS) -> Column:
    """Replacement token; a label without one becomes ``[LABEL]``."""
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(tokens.items())])
    return F.coalesce(known[label], F.concat(F.lit("["), label, F.lit("]")))


def replace_spans(text: Column, spans: Column, tokens: Mapping[str, str] = LABEL_TOKENS) -> Column:
    """Text with every span replaced by its token; spans must be disjoint and sorted."""

    def rebuild(pieces: Column, s: Column) -> Column:
        def piece(span: Column, i: Column) -> Column:
            previous = F.coalesce(F.get(s, i - 1)["end"], F.lit(0))
            return F.concat(between(pieces, previous, span["start"]), token_for(span["label"], tokens))

        tail = between(pieces, F.get(s, F.size(s) - 1)["end"], F.length(text))
        return F.concat(F.array_join(F.transform(s, piece), ""), tail)

    replaced = let(cut(text, CHUNK), lambda pieces: let(spans, lambda s: rebuild(pieces, s)))
    return F.when(F.size(spans) > 0, replaced).otherwise(text)
