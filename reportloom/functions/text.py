"""String helpers shared by all stages."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a Unicode-aware strip removes.
WHITESPACE = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
CHUNK = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def has_text(text: Column) -> Column:
    """True where the text is neither NULL nor blank; never NULL."""
    return F.coalesce(strip(text) != "", F.lit(False))


def or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def fill(template: str, **values: Column) -> Column:
    """Concatenate a ``str.format`` template with columns in place of its fields."""
    parts: list[Column] = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(or_empty(values[field]))
    return F.concat(*parts)


def cut(text: Column, size: int) -> Column:
    """Array of consecutive pieces of ``size`` characters; empty text gives no piece."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def between(pieces: Column, start: Column, stop: Column, size: int = CHUNK) -> Column:
    """Characters ``start`` to ``stop`` of a text given as ``cut(text, size)``.

    ``substring`` walks a string from its first byte; on pieces the walk stays
    within one piece, so cutting m spans out of a long text is linear. Pieces are
    taken one by one because ``slice`` copies its whole input array.
    """
    first = F.floor(start / size).cast("int")
    last = F.floor(stop / size).cast("int")
    window = F.array_join(F.transform(F.sequence(first, last), lambda i: F.get(pieces, i)), "")
    return F.substring(window, start - first * size + 1, F.greatest(stop - start, F.lit(0)))


def words(text: Column) -> Column:
    """Words and single punctuation marks, Unicode-aware."""
    return F.regexp_extract_all(
        text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x1c-\x1f\x85]"), F.lit(0)
    )


def utf8_dropping_bad_bytes(content: Column) -> Column:
    """Decode bytes as UTF-8 and drop malformed bytes, keeping genuine U+FFFD characters."""
    aside = F.replace(content.cast("string"), F.lit("\ufffd"), F.lit("\ufdd1"))
    valid = F.replace(F.make_valid_utf8(aside), F.lit("\ufffd"), F.lit(""))
    return F.replace(valid, F.lit("\ufdd1"), F.lit("\ufffd"))


def four_decimals(value: Column) -> Column:
    return F.format_string("%.4f", value)
