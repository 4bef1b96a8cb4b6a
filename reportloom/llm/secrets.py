"""Secret scan: an Aho-Corasick automaton finds keywords, a regular expression anchored at the hit reads the value, and
tokens that carry a checksum are kept only if it fits.

The text is searched in a form with one byte per code point (ASCII letters lowered for the automaton, everything
beyond Latin-1 a question mark), so offsets count code points and no case folding beyond A-Z takes part. Runs of hex
digits have no keyword; their prefilter is a search for the shortest run that counts, in a copy that marks hex digits.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.llm.storage import Batches, batches_of, mapped, rows_of, sliced

# Keywords, patterns and alphabets of the kinds, in the order in which spans with one start are listed.
BASE_KINDS = ["assign", "access", "hex"]
CHECKED_KINDS = ["github", "npm", "age"]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = [0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3]
HEX_LEAST = 24

PLACEHOLDER = "<secret>"
_HEX_MARKS = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


class Kind(NamedTuple):
    name: str
    keywords: list[str]
    pattern: re.Pattern[bytes]
    fits: Callable[[re.Match[bytes]], bool]


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def crc_fits(token: bytes) -> bool:
    """The last six characters are the CRC-32 of the rest behind the prefix, in base 62 with leading zeros."""
    body = token.split(b"_", 1)[1]
    rest, digits = zlib.crc32(body[:-6]), ""
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        digits = BASE62[digit] + digits
    return digits.encode() == body[-6:]


def bech32_fits(token: bytes) -> bool:
    """Checksum of a bech32 string: the polynomial over prefix and data leaves 1."""
    prefix, _, data = token.decode("ascii").lower().rpartition("1")
    if not set(data) <= set(BECH32):
        return False
    left = 1
    for value in [*(ord(c) >> 5 for c in prefix), 0, *(ord(c) & 31 for c in prefix), *map(BECH32.index, data)]:
        top, left = left >> 25, (left & 0x1FFFFFF) << 5 ^ value
        for bit, step in enumerate(BECH32_STEPS):
            left ^= step if top >> bit & 1 else 0
    return left == 1


KINDS = [
    Kind("assign", ["password", "passwd", "secret", "token", "apikey", "api_key"],
         re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.I),
         lambda m: len(m[2]) >= 6),
    Kind("access", ["akia"], re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    Kind("github", ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
         lambda m: crc_fits(m[0])),
    Kind("npm", ["npm_"], re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: crc_fits(m[0])),
    Kind("age", ["age-secret-key-1"], re.compile(rb"AGE-SECRET-KEY-1[A-Z0-9]{58}(?![A-Z0-9])"), lambda m: bech32_fits(m[0])),
]


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for at, kind in enumerate(KINDS):
        for word in kind.keywords:
            found.add_word(word, (at, len(word)))
    found.make_automaton()
    return found


def _hex_runs(flat: bytes) -> Iterator[Span]:
    marks = flat.translate(_HEX_MARKS)
    start = marks.find(b"h" * HEX_LEAST)
    while start >= 0:
        end = marks.find(b" ", start)
        end = len(marks) if end < 0 else end
        yield Span("hex", start, end)
        start = marks.find(b"h" * HEX_LEAST, end)


def secrets_of(text: str | None) -> list[Span]:
    """Spans by start, then kind as listed; code points, end exclusive. Per kind leftmost and non-overlapping: a match
    that fails its length or checksum still uses up its characters. NULL and empty texts have none."""
    if not text:
        return []
    flat = text.encode("latin-1", "replace")
    spans, ends = list(_hex_runs(flat)), [0] * len(KINDS)
    hits = [(last - size + 1, at) for last, (at, size) in _automaton().iter(flat.lower().decode("latin-1"))]
    for start, at in sorted(hits):
        kind = KINDS[at]
        if start >= ends[at] and (match := kind.pattern.match(flat, start)):
            ends[at] = match.end()
            if kind.fits(match):
                spans.append(Span(kind.name, start, match.end()))
    order = [*BASE_KINDS, *CHECKED_KINDS]
    return sorted(spans, key=lambda s: (s.start, order.index(s.kind)))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans array of (kind, start, end)), one row per row of ``docs``; a row whose text is NULL or empty has an
    empty array, a NULL key stays NULL, other columns are ignored. No shuffle."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("key", pa.int64()), ("spans", pa.list_(span))])

    def work(batches: Batches) -> Batches:
        rows = ((k, [s._asdict() for s in secrets_of(t.decode() if t else None)]) for k, t in rows_of(batches, "key", "text"))
        return batches_of(rows, schema)

    found = mapped(docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")), work,
                   "key long, spans array<struct<kind:string,start:long,end:long>>")
    return found.withColumnRenamed("key", key)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones as one, replaced."""
    out, at, upto = [], 0, 0
    for span in spans:
        if span.start >= upto:
            out += [text[at:span.start], PLACEHOLDER]
        upto = max(upto, span.end)
        at = upto
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with all secrets in ``text`` replaced; ``length``, where there is such a column of whole numbers, counts
    the new text.

    Rows without a secret, NULL and empty texts and all other columns stay as they are. No shuffle.
    """
    names, kinds = docs.columns, dict(docs.dtypes)

    def work(batches: Batches) -> Batches:
        for batch in sliced(batches):
            old = batch.column(names.index(text)).to_pylist()
            spans = [secrets_of(t) for t in old]
            if any(spans):
                new = [masked(t, s) if s else t for t, s in zip(old, spans, strict=True)]
                columns = list(batch.columns)
                columns[names.index(text)] = pa.array(new, batch.column(names.index(text)).type)
                if kinds.get(length) in ("bigint", "int"):
                    counts = [len(t) if s else n for t, s, n in zip(new, spans, columns[names.index(length)].to_pylist(), strict=True)]
                    columns[names.index(length)] = pa.array(counts, columns[names.index(length)].type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    assert kinds[text] == "string"
    return mapped(docs, work, docs.schema)
