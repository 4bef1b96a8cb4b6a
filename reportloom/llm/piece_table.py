"""Fill-in-middle rearrangement over a piece table.

A document is a list of descriptors (buffer, start, length) over two buffers that never change: its own UTF-8 text and
the sentinels. Cutting splits descriptors, arranging permutes them and puts sentinel descriptors in front, and the
inverse permutation puts them back; no step copies text. Digests stream over the descriptors, and text is put together
once, where it is asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportloom.llm.storage import Batches, batches_of, mapped, rows_of, sliced

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
TEXT, MARKS = 0, 1  # the buffers
#: Order in which each form shows prefix (0), middle (1) and suffix (2).
ORDERS = {PSM: (0, 2, 1), SPM: (2, 0, 1)}


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


class Sentinels:
    """The marks before prefix, middle and suffix, as one immutable buffer."""

    def __init__(self, prefix: str = PREFIX, suffix: str = SUFFIX, middle: str = MIDDLE):
        marks = [m.encode() for m in (prefix, middle, suffix)]
        if not all(marks) or len(set(marks)) < 3 or any(m[0] in other[1:] for m in marks for other in marks):
            raise ValueError("sentinels must differ, and none may hold the first byte of one further inside")
        self.marks, self.buffer, at = marks, b"".join(marks), 0
        self.pieces = []
        for mark in marks:
            self.pieces.append(Piece(MARKS, at, len(mark)))
            at += len(mark)

    def inside(self, text: bytes) -> bool:
        return any(mark in text for mark in self.marks)


def split(pieces: Sequence[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The descriptors of the first ``at`` bytes and those of the rest; one descriptor at most is split in two."""
    before, after, left = [], [], at
    for piece in pieces:
        here = min(left, piece.length)
        if here:
            before.append(Piece(piece.buffer, piece.start, here))
        if here < piece.length:
            after.append(Piece(piece.buffer, piece.start + here, piece.length - here))
        left -= here
    return before, after


def arrange(parts: Sequence[list[Piece]], form: str, sentinels: Sentinels) -> list[Piece]:
    """Descriptors of prefix, middle and suffix in the order of ``form``, each behind its sentinel."""
    return [piece for which in ORDERS[form] for piece in (sentinels.pieces[which], *parts[which])]


def restore(output: bytes, form: str, sentinels: Sentinels) -> list[Piece]:
    """Descriptors over ``output`` in the order of the text it was made from: the inverse permutation, sentinels left out.

    A sentinel can't arise where a part meets one, as its first byte is nowhere else in them.
    """
    whole = [Piece(TEXT, 0, len(output))]
    if form == PLAIN:
        return split(whole, 0)[1]
    order, at, starts = ORDERS[form], 0, []
    for which in order:
        at = output.index(sentinels.marks[which], at)
        starts.append(at)
        at += len(sentinels.marks[which])
    parts: dict[int, list[Piece]] = {}
    for which, start in reversed(list(zip(order, starts, strict=True))):
        whole, tail = split(whole, start)
        parts[which] = split(tail, len(sentinels.marks[which]))[1]
    return [piece for which in range(len(order)) for piece in parts[which]]


def views(pieces: Sequence[Piece], buffers: Sequence[bytes]) -> Iterator[memoryview]:
    """What the descriptors stand for, without copying it."""
    held = [memoryview(b) for b in buffers]
    for buffer, start, length in pieces:
        yield held[buffer][start:start + length]


def digest(pieces: Sequence[Piece], buffers: Sequence[bytes]) -> str:
    """SHA-256 of the text a list of descriptors stands for."""
    state = hashlib.sha256()
    for view in views(pieces, buffers):
        state.update(view)
    return state.hexdigest()


def line_ends(text: bytes) -> list[int]:
    """Byte offsets behind every line; a last line without a line break counts."""
    ends, at = [], text.find(b"\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find(b"\n", at + 1)
    if text and not text.endswith(b"\n"):
        ends.append(len(text))
    return ends


def draws(seed: int, key: object) -> list[int]:
    """Four numbers below 2**32 from the seed and the key."""
    hexed = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(hexed[8 * i:8 * i + 8], 16) for i in range(4)]


def _characters(part: Sequence[Piece], text: bytes) -> int:
    """Code points; in UTF-8 every byte but the following ones of a character starts one."""
    return sum(len(str(view, "utf-8", "replace")) for view in views(part, [text]))


class Arranged(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    pieces: list[Piece]


def arranged(key: object, text: bytes, seed: int, rate: int, spm_rate: int, sentinels: Sentinels) -> Arranged:
    """One document as descriptors in its drawn form."""
    ends, (a, b, chance, side) = line_ends(text), draws(seed, key)
    whole = [Piece(TEXT, 0, len(text))] if text else []
    if not text or chance % 100 >= rate or sentinels.inside(text):
        return Arranged(len(ends), PLAIN, None, None, whole)
    form = SPM if side % 100 < spm_rate else PSM
    low, high = sorted((a % (len(ends) + 1), b % (len(ends) + 1)))
    borders = [0, *ends]
    rest, suffix = split(whole, borders[high])
    prefix, middle = split(rest, borders[low])
    return Arranged(len(ends), form, _characters(prefix, text), _characters(middle, text),
                    arrange([prefix, middle, suffix], form, sentinels))


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100,
                   spm_rate: int = 50, sentinels: Sequence[str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output, output_sha256), one row per row of ``docs``.

    Cut between lines at two places drawn from the seed and the key; ``rate`` of 100 documents are rearranged, and
    ``spm_rate`` of 100 of these with the suffix first. NULL counts as empty. Empty texts and texts that hold a sentinel
    stay plain. A NULL key draws like an empty one, repeated keys draw alike, repeated rows are done each, no rows give
    none. Other columns are ignored. The key must have another name than the columns added.
    """
    marks, kind = Sentinels(*sentinels), docs.schema[key].dataType
    schema = pa.schema([("key", _arrow_type(kind)), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.binary()), ("output_sha256", pa.string())])

    def rows(batches: Batches) -> Iterator[tuple]:
        for one, value in _keyed(batches):
            value = value or b""
            found = arranged(one, value, seed, rate, spm_rate, marks)
            buffers = [value, marks.buffer]
            yield (one, *found[:4], b"".join(views(found.pieces, buffers)), digest(found.pieces, buffers))

    def work(batches: Batches) -> Batches:
        return batches_of(rows(batches), schema, weight=lambda row: len(row[5]))

    made = mapped(docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text"), work,
                  f"key {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output binary, output_sha256 string")
    return made.selectExpr(f"key AS `{key}`", "n", "form", "prefix_chars", "middle_chars", "CAST(output AS string) AS output", "output_sha256")


def restored(done: DataFrame, output: str = "output", form: str = "form", text: str = "restored",
             sha256: str = "restored_sha256", sentinels: Sequence[str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """``done`` and the text rebuilt from output and form alone, with its digest; the inverse of ``fill_in_middle``.

    A column that already has one of the two names is replaced. A NULL output or form counts as an empty text or a plain
    one; an output that lacks a sentinel of its form fails the job.
    """
    marks = Sentinels(*sentinels)
    others = [f for f in done.schema.fields if f.name.lower() not in (text.lower(), sha256.lower())]
    kept = done.select(*[F.col(f"`{f.name}`") for f in others], F.col(f"`{output}`").cast("binary").alias("__output"), F.col(f"`{form}`").alias("__form"))
    own = [pa.field(text, pa.string()), pa.field(sha256, pa.string())]

    def work(batches: Batches) -> Batches:
        for batch in sliced(batches):
            texts, digests = [], []
            for value, shape in zip(batch.column(len(others)).to_pylist(), batch.column(len(others) + 1).to_pylist(), strict=True):
                value = value or b""
                pieces = restore(value, shape if shape and value else PLAIN, marks)
                texts.append(b"".join(views(pieces, [value])))
                digests.append(digest(pieces, [value]))
            made = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())]
            schema = pa.schema([*list(batch.schema)[:len(others)], *own])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], *made], schema=schema)

    return kept.mapInArrow(work, T.StructType([*others, T.StructField(text, T.StringType()), T.StructField(sha256, T.StringType())]))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _keyed(batches: Batches) -> Iterator[tuple]:
    """The key as it is, the text as bytes."""
    for key, text in rows_of(batches, "key", "text"):
        yield key.decode() if isinstance(key, bytes) else key, text
