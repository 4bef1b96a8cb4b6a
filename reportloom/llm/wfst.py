"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled from a model file: a normaliser (dummy prefix, white space mark), a trie of the pieces whose arcs write
piece ids, and arcs that write the UTF-8 bytes of characters no piece has. An input is composed with it lazily: states
are positions with their last piece, and the path of least weight in the tropical semiring gives the ids. In a unigram model a
piece's arc weighs its negated score. In a BPE model an arc from piece a to piece b has no weight if the model's merges
leave the border between a and b alone, and infinite weight otherwise; a segmentation is the model's own exactly if
all its neighbours pass, so one path stays.

No piece reaches over the start of a run of blanks or a character without pieces; this is checked at compile time,
and then a text is the concatenation of independent stretches whose paths are remembered.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from reportloom.llm.storage import Batches, mapped, sliced
from reportloom.llm.words import WordCache

MARK = "▁"  # written for a blank in the model's pieces
UNIGRAM, BPE = 1, 2
BORDERS_HELD = 250_000
STRETCHES_AT_ONCE = 1 << 15
TEXTS_AT_ONCE = 256
IDS_AT_ONCE = 1 << 20
UNKNOWN_WEIGHT = 1e6  # of a character written as bytes
END = ""  # key of the piece that ends at a node of the trie


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields (number, value) of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        field, kind = divmod(number(), 8)
        if kind == 0:
            yield field, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield field, data[at:at + size]
            at += size


class Transducer:
    """A compiled model; ``encode`` and ``decode`` work on one text."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        # Numbers of the fields in the model's message.
        parts = {field: dict(_message(value)) for field, value in _message(model.serialized_model_proto()) if field in (2, 3)}
        trainer, normaliser = parts.get(2, {}), parts.get(3, {})
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")
        if normaliser.get(2) or not normaliser.get(5, 1):
            raise ValueError("only models without character rules, with marked blanks")
        self.prefix, self.squeeze = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        self.size, self.unknown = model.get_piece_size(), model.unk_id()
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(self.size) if model.is_byte(i)}
        plain = [i for i in range(self.size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = {model.id_to_piece(i).replace(MARK, " "): i for i in plain}
        self.scores = {i: model.get_score(i) for i in plain}
        self.surface = [b""] * self.size
        for piece, i in self.pieces.items():
            self.surface[i] = piece.encode()
        for byte, i in self.bytes.items():
            self.surface[i] = bytes([byte])
        self.surface[self.unknown] = " ⁇ ".encode()
        self.names = {i: p for p, i in self.pieces.items()}
        self.longest = max(map(len, self.pieces), default=0)
        if self.kind == BPE and not set("".join(self.pieces)) <= set(self.pieces):
            raise ValueError("a BPE model whose characters are not all pieces")
        self.trie = self._compiled()
        self.borders: dict[int, bool] = {}
        self.wide = "<u2" if self.size <= 1 << 16 else "<u4"
        self.paths = WordCache(lambda stretches: [np.array(self.path(s), self.wide).tobytes() for s in stretches])
        apart = not any(" " in p.lstrip(" ") or "\n" in p for p in self.pieces)
        self.stretches = re.compile(r" *[^ \n]+| +|\n").findall if apart else lambda text: [text] if text else []

    def _compiled(self) -> dict:
        root: dict = {}
        for piece, i in self.pieces.items():
            node = root
            for character in piece:
                node = node.setdefault(character, {})
            node[END] = i
        return root

    def normalised(self, text: str) -> str:
        """The text with blanks for marks, as the decoder gives it back, without the dummy prefix."""
        text = text.replace(MARK, " ")
        return re.sub(" +", " ", text).strip(" ") if self.squeeze else text

    def _open(self, left: int, right: int) -> bool:
        """Whether the model's merges, run over the two pieces' characters, never join across the border."""
        parts, border = [*self.names[left], *self.names[right]], len(self.names[left])
        while True:
            best, place = -math.inf, -1
            for at in range(len(parts) - 1):
                found = self.pieces.get(parts[at] + parts[at + 1])
                if found is not None and self.scores[found] > best:
                    best, place = self.scores[found], at
            if place < 0:
                return border == 1 and parts == [self.names[left], self.names[right]]
            if place == border - 1:
                return False
            parts[place:place + 2] = [parts[place] + parts[place + 1]]
            border -= place < border - 1

    def border_open(self, left: int, right: int) -> bool:
        pair = left * self.size + right
        known = self.borders.get(pair)
        if known is None:
            if len(self.borders) >= BORDERS_HELD:
                self.borders.clear()
            known = self.borders[pair] = self._open(left, right)
        return known

    def path(self, text: str) -> list[int]:
        """Ids on the least path over a normalised stretch."""
        return self._least(text) if self.kind == UNIGRAM else self._only(text)

    def _arcs(self, text: str, at: int) -> list[tuple[int, int]]:
        """(end, piece) of the arcs from a position, short ones first; ``size`` stands for a character's bytes, where no
        piece is that character."""
        node, end, found = self.trie, at, []
        for character in text[at:at + self.longest]:
            node = node.get(character)
            if node is None:
                break
            end += 1
            if END in node:
                found.append((end, node[END]))
        if not found or found[0][0] > at + 1:
            found.insert(0, (at + 1, self.size))
        return found

    def _least(self, text: str) -> list[int]:
        """Unigram: one state per position, that of least weight."""
        count = len(text)
        weights, pieces, origins = [0.0, *[math.inf] * count], [self.size] * (count + 1), [0] * (count + 1)
        for at in range(count):
            for end, piece in self._arcs(text, at):
                total = weights[at] + (UNKNOWN_WEIGHT if piece == self.size else -self.scores[piece])
                if total < weights[end]:
                    weights[end], pieces[end], origins[end] = total, piece, at
        trail, at = [], count
        while at:
            trail.append((origins[at], pieces[at]))
            at = origins[at]
        return self._ids(text, trail[::-1])

    def _only(self, text: str) -> list[int]:
        """BPE: all finite weights are 0, so the first path found is a least one. Long arcs are tried first; a state is
        entered once at most, as each beginning of a text has a single path."""
        size, borders, count = self.size, self.borders, len(text)
        trail, opened, at, last = [], [], 0, size
        arcs = self._arcs(text, 0) if count else []
        while at < count:
            while arcs:
                end, piece = arcs.pop()
                if last == size or piece == size:
                    free = True
                else:
                    free = borders.get(last * size + piece)
                    if free is None:
                        free = self.border_open(last, piece)
                if free:
                    trail.append((at, piece))
                    opened.append(arcs)
                    at, last = end, piece
                    arcs = self._arcs(text, at) if at < count else []
                    break
            else:
                at, _ = trail.pop()
                arcs, last = opened.pop(), trail[-1][1] if trail else size
        return self._ids(text, trail)

    def _ids(self, text: str, trail: list[tuple[int, int]]) -> list[int]:
        ids: list[int] = []
        for at, piece in trail:
            ids += self._fallback(text[at]) if piece == self.size else [piece]
        return ids

    def _fallback(self, character: str) -> list[int]:
        return [self.bytes[b] for b in character.encode()] if len(self.bytes) == 256 else [self.unknown]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; none for NULL and for a text that normalises to nothing."""
        text = self.normalised(text or "")
        if not text:
            return np.zeros(0, "<u4")
        stretches = self.stretches(" " + text if self.prefix else text)
        parts = [self.paths.joined(stretches[at:at + STRETCHES_AT_ONCE]) for at in range(0, len(stretches), STRETCHES_AT_ONCE)]
        return np.frombuffer(b"".join(parts), self.wide).astype("<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, the dummy prefix goes."""
        text = b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@functools.cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", numbers: Sequence[str] = ()) -> DataFrame:
    """(key, ids, n_tokens, round_trip), one row per row of ``docs``: the ids, and whether decoding them gives the
    normalised text back (NULL for a NULL text, whose ids are empty). The columns called ``numbers`` follow as longs,
    others are ignored. No shuffle.

    ``model`` is the path of a sentencepiece model that every executor has.
    """
    schema = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("round_trip", pa.bool_()),
                        *[(f"number_{i}", pa.int64()) for i in range(len(numbers))]])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        keys, ids, good, *more = zip(*rows, strict=True)
        sizes = np.array([len(i) for i in ids], np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                         pa.array(np.concatenate(ids).astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), lists, pa.array(sizes), pa.array(good, pa.bool_()),
                                           *[pa.array(column, pa.int64()) for column in more]], schema=schema)

    def work(batches: Batches) -> Batches:
        own, rows, held = transducer(model), [], 0
        for batch in sliced(batches):
            for k, value, *more in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                ids = own.encode(value)
                rows.append((k, ids, None if value is None else own.decode(ids) == own.normalised(value), *more))
                held += len(ids)
                if len(rows) >= TEXTS_AT_ONCE or held >= IDS_AT_ONCE:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)

    carried = [F.col(name).cast("long").alias(f"number_{i}") for i, name in enumerate(numbers)]
    found = mapped(docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), *carried), work,
                   ", ".join(["key long, ids array<int>, n_tokens long, round_trip boolean", *[f"number_{i} long" for i in range(len(numbers))]]))
    return found.toDF(key, "ids", "n_tokens", "round_trip", *numbers)


def decoded(rows: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text), one row per row: the text of its ids, NULL for NULL ids."""
    schema = pa.schema([("key", pa.int64()), ("text", pa.string())])

    def work(batches: Batches) -> Batches:
        own = transducer(model)
        for batch in sliced(batches):
            texts = [None if i is None else own.decode(np.array(i, "<u4")) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], schema=schema)

    picked = rows.select(F.col(key).cast("long").alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    return mapped(picked, work, "key long, text string").withColumnRenamed("key", key)
