"""Token ids in files of fixed-width bit-packed blocks.

A file holds, after a short head (magic, bits per id, ids per block), blocks of equally many ids, each id in the
fewest bits the vocabulary needs, lowest bit first; then a foot with the byte offset of every block, the documents
(id, first token) and the counts. A block unpacks in a few numpy calls, and any document is read by seeking to its
blocks. Documents are written in ascending order of their id: ranges of ids go to one task each, and a manifest holds
the files in order with the number of ids before each.
"""

from __future__ import annotations

import functools
import re
import string
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reportloom.llm.storage import Batches, batches_of, mapped, rows_of, shared_files, stored, write_attempt
from reportloom.llm.words import WordCache
from reportloom.session import fresh_folder

MAGIC = b"RLTOKEN1"
HEAD = struct.Struct("<8sII")  # magic, bits per id, ids per block
TAIL = struct.Struct("<QQQQ8s")  # ids, documents, blocks, offset of the foot, magic
BLOCK_IDS = 1 << 16  # a multiple of 8, so that every block starts at a byte
FILE_IDS = 1 << 28  # ids after which a task starts its next file
WORDS_AT_ONCE = 1 << 15
WORDS_REMEMBERED = 300_000  # of each of two generations
# A capital and the first byte of a character from U+0300 on, which might compose with it or with its small letter only.
CAPITAL_AND_MARK = re.compile(rb"[A-Z][\xcc-\xf4]")


def bits_for(vocabulary: int) -> int:
    """Fewest bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a bit string, ``bits`` each, lowest first, filled up to a byte."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return octets[:, :bits // 8].tobytes()
    return np.packbits(np.unpackbits(octets, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a bit string as unsigned 32-bit numbers."""
    octets = np.zeros((count, 4), np.uint8)
    raw = np.frombuffer(data, np.uint8)
    if bits % 8 == 0:
        octets[:, :bits // 8] = raw[:count * bits // 8].reshape(count, bits // 8)
    else:
        wide = np.zeros((count, 32), np.uint8)
        wide[:, :bits] = np.unpackbits(raw, count=count * bits, bitorder="little").reshape(count, bits)
        octets = np.packbits(wide, axis=1, bitorder="little")
    return octets.reshape(-1).view("<u4")


class TokenWriter:
    """Writes one file; ``add`` takes the ids of a document."""

    def __init__(self, out: BinaryIO, bits: int, block: int = BLOCK_IDS):
        if block % 8:
            raise ValueError("ids per block must be a multiple of 8")
        self.out, self.bits, self.block = out, bits, block
        self.offsets, self.keys, self.starts = [HEAD.size], [], [0]
        self.held: list[np.ndarray] = []
        self.waiting = 0
        out.write(HEAD.pack(MAGIC, bits, block))

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            self._flush(self.waiting // self.block * self.block)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        for at in range(0, count, self.block):
            data = pack(ids[at:min(at + self.block, count)], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.held, self.waiting = [ids[count:]], len(ids) - count

    def close(self) -> None:
        self._flush(self.waiting)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array([k or 0 for k in self.keys], "<i8").tobytes())
        self.out.write(np.array([k is None for k in self.keys], np.uint8).tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(TAIL.pack(self.starts[-1], len(self.keys), len(self.offsets) - 1, self.offsets[-1], MAGIC))


class TokenFile:
    """A token file open for reading; documents by place, one at a time or in order."""

    def __init__(self, source: BinaryIO):
        self.source = source
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - TAIL.size)
        self.ids, documents, blocks, foot, tail = TAIL.unpack(source.read(TAIL.size))
        source.seek(0)
        head, self.bits, self.block = HEAD.unpack(source.read(HEAD.size))
        if head != MAGIC or tail != MAGIC:
            raise ValueError("not a token file")
        source.seek(foot)
        self.offsets = np.frombuffer(source.read(8 * (blocks + 1)), "<u8")
        keys = np.frombuffer(source.read(8 * documents), "<i8").tolist()
        missing = source.read(documents)
        self.keys = [None if gone else key for key, gone in zip(keys, missing, strict=True)]
        self.starts = np.frombuffer(source.read(8 * (documents + 1)), "<u8").astype(np.int64)
        self.unpacked: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _block(self, number: int) -> np.ndarray:
        if self.unpacked[0] != number:
            first, last = int(self.offsets[number]), int(self.offsets[number + 1])
            self.source.seek(first)
            count = min(self.block, self.ids - number * self.block)
            self.unpacked = number, unpack(self.source.read(last - first), self.bits, count)
        return self.unpacked[1]

    def parts(self, place: int) -> Iterator[np.ndarray]:
        """The ids of a document, block by block."""
        at, end = int(self.starts[place]), int(self.starts[place + 1])
        while at < end:
            number, first = divmod(at, self.block)
            part = self._block(number)[first:first + end - at]
            yield part
            at += len(part)

    def document(self, place: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, "<u4"), *self.parts(place)])


class _Encoder(NamedTuple):
    words: WordCache
    size: int
    kind: str
    lowers: bool
    marks: list[bytes]  # beginnings of special tokens, which the tokenizer looks for before it lowers a text


@functools.cache
def _encoder(path: str) -> _Encoder:
    model = Tokenizer.from_file(path)
    size = model.get_vocab_size(with_added_tokens=True)
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def encode(words: list[bytes]) -> list[bytes]:
        """Many words in one call; a token belongs to the word in which it starts."""
        text = [w.decode() for w in words]
        found = model.encode(" ".join(text), add_special_tokens=False)
        ids = np.array(found.ids, kind)
        begins = np.array([o[0] for o in found.offsets], np.int64)
        firsts = np.cumsum([0, *(len(w) + 1 for w in text)])
        cuts = np.searchsorted(begins, firsts) * ids.itemsize
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]

    lowers = all(model.encode(c, add_special_tokens=False).ids == model.encode(c.lower(), add_special_tokens=False).ids for c in string.ascii_uppercase)
    marks = sorted({t.content[:2].encode() for t in model.get_added_tokens_decoder().values()})
    return _Encoder(WordCache(encode, WORDS_REMEMBERED), size, kind, lowers, marks)


def word_ids(text: bytes | None, path: str) -> np.ndarray:
    """Token ids of a UTF-8 text by the tokenizer at ``path``, one whose pieces never span ASCII white space; words are
    encoded by the tokenizers library once and remembered, in lower case if the tokenizer lowers them anyway.

    The tokenizer composes characters before it lowers them, and H with a line below has a composed form in lower case
    only: in a text where a mark may follow a capital, only words of ASCII are lowered here.
    """
    encoder, text = _encoder(path), text or b""
    lowers = encoder.lowers and not any(mark in text for mark in encoder.marks)
    if lowers and not CAPITAL_AND_MARK.search(text):
        words = text.lower().split()  # A-Z only
    elif lowers:
        words = [word.lower() if word.isascii() else word for word in text.split()]
    else:
        words = text.split()
    parts = [encoder.words.joined(words[at:at + WORDS_AT_ONCE]) for at in range(0, len(words), WORDS_AT_ONCE)]
    return np.frombuffer(b"".join(parts), encoder.kind).astype("<u4")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
                 block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode all texts and write them below ``folder`` in ascending order of the key (NULL first; equal keys by a hash
    of the text); returns the written manifest (place, piece, path, documents, ids).

    NULL and empty texts have the end id only. Other columns are ignored.
    """
    schema = pa.schema([("place", pa.int64()), ("piece", pa.int64()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])

    def written(rows: Iterator[tuple]) -> Iterator[tuple]:
        files, base = shared_files(folder)
        place, piece, row = TaskContext.get().partitionId(), 0, next(rows, None)
        while row is not None:
            path = write_attempt(files, base, ".tokens")
            with files.open_output_stream(path, compression=None) as out:
                writer = TokenWriter(out, bits_for(_encoder(tokenizer).size), block_ids)
                while row is not None and writer.starts[-1] < file_ids:
                    writer.add(row[0], np.append(word_ids(row[1], tokenizer), np.uint32(end_id)).astype("<u4"))
                    row = next(rows, None)
                writer.close()
            yield place, piece, path, len(writer.keys), writer.starts[-1]
            piece += 1

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    order = [F.asc("key"), F.xxhash64("text")]
    dealt = picked.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return stored(mapped(dealt, lambda batches: batches_of(written(rows_of(batches, "key", "text")), schema, 1),
                         "place long, piece long, path string, documents long, ids long"), "tokens-manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the files: start counts the ids of all documents
    before it, the checksum is over all its ids as little-endian 32-bit numbers."""
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def documents(batches: Batches) -> Iterator[tuple]:
        files, _ = shared_files(folder)
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                with files.open_input_file(path) as source:
                    tokens = TokenFile(source)
                    for place, doc in enumerate(tokens.keys):
                        checksum = 0
                        for part in tokens.parts(place):
                            checksum = zlib.crc32(part.tobytes(), checksum)
                        start = int(tokens.starts[place])
                        yield doc, before + start, int(tokens.starts[place + 1]) - start, checksum

    # One row per file: a task's ids, thousands of documents each.
    before = F.coalesce(F.sum("ids").over(Window.orderBy("place", "piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = manifest.select("path", before.cast("long").alias("before")).repartition(tasks)
    return mapped(placed, lambda batches: batches_of(documents(batches), schema), "key long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back."""
    folder = fresh_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer, end_id, key, text), folder).withColumnRenamed("key", key)
