"""WARC archives: a writer, a normaliser for archives that are one gzip stream, and a reader by offset index.

Every task writes its pages as an archive compressed as a whole, then inflates it once and rewrites each record as a
gzip member of its own, next to a sidecar index (record, offset, length). With the index any record can be read
alone. Pages with equal payloads are stored once: that with the largest id is a ``response``, the others
``revisit`` records that refer to it and hold only the HTTP headers.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.storage import Batches, batches_of, mapped, shared_files, sliced, stored, write_attempt
from reportloom.session import fresh_folder

# Fixed values of the format.
VERSION = b"WARC/1.1"
LINE = b"\r\n"
END = b"\r\n\r\n"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2000-01-01T00:00:00Z"  # pages carry no time of capture

CHUNK = 1 << 20
ARCHIVE_BYTES = 1 << 28  # payload after which a task starts its next archive
INDEX_FIELDS = [("record", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def page_of(record: str) -> int | None:
    number = record.removeprefix("urn:page:")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record; a revisit of the page ``refers_to`` unless that is the page itself."""
    revisit = refers_to != page_id
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    block = http if revisit else http + payload
    head = [VERSION, b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: <%s>" % record_id(page_id).encode(),
            b"WARC-Date: " + DATE, b"WARC-Target-URI: " + b"".join((url or "").encode().split()),
            b"WARC-Payload-Digest: sha1:" + digest(payload).encode(), b"Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: <%s>" % record_id(refers_to).encode()]
    return LINE.join([*head, b"Content-Length: %d" % len(block)]) + END + block + END


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in pieces of bounded size."""
    engine, data = zlib.decompressobj(wbits=31), b""
    while data := data or source.read(CHUNK):
        piece = engine.decompress(data, CHUNK)
        if piece:
            yield piece
        data = engine.unconsumed_tail
        if engine.eof:
            data, engine = engine.unused_data, zlib.decompressobj(wbits=31)
    if tail := engine.flush():
        yield tail


def _fields(head: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in head.split(LINE)[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class _Pieces:
    """Bytes taken by count or up to a mark from an iterator of pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, bytearray()

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is not None:
            self.held += piece
        return piece is not None

    def upto(self, mark: bytes) -> bytes:
        """Up to and with the mark; empty at the end of the input."""
        searched = 0
        while (at := self.held.find(mark, searched)) < 0:
            searched = max(0, len(self.held) - len(mark))
            if not self._more():
                if self.held.strip():
                    raise ValueError("an archive ends within a record's header")
                return b""
        return self.take(at + len(mark))

    def parts(self, count: int) -> Iterator[bytes]:
        while count:
            if not self.held and not self._more():
                raise ValueError("an archive ends within a record")
            part = bytes(self.held[:min(count, CHUNK)])
            del self.held[:len(part)]
            count -= len(part)
            yield part

    def take(self, count: int) -> bytes:
        return b"".join(self.parts(count))


def normalise(source: BinaryIO, target: BinaryIO) -> Iterator[tuple[str, int, int]]:
    """Inflate ``source`` once, write each record to ``target`` as its own gzip member and yield the sidecar index
    (record id, offset, length). No more than a piece of a record is held, whatever its length."""
    pieces, offset = _Pieces(inflated(source)), 0
    while head := pieces.upto(END):
        fields = _fields(head)
        engine, length = zlib.compressobj(6, wbits=31), 0
        length += target.write(engine.compress(head))
        for part in pieces.parts(int(fields[b"content-length"]) + len(END)):
            length += target.write(engine.compress(part))
        length += target.write(engine.flush())
        yield fields[b"warc-record-id"].strip(b"<>").decode(), offset, length
        offset += length


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` as normalised archives with sidecar indexes below ``folder``; returns the manifest
    (archive, index, records), already written, so nothing is written twice by reading it.

    Of the pages with equal payloads that with the largest id is the response; rows repeated with that id and payload
    are each written as response. A NULL html is an empty payload, a NULL url an empty URI; NULL ids count as the
    smallest. Other columns are ignored.
    """
    schema = pa.schema([("archive", pa.string()), ("index", pa.string()), ("records", pa.int64())])

    def work(batches: Batches) -> Batches:
        files, base = shared_files(folder)
        rows = (row for b in sliced(batches, 64) for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True))
        return batches_of(_archives(files, base, rows, archive_bytes), schema, 1)

    picked = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    digested = picked.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    shared = stored(digested.groupBy("sha1").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").select("sha1", "newest"), "shared-payloads")
    known = digested.join(shared, "sha1", "left")
    refers = F.when(F.col("newest").isNull(), F.col("page_id")).otherwise(F.col("newest")).alias("refers_to")
    return stored(mapped(known.select("page_id", "url", "html", refers), work, "archive string, index string, records long"),
                  "archives-manifest")


def _archives(files, folder: str, rows: Iterator[tuple], archive_bytes: int) -> Iterator[tuple[str, str, int]]:
    """Write one archive after the other; each first whole in one gzip stream, then normalised."""
    row = next(rows, None)
    while row is not None:
        whole = write_attempt(files, folder, ".whole.warc.gz")
        engine, size = zlib.compressobj(1, wbits=31), 0
        with files.open_output_stream(whole, compression=None) as out:
            while row is not None and size < archive_bytes:
                text = record(row[0], row[1], row[2].encode(), row[3])
                out.write(engine.compress(text))
                size += len(text)
                row = next(rows, None)
            out.write(engine.flush())
        archive = whole.replace(".whole.", ".")
        index = archive.replace(".warc.gz", ".index.parquet")
        with files.open_input_stream(whole, compression=None) as source, files.open_output_stream(archive, compression=None) as out:
            entries = list(normalise(source, out))
        columns = zip(*entries, strict=True)
        pq.write_table(pa.table([pa.array(c, t) for c, (_, t) in zip(columns, INDEX_FIELDS, strict=True)],
                                schema=pa.schema(INDEX_FIELDS)), index, filesystem=files)
        files.delete_file(whole)
        yield archive, index, len(entries)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of the archives below
    ``folder`` that the manifest names, read member by member through the indexes."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def records(batches: Batches) -> Iterator[tuple]:
        files, _ = shared_files(folder)
        for batch in batches:
            for archive, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist(), strict=True):
                entries = pq.read_table(index, filesystem=files)
                with files.open_input_file(archive) as source:
                    for offset, length in zip(entries["offset"].to_pylist(), entries["length"].to_pylist(), strict=True):
                        source.seek(offset)
                        yield read_record(source.read(length))

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mapped(manifest.repartition(tasks), lambda batches: batches_of(records(batches), schema),
                  "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def read_record(member: bytes) -> tuple[int | None, int, str, str, int | None]:
    """A record from its gzip member. The payload of a response is measured and hashed; that of a revisit is known by
    its headers."""
    head, _, rest = b"".join(inflated(io.BytesIO(member))).partition(END)
    fields = _fields(head)
    http, _, payload = rest[:int(fields[b"content-length"])].partition(END)
    kind, page = fields[b"warc-type"].decode(), page_of(fields[b"warc-record-id"].strip(b"<>").decode())
    if kind == "response":
        if digest(payload) != fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode():
            raise ValueError(f"record {page}: the payload does not fit its digest")
        return page, len(payload), digest(payload), kind, None
    return (page, int(_fields(http)[b"content-length"]), fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode(), kind,
            page_of(fields[b"warc-refers-to"].strip(b"<>").decode()))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    folder = fresh_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
