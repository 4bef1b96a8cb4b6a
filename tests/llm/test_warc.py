import base64
import gzip
import hashlib
import io
import zlib
from collections import Counter

import pytest

from reportloom.llm import warc
from reportloom.session import fresh_folder

PAGES = "page_id long, url string, html string, payload_digest string, offset int"


def want(rows):
    newest = {}
    for page, _, html in rows:
        newest[html or ""] = max(newest.get(html or "", -10**18), -10**18 if page is None else page)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        top = None if newest[html or ""] == -10**18 else newest[html or ""]
        revisit = page != top
        out.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return Counter(out)


@pytest.fixture
def rows(prose):
    texts = [None, "", "a", "a", "<html>\r\n\r\nWARC/1.1\r\n</html>", "é" * 3, prose(1, 400), prose(1, 400), "x" * 3_000_000]
    pages = [(i * 3, f"http://x.example/{i} é", t) for i, t in enumerate(texts)]
    return [*pages, pages[3], (-5, None, "a"), (None, "http://none", "a"), (None, None, "alone")]


def test_round_trip(spark, rows):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)
    assert Counter(map(tuple, warc.round_trip(pages).collect())) == want(rows)


def test_no_rows(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_members_and_index(spark, rows):
    folder = fresh_folder(spark, "warc")
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES).coalesce(1)
    manifest = warc.write_archives(pages, folder, archive_bytes=2000)
    found = 0
    for m in manifest.collect():
        with open(m["archive"], "rb") as source:
            whole = source.read()
        entries = spark.read.parquet(m["index"]).collect()
        assert sum(e.length for e in entries) == len(whole) and len(entries) == m["records"]
        for e in entries:
            text = gzip.decompress(whole[e.offset:e.offset + e.length])
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and f"<{e.record}>".encode() in text
        assert gzip.decompress(whole).count(b"WARC-Record-ID") == len(entries)
        found += len(entries)
    assert found == len(rows) and manifest.count() > 1
    assert Counter(map(tuple, warc.read_archives(manifest, folder).collect())) == want(rows)


def test_normalise_one_stream():
    records = [warc.record(i, "http://x", b"p" * i * 700_000, i if i % 2 else 99) for i in range(4)]
    for source in (gzip.compress(b"".join(records)), gzip.compress(records[0]) + gzip.compress(b"".join(records[1:]))):
        out = io.BytesIO()
        entries = list(warc.normalise(io.BytesIO(source), out))
        assert [gzip.decompress(out.getvalue()[o:o + n]) for _, o, n in entries] == records
        assert [warc.page_of(r) for r, _, _ in entries] == [0, 1, 2, 3]


def test_cut_archives_are_refused():
    text = warc.record(1, "u", b"payload" * 100, 1)
    for cut in (10, len(text) - 60):
        with pytest.raises(ValueError):
            list(warc.normalise(io.BytesIO(gzip.compress(text[:cut])), io.BytesIO()))


def test_changed_payload_is_refused():
    text = warc.record(1, "u", b"payload", 1).replace(b"payload", b"PAYLOAD", 1).replace(b"\r\n\r\npayload", b"\r\n\r\npayloaD")
    with pytest.raises(ValueError):
        warc.read_record(gzip.compress(text))


def test_inflated_is_bounded():
    data = zlib.compress(b"0" * 50_000_000, wbits=31)
    pieces = list(map(len, warc.inflated(io.BytesIO(data))))
    assert sum(pieces) == 50_000_000 and max(pieces) <= warc.CHUNK
