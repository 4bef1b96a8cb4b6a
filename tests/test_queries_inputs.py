"""What queries make of their input tables, whatever shape these have."""

import hashlib
from pathlib import Path

import pyarrow as pa

import queries.redaction as Q
import queries.storage as W
from reportloom.sources import readers as S

ROWS = [(1, "call 8 912 345 67 89 or write to a@b.org", "en", "src0"), (2, None, "de", None), (3, "plain\r\ntext\n", "fr", "a:b/c=d"), (4, "", "en", "")]


def documents(spark, folder):
    spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_streams_read_a_table_that_is_a_folder(spark, tmp_path):
    """The table is a folder of files here, a single file in the given tables."""
    got = {r.doc_id: r.redacted for r in Q.stream_redacted(spark, documents(spark, tmp_path)).collect()}
    assert len(got) == 4 and "[EMAIL]" in got[1]
    assert {r.label for r in Q.stream_label_counts(spark, str(tmp_path)).collect()} >= {"EMAIL"}


def test_report_files_are_what_spark_would_write(spark, tmp_path):
    root = Path(W.report_files(spark, documents(spark, tmp_path)).removeprefix("file:"))
    found = sorted((f.parent.name, f.read_bytes()) for f in root.rglob("*") if f.is_file())  # no other files, such as checksums
    null = "source=__HIVE_DEFAULT_PARTITION__"
    assert found == [(null, b"\n"), (null, b"\n"), ("source=a%3Ab%2Fc%3Dd", b"plain\r\ntext\n\n"), ("source=src0", ROWS[0][1].encode() + b"\n")]
    spark.createDataFrame([r[1:] for r in ROWS], "text string, lang string, source string").select("source", "text").write.partitionBy("source").text(str(tmp_path / "plain"))
    assert {p.name for p in (tmp_path / "plain").glob("source=*")} == {f for f, _ in found}
    read = {(r.folder, r.content_md5) for r in W.report_files_read(spark, str(tmp_path)).collect()}
    assert read == {(f, hashlib.md5(b).hexdigest()) for f, b in found}


def test_small_files_share_a_batch_and_large_ones_do_not(monkeypatch):
    monkeypatch.setattr(S, "FILES_AT_ONCE", 3)
    monkeypatch.setattr(S, "BYTES_AT_ONCE", 10)
    schema = pa.schema([("path", pa.string()), ("bytes", pa.binary()), ("error", pa.string())])
    rows = [(str(i), b"x" * n, None) for i, n in enumerate([1, 1, 1, 1, 20, 9, 2])] + [("e", None, "unreadable")]
    got = list(S._in_batches(iter(rows), schema))
    assert [b.num_rows for b in got] == [3, 1, 1, 1, 2]
    assert [r for b in got for r in zip(*(c.to_pylist() for c in b.columns))] == rows
