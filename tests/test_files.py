"""Readers, writers and streams on real files."""

import json

import pytest
from pyspark.sql import functions as F

from reportloom.fixed_values import RESULT_COLUMNS
from reportloom.plans.anonymise import anonymise_folder
from reportloom.session import fresh_folder, shared_folder
from reportloom.sources import listing as L
from reportloom.sources import readers as S
from reportloom.sources import writers as K
from reportloom.streaming.redaction import count_labels_stream, read_label_counts, redact_stream


@pytest.fixture()
def reports(tmp_path):
    files = {"МРТ/гм/a.txt": "a@b.com\n".encode(), "МРТ/гм/b.TXT": b"ok\xff 12.03.2020", "КТ/empty.txt": b"",
             "КТ/c.pdf": b"%PDF", "КТ/d.xlsx": b"x", "top.txt": "тел".encode()}
    for name, content in files.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return str(tmp_path / "in")


def test_report_files(spark, reports):
    rows = {r.rel_path: (r.content, r.status, r.error) for r in S.read_report_files(spark, reports).collect()}
    assert rows == {
        "МРТ/гм/a.txt": ("a@b.com\n", "ok", None), "МРТ/гм/b.TXT": ("ok 12.03.2020", "ok", None),
        "КТ/empty.txt": ("", "ok", None), "КТ/c.pdf": (None, "failed", "no decoder for .pdf"), "КТ/d.xlsx": (None, "skipped", None), "top.txt": ("тел", "ok", None)}


def test_unreadable_files_are_rows(spark, reports, tmp_path):
    (tmp_path / "in" / "gone.txt").symlink_to(tmp_path / "nowhere")
    (tmp_path / "in" / "007").mkdir()
    (tmp_path / "in" / "007" / "b c+é.txt").write_text("x")
    rows = {r.rel_path: (r.content, r.status) for r in S.read_report_files(spark, "file://" + reports + "/").collect()}
    assert rows["gone.txt"] == (None, "failed") and rows["007/b c+é.txt"] == ("x", "ok") and len(rows) == 8
    target = str(tmp_path / "out")
    anonymise_folder(spark, reports, target)
    assert {r.error for r in spark.read.json(target + "/summary/failures").collect() if r.rel_path == "gone.txt"}


def test_text_reports_skip_empty_and_other_suffixes(spark, reports):
    found = S.read_text_reports(spark, reports).collect()
    assert sorted(r.path[len(reports) + 1:] for r in found) == ["top.txt", "МРТ/гм/a.txt"]
    assert {r.folder for r in found} == {reports, reports + "/МРТ/гм"}


def test_anonymise_folder(spark, reports, tmp_path):
    target = str(tmp_path / "out")
    anonymise_folder(spark, reports, target)
    texts = {r.out_path: r.text for r in spark.read.parquet(target + "/texts").collect()}
    assert texts == {"МРТ/гм/a.txt": "[EMAIL]\n", "МРТ/гм/b.txt": "ok [DATE]", "top.txt": "тел", "КТ/empty.txt": ""}
    assert spark.read.json(target + "/summary/totals").first().asDict() == {"files_processed": 5, "total_replacements": 2}
    assert {(r.label, r.n) for r in spark.read.json(target + "/summary/labels").collect()} == {("EMAIL", 1), ("DATE", 1)}
    assert [r.error for r in spark.read.json(target + "/summary/failures").collect()] == ["no decoder for .pdf"]


def test_empty_tree(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert S.compile_result_tables(spark, str(tmp_path / "none")) is None
    assert K.write_compiled(None, str(tmp_path / "combined"), spark) == 0


def test_compile_result_tables(spark, tmp_path):
    files = {
        "raw/mrt_1/гм/processed_results.csv": 'finding,file_name,result\n"a ""q"",\nb",x.txt,r1\n,y.txt,r2\n',
        "raw/КТ/печень + 1/Processed_Result.CSV": "﻿result,finding,,extra\nr3,f3,drop,e\n",
        "raw/КТ/печень + 1/other.csv": "finding\nno\n",
        "raw/x/y/processed_result.csv": "",
    }
    for name, content in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content, encoding="utf-8")
    found = S.find_result_tables(spark, str(tmp_path / "raw"))
    assert found.count() == 3
    table = S.compile_result_tables(spark, str(tmp_path / "raw"))
    assert table.columns == ["origin_folder", "modality", "extra", "file_name", "finding", "result"]
    rows = {tuple(r) for r in table.collect()}
    assert rows == {("гм", "МРТ", "", "x.txt", 'a "q",\nb', "r1"), ("гм", "МРТ", "", "y.txt", "", "r2"), ("печень + 1", "КТ", "e", "", "f3", "r3")}
    out = str(tmp_path / "combined")
    assert K.write_compiled(table, out, spark) == 3
    assert {tuple(r) for r in S.read_csv(spark, out).collect()} == rows


def test_headers_that_differ_in_case(spark, tmp_path):
    for name, content in {"a/b/processed_result.csv": "Finding,finding\n1,2\n", "a/c/processed_result.csv": "finding\n3\n"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(content)
    table = S.compile_result_tables(spark, str(tmp_path / "a"))
    assert table.columns == ["origin_folder", "modality", "Finding", "finding__2"]
    assert {tuple(r)[2:] for r in table.collect()} == {("1", "2"), ("", "3")}


def test_many_split_names(spark, tmp_path):
    labels = [f"s{i}" for i in range(40)] + ["train", "eval"]
    spark.createDataFrame([(x, x) for x in labels], "text string, split string").write.partitionBy("split").parquet(str(tmp_path / "s"))
    assert {k: v.collect()[0][0] for k, v in S.read_splits(spark, str(tmp_path / "s")).items()} == {"train": "train", "eval": "eval"}


def test_jsonl_skips_blank_lines_and_fails_on_bad_ones(spark, tmp_path):
    good = tmp_path / "g.jsonl"
    good.write_text('{"id": 1, "finding": "кт"}\n\n   \n{"id": 2, "result": "r"}\n', encoding="utf-8")
    rows = S.read_rows(spark, str(good)).orderBy("id").collect()
    assert [(r.id, r.finding, r.reference, r.modality) for r in rows] == [("1", "кт", "", "КТ"), ("2", "", "r", "")]
    bad = tmp_path / "b.jsonl"
    bad.write_text('{"id": 1}\n{oops\n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_jsonl(spark, str(bad), "id int").collect()
    with pytest.raises(ValueError):
        S.read_rows(spark, str(good), fmt="xml")


def test_pairs_by_folder(spark, tmp_path):
    df = spark.createDataFrame([("007", 'a"b\nc', "x.txt", "р"), ("12", "", "y.txt", "")], "folder string, finding string, file_name string, result string")
    K.write_pairs_by_folder(df, str(tmp_path / "p"))
    back = S.read_pairs_by_folder(spark, str(tmp_path / "p"))
    assert {tuple(r) for r in back.select("folder", *RESULT_COLUMNS).collect()} == {tuple(r) for r in df.collect()}


def test_splits_from_files(spark, tmp_path):
    df = spark.createDataFrame([("a", "train"), ("b", "eval")], "text string, split string")
    K.write_splits(df, str(tmp_path / "s"))
    assert {k: v.collect()[0][0] for k, v in S.read_splits(spark, str(tmp_path / "s")).items()} == {"train": "a", "eval": "b"}
    K.write_jsonl(df.select("text"), str(tmp_path / "t"))
    assert set(S.read_splits(spark, train=str(tmp_path / "t"))) == {"train"}


def test_jsonl_keeps_other_scripts(spark, tmp_path):
    K.write_jsonl(spark.createDataFrame([("кт",)], "t string").coalesce(1), str(tmp_path / "j"))
    lines = [p.read_text(encoding="utf-8") for p in (tmp_path / "j").glob("part-*")]
    assert json.loads("".join(lines)) == {"t": "кт"} and "кт" in "".join(lines)


def test_stream_equals_batch(spark, tmp_path):
    texts = spark.createDataFrame([(i, f"u{i}@mail.ru 12.03.2020" if i % 3 else "-") for i in range(60)], "id int, text string")
    source = str(tmp_path / "in")
    texts.write.parquet(source)
    read = lambda: spark.readStream.schema("id int, text string").parquet(source)
    redact_stream(read(), str(tmp_path / "out"), str(tmp_path / "ck1")).awaitTermination()
    from reportloom.operators.redaction import counts_by_label, redact

    batch = redact(texts)
    same = ["id", "redacted", F.col("spans.label").alias("labels")]
    assert sorted(spark.read.parquet(str(tmp_path / "out")).select(*same).collect()) == sorted(batch.select(*same).collect())
    for _ in range(2):  # a second run with more input adds to the counts
        count_labels_stream(read(), str(tmp_path / "n"), str(tmp_path / "ck2")).awaitTermination()
        want = {r.label: r.n for r in counts_by_label(redact(spark.read.parquet(source))).collect()}
        assert {r.label: r.n for r in read_label_counts(spark, str(tmp_path / "n")).collect()} == want
        texts.write.mode("append").parquet(source)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    one, other = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert one.startswith(shared_folder(spark)) and one != other


def test_tree_level_by_level(spark, tmp_path, monkeypatch):
    """Deep and wide trees, more entries than a batch holds, links, folders that cannot be read, names with blanks."""
    monkeypatch.setattr(L, "ENTRIES", 7)
    root, want = tmp_path / "tree", {}
    folder = root
    for depth in range(12):
        folder = folder / f"level {depth}"
        for i in range(9):
            (folder / f"side{i}").mkdir(parents=True)
            (folder / f"side{i}" / f"f{i}.txt").write_text("x" * i)
            want[str(folder / f"side{i}" / f"f{i}.txt")] = (i, None)
    for i in range(40):
        (root / f"{i}é.csv").write_text("ab")
        want[str(root / f"{i}é.csv")] = (2, None)
    (root / "level 0" / "up").symlink_to(root)  # following it would never end
    want[str(root / "level 0" / "up")] = (0, "folder: a link")
    (root / "gone.txt").symlink_to(root / "nowhere")
    want[str(root / "gone.txt")] = (0, "unreadable")
    (root / "same.csv").symlink_to(root / "1é.csv")
    want[str(root / "same.csv")] = (2, None)
    (root / "empty" / "emptier").mkdir(parents=True)
    found = S.list_files(spark, f"file://{root}/").collect()
    assert {r.path: (r.size, r.error) for r in found} == want and len(found) == len(want)
    files = {r.path: r for r in S.read_report_files(spark, str(root)).collect()}
    assert (files[str(root / "level 0" / "up")].status, files[str(root / "level 0" / "up")].error) == ("failed", "folder: a link")
    with pytest.raises(Exception, match="FileNotFoundError"):
        S.list_files(spark, str(tmp_path / "nowhere")).count()


def test_folders_that_cannot_be_read(spark, tmp_path):
    listed = list(L._listed(L.fs.LocalFileSystem(), str(tmp_path / "lost"), False))
    assert listed == [(str(tmp_path / "lost"), 0, "folder: FileNotFoundError", False)]


def test_one_walk_per_read(spark, reports, monkeypatch):
    calls = []
    real = L.list_files
    monkeypatch.setattr(S, "list_files", lambda *a: calls.append(a) or real(*a))
    frame = S.read_report_files(spark, reports)
    assert len(calls) == 1 and frame.count() == 6 and frame.count() == 6
    assert "MapInArrow" not in S.list_files(spark, reports)._jdf.queryExecution().executedPlan().toString()


def test_headers_by_name(spark, tmp_path):
    """Quoted line breaks and quotes in headers, repeated and blank names, short, long and blank rows, CRLF, bad bytes, no rows."""
    files = {"m/a/processed_result.csv": b'"x\ny","q""r",x\r\n1,"2\r\n3",4,5\r\n\r\n6\r\n', "m/b/processed_result.csv": b"k,k, ,z\nfirst,second,blank,\xffend",
             "m/c/processed_result.csv": b"only,header\n", "m/d/processed_result.csv": b" , \n1,2\n", "m/e/processed_result.csv": b"\n"}
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(parents=True)
        (tmp_path / name).write_bytes(content)
    table = S.compile_result_tables(spark, str(tmp_path))
    assert table.columns == ["origin_folder", "modality", "header", "k", "only", 'q"r', "x", "x\ny", "z"]
    assert {tuple(r) for r in table.collect()} == {
        ("a", "M", "", "", "", "2\r\n3", "4", "1", ""), ("a", "M", "", "", "", "", "", "6", ""), ("b", "M", "", "first", "", "", "", "", "\ufffdend")}


def test_plan_does_not_grow_with_the_headers(spark, tmp_path):
    for i in range(60):
        folder = tmp_path / "m" / f"f{i}"
        folder.mkdir(parents=True)
        names = [f"c{j}" for j in range(6) if i >> j & 1] + ["z"]
        (folder / "processed_result.csv").write_text(",".join(names) + "\n" + ",".join(names) + "\n")
    table = S.compile_result_tables(spark, str(tmp_path))
    assert table.count() == 60 and len(table.columns) == 9
    assert table._jdf.queryExecution().optimizedPlan().toString().count("CASE") <= 9
    assert table.where("c3 = 'c3'").count() == sum(i >> 3 & 1 for i in range(60))
