import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reportloom.llm import piece_table as pt
from reportloom.llm.queries import QUERIES


def brute_force(key, text, seed=7, rate=100, spm_rate=50):
    """The contract word by word on strings."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if text == "" or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.none(), st.integers(-5, 10**9)), st.text("ab<>PSM\n\r é😀", max_size=40), st.integers(0, 100), st.integers(0, 100))
def test_one_text(key, text, rate, spm_rate):
    marks, data = pt.Sentinels(), text.encode()
    done = pt.arranged(key, data, 7, rate, spm_rate, marks)
    output = b"".join(pt.views(done.pieces, [data, marks.buffer])).decode()
    assert (*done[:4], output) == brute_force(key, text, 7, rate, spm_rate)
    assert pt.digest(done.pieces, [data, marks.buffer]) == sha(output)
    assert b"".join(pt.views(pt.restore(output.encode(), done.form, marks), [output.encode()])).decode() == text


def test_pieces_are_not_copied():
    marks, text = pt.Sentinels(), b"one\ntwo\nthree"
    pieces = [pt.Piece(pt.TEXT, 0, 13)]
    before, after = pt.split(pieces, 4)
    assert (before, after) == ([(pt.TEXT, 0, 4)], [(pt.TEXT, 4, 9)])
    assert pt.split(after, 0) == ([], after) and pt.split(after, 9) == (after, [])
    assert all(view.obj is text for view in pt.views(before + after, [text]))
    assert [p.buffer for p in pt.arrange([before, [], after], pt.PSM, marks)] == [pt.MARKS, pt.TEXT, pt.MARKS, pt.TEXT, pt.MARKS]


@pytest.mark.parametrize("wrong", [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P<", "<S>", "<M>"), ("a", "ba", "c")])
def test_sentinels_that_could_be_mistaken(wrong):
    with pytest.raises(ValueError):
        pt.Sentinels(*wrong)


def test_odd_documents(odd_docs):
    done = pt.restored(pt.fill_in_middle(odd_docs))
    assert done.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored", "restored_sha256"]
    got = sorted(map(tuple, done.collect()), key=repr)
    want = []
    for row in odd_docs.select("doc_id", "text").collect():
        made = brute_force(row.doc_id, row.text)
        want.append((row.doc_id, *made, sha(made[-1]), row.text or "", sha(row.text)))
    assert got == sorted(want, key=repr)


def test_no_documents_and_other_keys(spark, no_docs):
    assert pt.restored(pt.fill_in_middle(no_docs)).count() == 0
    named = spark.createDataFrame([("x", "a\nb\nc\n", 1), (None, None, 2)], "`my id` string, body string, n int")
    got = {r["my id"]: r for r in pt.fill_in_middle(named, key="my id", text="body").collect()}
    assert got["x"].output == brute_force("x", "a\nb\nc\n")[-1]
    assert (got[None].n, got[None].form) == (0, "plain")


def test_restored_replaces_its_own_names(spark):
    done = spark.createDataFrame([("<P>a<S>c<M>b", "psm", "old", {"k": 1}), (None, None, "old", None), ("x", "plain", None, {})],
                                 "output string, form string, restored string, extra map<string,int>")
    got = pt.restored(done).collect()
    assert [r.restored for r in got] == ["abc", "", "x"]
    assert [r.extra for r in got] == [{"k": 1}, None, {}]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op13_fill_in_middle"](spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        *head, output = brute_force(row.doc_id, texts[row.doc_id])
        assert (row.n, row.form, row.prefix_chars, row.middle_chars) == tuple(head)
        assert (row.output_sha256, row.restored_sha256) == (sha(output), sha(texts[row.doc_id]))
