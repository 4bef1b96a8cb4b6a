import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reportloom.llm import variants as v
from reportloom.llm.queries import QUERIES, SQL


def counted(rows, least_chars=7, least_count=2, every=31):
    """Words of (key, text) rows, the contract word by word."""
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_chars and n >= least_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_force(words, ratio=10):
    rows, forms = [], {}
    for w, n in words.items():
        near = sorted((x for x in words if one_edit(w, x)), key=lambda x: (-words[x], x))
        fits = near and words[near[0]] >= ratio * n
        forms[w] = near[0] if fits else None
        rows.append((w, forms[w], n, len(near), words[near[0]] if fits else None))
    out = []
    for w, form, n, near, form_n in rows:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, form, root, n, near, form_n))
    return sorted(out)


def got(spark, words, **options):
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    return sorted(map(tuple, v.grouped(table, **options).collect()))


@pytest.mark.parametrize("seed,letters,longest", [(1, "ab", 5), (2, "abcé", 7), (3, "aß", 11), (4, "abcdefgh", 4)])
def test_drawn_words(spark, seed, letters, longest):
    """Short words over few letters: all kinds of edits at all places, words that begin one another."""
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(1, longest))): draw.choice([2, 3, 20, 25, 200, 3000]) for _ in range(250)}
    assert got(spark, words) == brute_force(words)


def test_ties_chains_and_other_alphabets(spark):
    words = {"colours": 2, "colour": 20, "color": 200, "colon": 200, "colo": 1, "日本語": 5, "日本": 50, "😀x": 3, "😀": 30, "x" * 30: 1, "x" * 31: 10, "x" * 29: 10}
    rows = got(spark, words)
    assert rows == brute_force(words)
    assert {r[0]: r[2] for r in rows}["colours"] == "color"


def test_hot_nodes_are_salted(spark, monkeypatch):
    monkeypatch.setattr(v, "WORDS_A_SALT", 3)
    draw = random.Random(6)
    words = {"pre" + "".join(draw.choice("abc") for _ in range(draw.randint(3, 5))): draw.randint(1, 100) for _ in range(200)}
    assert got(spark, words) == brute_force(words)


def test_very_long_words(spark):
    base = "".join(random.Random(7).choice("acgt") for _ in range(3000))
    words = {base: 100, base[:1500] + base[1501:]: 2, base + "a": 3, "t" + base[1:]: 4, base[:2999]: 1, base[:1000]: 9}
    assert got(spark, words) == brute_force(words)


def test_no_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert v.grouped(empty).collect() == []
    odd = spark.createDataFrame([(None, 3), ("", 4), ("one", None)], "word string, n long")
    assert [tuple(r) for r in v.grouped(odd).collect()] == [("one", None, "one", 0, 0, None)]
    with pytest.raises(ValueError):
        v.grouped(empty, ratio=1)


@pytest.mark.parametrize("every,held", [(31, 200_000), (3, 5), (0, 1)])
def test_counting(odd_docs, monkeypatch, every, held):
    monkeypatch.setattr(v, "WORDS_HELD", held)
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    rows_found = v.word_counts(odd_docs, least_chars=4, every=every).collect()
    assert {r.word: r.n for r in rows_found} == counted(rows, least_chars=4, every=every)
    assert len({r.word for r in rows_found}) == len(rows_found)


def test_letters_and_case(spark):
    docs = spark.createDataFrame([(1, "ÀÉcole ÀÉCOLE straße-Straße STRASSE×÷x"), (None, None), (2, "ÀÉcole")], "doc_id long, text string")
    got_words = {r.word: r.n for r in v.word_counts(docs, least_chars=3, every=0, least_count=1).collect()}
    assert got_words == {"ÀÉcole": 3, "straße": 2, "strasse×÷x": 1}


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    found = sorted(map(tuple, v.grouped(v.word_counts(odd_docs, least_chars=3)).collect()))
    assert found == brute_force(counted(rows, least_chars=3))
    assert v.grouped(v.word_counts(no_docs)).count() == 0


def test_query_is_registered_with_sql(spark):
    assert "op12_spelling_variants" in SQL
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.col("doc_id") < 60)
    words = counted([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, v.grouped(v.word_counts(docs)).collect())) == brute_force(words)
    assert QUERIES["op12_spelling_variants"](spark, sf).columns == ["word", "form", "root", "n", "n_near", "form_n"]
