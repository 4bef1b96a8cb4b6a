"""Dictionary redaction against a plain search."""

import random
import re
import time

import numpy as np
import pytest

from reportloom.fixed_values import PII_PATTERNS
from reportloom.operators.redaction import RegexStage
from reportloom.operators import terms as T
from reportloom.operators.terms import _grams, _marked, redact_terms, spelled_terms, term_matches
from tests.test_redaction import expected

ALPHABET = ["anna", "Anna", "BERG", "berg", "von", "Ünal", "x9", "a_b", "mail", "7"]
GAPS = [" ", "  ", "-", "\n", ". ", "😀"]


def brute(text, terms):
    """Spans (start, end, label, original) of patterns and terms, overlapping ones united."""
    spans = [(m.start(), order, m.end(), label, m.group())
             for order, (label, regex) in enumerate(PII_PATTERNS) for m in re.finditer(regex, text)]
    words = list(re.finditer(r"\w+", text))
    for i, first in enumerate(words):
        fits = []
        for term, label in terms:
            wanted = [w.lower() for w in re.findall(r"\w+", term or "")]
            here = words[i:i + len(wanted)]
            if label and wanted and [w.group().lower() for w in here] == wanted:
                fits.append((-len(wanted), label, here[-1].end()))
        if fits:
            _, label, end = min(fits)
            spans.append((first.start(), len(PII_PATTERNS), end, label, text[first.start():end]))
    merged = []
    for start, _, end, label, original in sorted(spans):
        if not merged or start >= merged[-1][1]:
            merged.append([start, end, label, original])
        elif end > merged[-1][1]:
            merged[-1][1] = end
            merged[-1][3] += "|" + original
    return merged


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_random_texts(spark, threshold):
    rng = random.Random(5)
    some = lambda n: "".join(rng.choice(ALPHABET) + rng.choice(GAPS) for _ in range(n))
    texts = [some(rng.randrange(0, 40)) + rng.choice(["", "c@d.org", "12.03.2020 "]) for _ in range(120)]
    terms = [(some(rng.randrange(1, 4)), rng.choice(["NAME", "TERM"])) for _ in range(60)]
    terms += [(None, "X"), ("", "X"), ("...", "X"), ("anna", None), terms[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(5)
    table = spark.createDataFrame(terms, "term string, label string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)  # -1: terms and texts meet by shuffles
    try:
        rows = redact_terms(df, table).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) == len(texts)
    for row in rows:
        assert [list(s) for s in row.spans] == brute(row.text, terms)


def test_defined_cases(spark):
    """NULL, empty and repeated texts, NULL keys, columns of like names, no terms, no patterns."""
    long_text = "word " * 60_000 + "Anna Berg"
    rows = [(None, None, "a"), (1, "", "b"), (1, "see Anna\tBERG", "c"), (1, "see Anna\tBERG", "c"), (None, "see Anna\tBERG", "d"),
            (2, long_text, "e")]
    df = spark.createDataFrame(rows, "id int, text string, digest string")
    table = spark.createDataFrame([("anna berg", "NAME"), ("Anna", "FIRST")], "term string, label string")
    done = redact_terms(df, table, RegexStage(patterns=()))
    assert done.columns == ["id", "text", "digest", "spans", "redacted"]
    got = sorted((r.digest, r.redacted) for r in done.collect() if r.id != 2)
    assert got == sorted([("a", None), ("b", ""), ("c", "see [NAME]"), ("c", "see [NAME]"), ("d", "see [NAME]")], key=repr)
    (far,) = done.filter("id = 2").collect()
    assert [list(s) for s in far.spans] == [[300_000, 300_009, "NAME", "Anna Berg"]]
    none = redact_terms(df, table.limit(0))
    assert [(r.text, r.redacted) for r in none.filter("id = 2").collect()] == [(long_text, expected(long_text)[0])]
    assert redact_terms(df.limit(0), table).count() == 0


def test_one_row_a_term(spark):
    table = spark.createDataFrame([("Anna  Berg", "B"), ("anna-BERG", "A"), (" ", "C")], "term string, label string")
    assert [tuple(r) for r in spelled_terms(table).collect()] == [("anna berg", 2, "A")]


def test_only_runs_that_may_be_terms_leave_their_task(spark):
    draw = random.Random(11)
    text = " ".join("".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(5000))
    texts = spark.createDataFrame([(b"1", text)], "digest binary, text string")
    words = text.split()
    wanted = {words[7], " ".join(words[40:43]), words[-1]}
    known = spark.createDataFrame([(w,) for w in wanted] + [(f"other {i}",) for i in range(3000)], "gram string")
    marks = _marked(known)
    grams = [r.gram for r in _grams(texts, [1, 3], marks).collect()]
    assert wanted <= set(grams) and len(grams) < 1500 and np.unpackbits(marks).sum() > 2500


def test_few_runs_that_are_no_terms_leave_their_task(spark):
    draw = random.Random(12)
    words = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(5000)]
    texts = spark.createDataFrame([(b"1", " ".join(words))], "digest binary, text string")
    wanted = {words[7], " ".join(words[40:43])}
    known = spark.createDataFrame([(w,) for w in wanted] + [(f"other {i}",) for i in range(3000)], "gram string")
    grams = [r.gram for r in _grams(texts, [1, 3], _marked(known)).collect()]
    assert wanted <= set(grams) and len(grams) < 100


def test_matches_are_written_and_their_shuffles_dropped(spark):
    """Whole texts are shuffled beside the matches alone, not beside runs of words and terms."""
    df = spark.createDataFrame([(1, "see Anna BERG"), (2, "anna")], "id int, text string")
    table = spark.createDataFrame([("anna berg", "NAME"), ("Anna", "FIRST")], "term string, label string")
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in map(blocks.getAllFiles().apply, range(blocks.getAllFiles().size()))}
    before = files()
    found = term_matches(df, table)
    for _ in range(50):  # files go in the background
        left = [f for f in files() - before if f.startswith("shuffle_")]
        time.sleep(0.1 if left else 0)
    assert not left
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" not in plan
    got = sorted([tuple(m) for m in r.matches] for r in found.collect())
    assert got == [[(0, 4, "FIRST")], [(4, 13, "NAME")]]


@pytest.mark.parametrize("size", [1, 7, 60, 1 << 18])
def test_texts_in_parts(monkeypatch, size):
    """Whatever the size of parts, runs are found once; letters whose lower case is longer or depends on what follows."""
    monkeypatch.setattr(T, "CHARS_AT_ONCE", size)
    draw = random.Random(3)
    some = ["Anna", "BERG", "\u0130x", "A\u03a3", "\u03a3", "i", "\u0307", "\ufdd0", "7", "\U0001f600", "\u00dc_"]
    texts = ["".join(draw.choice(some) + draw.choice(["", " ", ".", "\n-"]) for _ in range(draw.randrange(60))) for _ in range(40)]
    everything = np.full(T.LEAST_BITS // 8, 255, np.uint8)
    parts = [part for i, text in enumerate(texts) for part in T._parts(str(i).encode(), text, 3)]
    got = [(int(r["digest"]), r["start"], r["end"], r["gram"]) for b in T._candidates(parts, [1, 3], everything) for r in b.to_pylist()]
    wanted = []
    for i, text in enumerate(texts):
        words = list(re.finditer(r"\w+", text))
        wanted += [(i, words[k].start(), words[k + n - 1].end(), " ".join(w.group().lower() for w in words[k:k + n]))
                   for n in (1, 3) for k in range(len(words) - n + 1)]
    assert sorted(got) == sorted(wanted)
    assert not list(T._candidates([], [1, 3], everything))


def test_terms_with_a_dotted_i(spark):
    df = spark.createDataFrame([(1, "in \u0130zmir, \u0130ZM\u0130R"), (2, "i\u0307zmir")], "id int, text string")
    table = spark.createDataFrame([("\u0130zmir", "A"), ("\u0130ZM\u0130R", "B")], "term string, label string")
    done = {r.id: r.redacted for r in redact_terms(df, table, RegexStage(patterns=())).collect()}
    assert done == {1: "in [A], [B]", 2: "i\u0307zmir"}
