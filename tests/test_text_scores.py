"""Scores against hand-computed values and direct definitions."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reportloom.fixed_values import SCORE_LITERALS, SCORE_RULES
from reportloom.functions.similarity import edit_distance, edit_similarity
from reportloom.functions.text_scores import lcs_f_score, meteor, stem
from reportloom.operators.evaluation import corpus_bleu, formatted, mean_metrics, sentence_bleu, text_metrics
from reportloom.operators.overlap import SET_APART, counts_of, equal_word_scores, score_tokens

# Pairs given in the 1980 paper.
STEMS = {
    "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formalize": "formal", "electrical": "electr", "goodness": "good", "revival": "reviv", "adjustable": "adjust",
    "replacement": "replac", "adoption": "adopt", "effective": "effect", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll",
}


@pytest.mark.parametrize("word,root", STEMS.items())
def test_stems(word, root):
    assert stem(word) == root


def test_stem_leaves_other_scripts():
    assert stem("находками") == "находками"


def lcs_positions(ref, cand):
    table = [[0] * (len(cand) + 1) for _ in range(len(ref) + 1)]
    for i, a in enumerate(ref, 1):
        for j, b in enumerate(cand, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if a == b else max(table[i - 1][j], table[i][j - 1])
    i, j, found = len(ref), len(cand), set()
    while i and j:
        if ref[i - 1] == cand[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
        elif table[i][j - 1] > table[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return found


def union_lcs_score(refs, cands):
    left_r, left_c = Counter(w for s in refs for w in s), Counter(w for s in cands for w in s)
    n, m, hits = left_r.total(), left_c.total(), 0
    for ref in refs:
        for i in sorted(set().union(*[lcs_positions(ref, cand) for cand in cands])):
            if left_r[ref[i]] > 0 and left_c[ref[i]] > 0:
                left_r[ref[i]] -= 1
                left_c[ref[i]] -= 1
                hits += 1
    return 2 * hits / (n + m)


def test_lcs_score_against_full_tables():
    rng = random.Random(2)
    for _ in range(1500):
        letters = rng.choice(["abc", "abcdefghij"])
        text = lambda: [[rng.choice(letters) for _ in range(rng.randint(1, 11))] for _ in range(rng.randint(1, 5))]
        refs, cands = text(), text()
        join = lambda s: "\n".join(" ".join(line) for line in s)
        assert lcs_f_score(join(refs), join(cands)) == pytest.approx(union_lcs_score(refs, cands))


def test_lcs_score_cases():
    assert lcs_f_score("", "x") == 0.0 == lcs_f_score("x", "")
    assert lcs_f_score("police killed the gunman", "police kill the gunman") == 1.0  # equal stems
    assert lcs_f_score("police killed the gunman", "police kill the gunman", stemmed=False) == 0.75
    assert lcs_f_score("киста почки", "киста почки") == 1.0
    assert lcs_f_score("киста почки", "киста почки", ascii_only=True) == 0.0
    # the union of both sentences' matches covers four of five words (Lin 2004)
    assert lcs_f_score("w1 w2 w3 w4 w5", "w1 w2 w6 w7 w8\nw1 w3 w8 w9 w5") == pytest.approx(2 * 4 / (5 + 10))


def test_meteor_cases():
    assert meteor("the cat sat on the mat", "the cat sat on the mat") == pytest.approx(1 - 0.5 * (1 / 6) ** 3)
    # published worked examples
    assert meteor("the cat sat on the mat", "on the mat sat the cat") == pytest.approx(0.5)
    assert meteor("the cat sat on the mat", "the cat was sat on the mat") == pytest.approx(0.9654, abs=5e-5)
    assert meteor("a", "b") == 0.0 == meteor("", "")
    assert meteor("cats", "cat") == 0.5 and meteor("cats", "cat", stemmed=False) == 0.0
    assert meteor("big", "large") == 0.0 and meteor("big", "large", synonyms={"large": ["big"]}) == 0.5


def test_score_tokens(spark):
    texts = ["Hello, world! 3.5-4 a-b &quot;x&quot; it's 1,000.", "hyphen-\nated  text\n", None, " "]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(score_tokens(F.col("t"))).collect()
    assert [r[0] for r in got] == [
        ["Hello", ",", "world", "!", "3.5", "-", "4", "a-b", '"', "x", '"', "it's", "1,000", "."], ["hyphenated", "text"], [], []]


def test_score_tokens_come_from_one_pass_where_no_marks_touch(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice("ab 15.,-/!{~'\"`[]\\^_|é \t\n") for _ in range(draw.randint(0, 30))) for _ in range(3000)]

    def plain(text):
        text = text.rstrip()
        for old, new in SCORE_LITERALS:
            text = text.replace(old, new)
        text = f" {text} "
        for pattern, new in SCORE_RULES:
            text = re.sub(pattern, new, text)
        return text.split()

    asked = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", score_tokens(F.col("t")).alias("w"))
    assert {r.i: r.w for r in asked.collect()} == {i: plain(t) for i, t in enumerate(texts)}
    assert SET_APART in asked._jdf.queryExecution().optimizedPlan().toString()


def test_overlap_counts(spark):
    rows = [(1, "the cat is on the mat", "the the the the the the the"), (2, "", ""), (3, "a", "a"), (4, None, None), (5, "x", "")]
    df = spark.createDataFrame(rows, "id int, reference string, predicted string")
    got = {r.id: list(r.n) for r in df.select("id", counts_of(F.col("reference"), F.col("predicted")).alias("n")).collect()}
    assert got[1] == [6, 7, 2, 0, 0, 0, 7, 6, 5, 4]
    assert got[2] == [0] * 10 == got[4]
    assert got[3] == [1, 1, 1, 0, 0, 0, 1, 0, 0, 0] and got[5] == [1] + [0] * 9


def test_overlap_counts_equal_clipped_counts(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 40))), " ".join(draw.choice("abcd") for _ in range(draw.randint(0, 40)))) for i in range(60)]
    rows.append((60, "a " * 30_000, "a b " * 20_000))
    df = spark.createDataFrame(rows, "id int, reference string, predicted string")
    got = {r.id: list(r.n)[2:6] for r in df.select("id", counts_of(F.col("reference"), F.col("predicted")).alias("n")).collect()}

    def grams(text, n):
        words = text.split()
        return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))

    assert got == {i: [(grams(r, n) & grams(c, n)).total() for n in (1, 2, 3, 4)] for i, r, c in rows}


def test_bleu_needs_no_shuffle(spark):
    df = spark.range(9).selectExpr("id", "'a b' AS reference", "concat('a ', id) AS predicted")
    plan = sentence_bleu(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Generate" not in plan


def test_runs_of_words_are_counted_in_one_call_a_row(spark):
    """Not element by element; also in a session of its own, with words that are alike and texts shorter than a run."""
    rows = [(0, "x", "x y"), (1, "a b a b a", "a b b a b"), (2, "aa a", "a aa"), (3, "\u0434\u0430 \U0001f600 \u0434\u0430 ! ?", "\U0001f600 \u0434\u0430 ! ? \u0434\u0430")]
    df = spark.newSession().createDataFrame(rows, "id int, reference string, predicted string")
    counted = df.select("id", counts_of(F.col("reference"), F.col("predicted")).alias("n"))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "reportloom_shared_runs" in plan and "aggregate(" not in plan and "array_sort" not in plan
    assert {r.id: list(r.n)[2:6] for r in counted.collect()} == {0: [1, 0, 0, 0], 1: [4, 3, 1, 0], 2: [2, 0, 0, 0], 3: [5, 3, 2, 1]}


def test_equal_words(spark):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice("abcd.") for _ in range(draw.randint(0, 9))), " ".join(draw.choice("abcd.") for _ in range(draw.randint(0, 9)))) for i in range(80)]
    df = spark.createDataFrame([*rows, (100, None, None)], "id int, reference string, predicted string")
    got = {r.id: r.meteor for r in equal_word_scores(df, key="id").collect()}
    assert got.pop(100) == 0.0
    assert got == {i: pytest.approx(meteor(r, p, stemmed=False)) for i, r, p in rows}


def test_equal_words_are_aligned_without_a_row_per_word(spark):
    df = spark.createDataFrame([(1, "a b a", "a a c"), (2, "x", "x")], "id int, reference string, predicted string")
    plan = equal_word_scores(df, key="id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan


def test_equal_words_of_a_key_that_comes_twice(spark):
    rows = [(1, "a b", "a b"), (1, "a b c", "c a b"), (None, "a", "a")]
    df = spark.createDataFrame(rows, "id int, reference string, predicted string")
    got = [(r.id, round(r.meteor, 6)) for r in equal_word_scores(df, key="id").collect()]
    assert len(got) == 3 and {k for k, _ in got} == {1, None}


def test_synonyms_are_a_table(spark):
    df = spark.createDataFrame([(1, "big", "large"), (2, "big", "tiny"), (3, "big", None)], "id int, reference string, predicted string")
    table = spark.createDataFrame([("Large", "big"), ("large", "big"), ("huge", "big"), (None, "x")], "word string, synonym string")
    assert {r.id: r.meteor for r in text_metrics(df, synonyms=table).collect()} == {1: 0.5, 2: 0.0, 3: 0.0}


def test_metrics_table(spark):
    rows = [(1, "the cat is on the mat", "the the the the the the the"), (2, "same text here now", "same text here now"),
            (3, "", "x"), (4, "x y", ""), (5, "a b", "c d"), (6, None, None), (7, "a b", "a b")]
    df = spark.createDataFrame(rows, "id int, reference string, predicted string")
    got = {r.id: r for r in text_metrics(df).collect()}
    smoothed = [100 * 2 / 7, 100 / (2 * 6), 100 / (4 * 5), 100 / (8 * 4)]
    assert got[1].bleu == pytest.approx(math.exp(sum(map(math.log, smoothed)) / 4))
    assert got[2].bleu == pytest.approx(100) and got[2].exact_match == 1.0 == got[2].levenshtein == got[2].rouge
    assert got[7].bleu == pytest.approx(100)  # only two orders exist
    assert [got[i].bleu for i in (3, 4, 5, 6)] == [0.0] * 4
    assert (got[6].exact_match, got[6].levenshtein, got[4].levenshtein) == (1.0, 1.0, 0.0)
    zeroed = {r.id: r for r in text_metrics(df, zero_without_reference=True).collect()}
    assert zeroed[6].exact_match == 0.0 and zeroed[2].exact_match == 1.0
    both = corpus_bleu(df.filter("id in (1, 2)")).first().bleu
    p = [100 * (2 + 4) / 11, 100 * 3 / 9, 100 * 2 / 7, 100 * 1 / 5]
    assert both == pytest.approx(math.exp(sum(map(math.log, p)) / 4))
    assert corpus_bleu(df.limit(0)).first().bleu == 0.0


def test_edit_similarity_counts_characters(spark):
    df = spark.createDataFrame([("яя", "аа"), ("kitten", "sitting"), ("", ""), ("😀a", "😀b")], "a string, b string")
    got = [r[0] for r in df.select(edit_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([0.0, 1 - 3 / 7, 1.0, 0.5])


def test_means_of_nothing_are_zero(spark):
    df = spark.createDataFrame([], "x double")
    assert mean_metrics(df, {"m": "x"}).first().m == 0.0
    assert formatted(spark.createDataFrame([(0.12345,)], "bleu double"), ["bleu"]).first().bleu == "0.1235"


def test_edit_distance_in_bands(spark):
    """Equal to the full distance within, at and beyond the bands; NULL stays NULL."""
    rng = random.Random(3)
    words = ["", "a", "é", "яя", "kitten", "sitting", "😀x"] + ["".join(rng.choice("ab") for _ in range(rng.randrange(90))) for _ in range(25)]
    long_text = "".join(rng.choice("abcd ") for _ in range(2000))
    pairs = [(x, y) for x in words for y in words] + [(long_text, long_text[:k] + "Z" + long_text[k + 1:]) for k in (0, 999, 1999)]
    pairs += [(long_text, long_text[70:]), (long_text, long_text[64:]), (long_text, long_text[::-1])]
    df = spark.createDataFrame(pairs, "a string, b string")
    for bands in [(2, 8), (64, 1024)]:
        assert df.filter(edit_distance(F.col("a"), F.col("b"), bands) != F.levenshtein("a", "b")).count() == 0
    none = spark.createDataFrame([(None, "a"), (None, None)], "a string, b string")
    assert [r[0] for r in none.select(edit_distance(F.col("a"), F.col("b"))).collect()] == [None, None]


def test_lines_the_prediction_has_need_no_table(monkeypatch):
    """A line that is in the prediction as it stands, and one without a common word, are settled without the LCS tables."""
    from reportloom.functions import text_scores

    calls = []
    monkeypatch.setattr(text_scores, "_table_rows", lambda *given, full=text_scores._table_rows: calls.append(given[0]) or full(*given))
    assert lcs_f_score("alpha beta gamma\nomega", "beta\nalpha beta gamma\nother words") == pytest.approx(2 * 3 / (4 + 6))
    assert calls == []
    assert lcs_f_score("alpha beta delta", "alpha beta gamma") == pytest.approx(2 / 3) and len(calls) == 1
