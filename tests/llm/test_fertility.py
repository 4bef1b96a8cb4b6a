import math
import random
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from reportloom.llm import fertility
from reportloom.llm.queries import QUERIES
from reportloom.llm.words import WordCache

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = SentencePieceProcessor(model_file=PATH)


def words_of(text):
    out = [""]
    for c in text or "":
        if c in " \t\n\v\f\r":
            out += [""]
        else:
            out[-1] += c
    return [w for w in out if w]


def base(text):
    words, seen, lines = words_of(text), set(), 0
    for line in (text or "").split("\n"):
        lines += bool(words_of(line)) and line in seen
        seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(map((text or "").count, "#*$%&|<>")), lines, len(covered)


@given(st.text(st.sampled_from("ab \n\t#<é\x1f "), max_size=120))
@settings(max_examples=300, deadline=None)
def test_base(text):
    assert fertility.measure(text.encode(), PATH)[:5] == base(text)


def test_measures():
    text = "the quick brown fox 日本 \x07 the the"
    ids = [i for w in words_of(text) for i in MODEL.encode(w)]
    got = dict(zip(fertility.FIELDS + fertility.MEASURES, fertility.measure(text.encode(), PATH), strict=False))
    shares = [n / len(ids) for n in Counter(ids).values()]
    assert got["n_tokens"] == len(ids)
    assert got["chars_per_token"] == pytest.approx(sum(map(len, words_of(text))) / len(ids))
    assert got["byte_share"] == pytest.approx(sum(map(MODEL.is_byte, ids)) / len(ids))
    assert got["evenness"] == pytest.approx(-sum(s * math.log2(s) for s in shares) / math.log2(len(ids)))


@pytest.mark.parametrize(("text", "want"), [("abc", "latin"), ("...", "other"), ("привет abc", "cyrillic"), ("日本語 x", "han"), ("ひらがな", "kana"), ("123 é", "latin"), ("", "other")])
def test_script(text, want):
    assert fertility.script(text) == want


def test_noise_goes_and_prose_stays(spark, prose):
    rows = [(i, prose(i, 120), "en") for i in range(200)] + [(1000 + i, "".join(chr(0x2500 + (i * 7 + j * 13) % 100) + (" " if j % 6 == 5 else "") for j in range(300)), "en") for i in range(4)]
    rows += [(2000, "spam ham " * 200, "en"), (2001, "too short", "en")]
    got = {r.doc_id: r for r in fertility.rated(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PATH).collect()}
    assert sum(got[i].kept for i in range(200)) == 200
    assert not any(got[1000 + i].kept or got[1000 + i].base_failed for i in range(4))
    assert got[2000].base_failed and got[2001].base_failed and not got[2000].kept


@pytest.fixture(scope="module")
def salads(spark):
    """Given English documents, the clean ones at every length, and salads of few distinct words of a clean one."""
    rows = [(r.doc_id, r.text, "en") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").collect()]
    draw = random.Random(7)
    long = [t for _, t, _ in rows if t and 300 < len(t.split()) < 2000 and not any(c in t for c in "|$%&*#") and len(set(t.split())) > 150]
    clean = [" ".join(w for t in draw.sample(long, 8) for w in t.split()[:300])]
    clean += [" ".join(t.split()[:n]) for n in (15, 30, 60, 250) for t in long[:5]]
    clean += [" ".join(w for t in long[:60] for w in t.split())]
    salads = [" ".join(draw.choice(own) for _ in range(n)) for n in (150, 300, 6000, 60_000) for k in (6, 8) for t in long[:4]
              for own in [draw.sample(sorted(set(t.split())), k)]]
    rows += [(10**6 + i, t, "en") for i, t in enumerate(clean)] + [(2 * 10**6 + i, t, "en") for i, t in enumerate(salads)]
    return {r.doc_id: r for r in fertility.rated(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PATH).collect()}


def test_salads_of_few_words_go(salads):
    found = [r for k, r in salads.items() if k >= 2 * 10**6]
    assert len(found) == 32 and any(not r.base_failed for r in found)
    assert not any(r.kept for r in found)


def test_clean_texts_of_all_lengths_stay(salads):
    found = [r for k, r in salads.items() if 10**6 <= k < 2 * 10**6]
    assert max(r.n_tokens for r in found) > 30_000 and min(r.n_tokens for r in found) < 60
    assert [(r.doc_id, r.n_tokens, r.evenness) for r in found if not r.kept and not r.base_failed] == []


def test_band_of_one_length_is_level(spark, prose):
    rows = [(i, prose(i, 100), "xx") for i in range(3)] + [(9, prose(9, 100), "yy")]
    found = fertility.rated(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PATH).collect()
    assert [r.kept for r in found] == [True] * 4


def test_odd_documents(spark, odd_docs, no_docs):
    rows = fertility.rated(odd_docs, PATH).collect()
    want = Counter((str(r.doc_id), *base(r.text)) for r in odd_docs.collect())
    assert Counter((str(r.doc_id), *[r[n] for n in fertility.FIELDS[:5]]) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert fertility.rated(no_docs, PATH).collect() == []
    assert fertility.rated(odd_docs.drop("lang"), PATH).count() == odd_docs.count()


def test_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in QUERIES["op7_tokeniser_fertility"](spark, "/root/testdata/sf0.001").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(docs[r.doc_id])


def test_word_cache():
    calls = []

    def encode(words):
        calls.append(list(words))
        return [w.upper() for w in words]
    cache = WordCache(encode, remembered=3)
    for words in ([b"a", b"b", b"a"], [b"c", b"d"], [b"a", b"e", b"f", b"g", b"h"], [], [b"x" * 99], [b"x" * 99, b"a"]):
        assert cache.joined(words) == b"".join(words).upper()
        assert len(cache.young) <= 3 and len(cache.old) <= 3
    assert calls[0] == [b"a", b"b"]
