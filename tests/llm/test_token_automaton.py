import random

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reportloom.llm import token_automaton as ta
from reportloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["a", "s", "t", "'", "'s", " ", "  ", "\n", "\t", "r", "e", "'re", "'ll", "'l", "1", "23", "!", "?", "é", "日", "😀", " ", " ",
         "<|endoftext|>", "<|", "the", "ing", "tion", "ABC", "xxxxx", "́", "՘", "࢏", "=", "http", "\0"]


@pytest.fixture(scope="module")
def counter():
    return ta.TokenCounter(PATH, ta.class_runs(PATH))


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def own(counter, texts):
    return counter.counts([t.encode() for t in texts]).tolist()


def drawn(seed, count, longest):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, longest))) for _ in range(count)]


def test_classes_cut_like_the_pattern(counter):
    """The first transducer against a regular expression of its own, over characters all Unicode versions agree on."""
    word = regex.compile(ta.PATTERN)
    for text in drawn(3, 3000, 20):
        text = text.replace("՘", "").replace("࢏", "")
        assert ta.word_starts(counter._kinds(text)).tolist() == [m.start() for m in word.finditer(text)]


def test_scan_equals_one_reading_after_the_other(counter):
    kinds = counter._kinds("".join(drawn(4, 400, 30)))[:ta.CHUNK * 70]
    columns = np.ascontiguousarray(kinds.reshape(-1, ta.CHUNK).T)
    state, entered = ta.START, []
    for place, kind in enumerate(kinds.tolist()):
        if place % ta.CHUNK == 0:
            entered.append(state)
        state = ta._step(state, kind)[0]
    assert ta.entry_states(columns).tolist() == entered


@pytest.mark.parametrize("longest", [3, 25, 200])
def test_drawn_texts(counter, longest):
    texts = drawn(longest, 3000, longest)
    assert own(counter, texts) == library(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(counter, text):
    assert own(counter, [text]) == library([text])


def test_equal_letters_and_all_tokens(counter):
    texts = [c * n for c in "la =\n0" for n in range(130)] + [t for t in LIBRARY.get_vocab()]
    assert own(counter, texts) == library(texts)


def test_blocks_of_long_texts(counter, monkeypatch):
    texts = drawn(9, 300, 120) + ["y" * 900, "'l" * 300, " \n" * 300]
    want = library(texts)
    for size in (7, 40, 1000):
        monkeypatch.setattr(ta, "BLOCK_BYTES", size)
        assert own(counter, texts) == want


def test_forgetting_states(counter, monkeypatch):
    texts = drawn(10, 1500, 60)
    want = library(texts)
    monkeypatch.setattr(counter.words, "most", 300)
    monkeypatch.setattr(ta, "FEW", 1500)
    assert own(counter, texts) == want
    monkeypatch.setattr(ta, "FEW", 5)
    assert own(counter, texts) == want


def test_odd_documents(odd_docs, no_docs, spark):
    rows = ta.token_counts(odd_docs, PATH, limit=40).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").collect()]
    want = [(k, len(t.encode()), n, n > 40) for (k, t), n in zip(texts, library([t for _, t in texts]))]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert ta.token_counts(no_docs, PATH).count() == 0
    named = spark.createDataFrame([("k", "a b", 1, 2)], "`the key` string, body string, key int, n_bytes int")
    assert [tuple(r) for r in ta.token_counts(named, PATH, key="the key", text="body").collect()] == [("k", 3, 2, False)]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        ta.TokenCounter(public_tokenizers.path("word_bpe_49k.json"), [])


def test_query_against_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    want = {(k, len(t.encode()), n, n > 512) for (k, t), n in zip(texts.items(), library(list(texts.values())))}
    rows = list(map(tuple, QUERIES["op11_token_automaton_counts"](spark, sf).collect()))
    assert len(rows) == len(want) and set(rows) == want
