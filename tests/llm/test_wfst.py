import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from reportloom.llm import wfst

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return wfst.transducer(PATH)


@given(st.text(st.sampled_from("ab  \n\t▁éßtheingrsoxyz0日本😀́\x00"), max_size=40))
@settings(max_examples=500, deadline=None)
def test_equals_the_library(text):
    own = wfst.transducer(PATH)
    ids = own.encode(text)
    assert ids.tolist() == MODEL.encode(text)
    assert own.decode(ids) == text.replace("▁", " ")


def test_whole_texts(spark, own):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert [own.encode(t).tolist() for t in texts] == MODEL.encode(texts)


def test_every_piece_of_the_model(own):
    words = [p for p in own.pieces if p.strip(" ")][:6000]
    assert [own.encode(w).tolist() for w in words] == MODEL.encode(words)


@given(st.lists(st.integers(3, 31999), max_size=30))
@settings(max_examples=200, deadline=None)
def test_decoding_any_ids(ids):
    got = wfst.transducer(PATH).decode(np.array(ids, "<u4"))
    want = MODEL.decode(ids)
    assert got.replace("�", "") == want.replace("�", "")


def test_least_path_of_a_unigram_model(own):
    """The general search against all segmentations, with made-up scores."""
    small = object.__new__(wfst.Transducer)
    small.kind, small.size, small.bytes, small.unknown = wfst.UNIGRAM, 9, {}, 0
    small.pieces = {"a": 1, "b": 2, "ab": 3, "aba": 4, "ba": 5, "bab": 6}
    small.scores = {1: -2.0, 2: -2.5, 3: -3.0, 4: -5.5, 5: -3.2, 6: -4.0}
    small.longest, small.trie = 3, None
    small.trie = small._compiled()

    def segmentations(text):
        if not text:
            yield []
        for piece, i in small.pieces.items():
            if text.startswith(piece):
                for rest in segmentations(text[len(piece):]):
                    yield [i, *rest]

    for number in range(2, 128):
        text = bin(number)[3:].replace("0", "a").replace("1", "b")
        best = max(segmentations(text), key=lambda ids: sum(small.scores[i] for i in ids))
        assert sum(small.scores[i] for i in small.path(text)) == pytest.approx(sum(small.scores[i] for i in best))


def test_documents(odd_docs, no_docs):
    got = wfst.encoded(odd_docs, PATH)
    old = sorted((str(r.doc_id), MODEL.encode(r.text or "")) for r in odd_docs.collect())
    rows = got.collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == old
    assert all(r.n_tokens == len(r.ids) and r.round_trip is not False for r in rows)
    texts = sorted(str(r.text) for r in odd_docs.collect() if r.text is not None)
    back = wfst.decoded(got.where("round_trip IS NOT NULL"), PATH).collect()
    assert sorted(r.text for r in back) == texts
    assert wfst.encoded(no_docs, PATH).collect() == []
