import io
import string
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reportloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.integers(1, 32), st.integers(0, 200), st.integers(0, 2**32 - 1))
@settings(max_examples=80, deadline=None)
def test_pack_round_trip(bits, count, seed):
    ids = np.random.default_rng(seed).integers(0, 2**bits, count, dtype=np.uint64).astype("<u4")
    data = packing.pack(ids, bits)
    assert len(data) == -(-count * bits // 8)
    whole = int.from_bytes(data, "little")
    assert [whole >> i * bits & (2**bits - 1) for i in range(count)] == ids.tolist()
    assert packing.unpack(data, bits, count).tolist() == ids.tolist()


def test_bits_for():
    assert [packing.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize("bits", [5, 16, 17])
def test_file_random_access(bits):
    draw, out = np.random.default_rng(1), io.BytesIO()
    docs = [draw.integers(0, 2**bits, n).astype("<u4") for n in (0, 1, 7, 64, 200, 0, 33)]
    writer = packing.TokenWriter(out, bits, 64)
    for key, ids in zip([None, 4, 5, 6, 7, 8, -9], docs, strict=True):
        writer.add(key, ids)
    writer.close()
    tokens = packing.TokenFile(io.BytesIO(out.getvalue()))
    assert tokens.keys == [None, 4, 5, 6, 7, 8, -9]
    for place in (6, 4, 0, 3, 5, 2, 1):
        assert tokens.document(place).tolist() == docs[place].tolist()


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        packing.TokenFile(io.BytesIO(b"x" * 100))


def test_block_must_be_whole_bytes():
    with pytest.raises(ValueError):
        packing.TokenWriter(io.BytesIO(), 5, 12)


@pytest.mark.parametrize("text", ["a<|endoftext|>b <|startoftext|>", "don't  STOP\n\n", " ́x é é ﬁ", "日本 😀 x y", "x" * 500, "<|ENDOFTEXT|> The <|EndOfText|>", "İ Á THE K"])
def test_words_equal_whole_text(text):
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert packing.word_ids(text.encode(), PATH).tolist() == whole


@pytest.mark.parametrize("text", ["H\u0331", "J\u030c x", "T\u0308", "THE W\u030aA", "Y\u030a", "H\u0323\u0331 FÜR É E\u0301 <|x", "K\u0334\u0331 STOP"])
def test_capitals_composed_in_lower_case_only(text):
    assert packing.word_ids(text.encode(), PATH).tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_capitals_before_every_mark():
    model = Tokenizer.from_file(PATH)
    marks = [chr(c) for c in range(0x80, 0x110000) if unicodedata.combining(chr(c))] + ["é", "ü", "ß", "日"]
    for letter in string.ascii_uppercase:
        for at in range(0, len(marks), 64):
            text = " ".join(f"a{letter}{mark}B" for mark in marks[at:at + 64])
            assert packing.word_ids(text.encode(), PATH).tolist() == model.encode(text, add_special_tokens=False).ids, (letter, at)


def want(rows):
    model, start, out = Tokenizer.from_file(PATH), 0, []
    for key, text in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents(spark, odd_docs):
    docs = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = packing.round_trip(docs, PATH, 1).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want(rows)


def test_null_and_repeated_keys_fill_the_stream(odd_docs):
    got = sorted((r.start, r.n_tokens) for r in packing.round_trip(odd_docs, PATH, 1).collect())
    assert len(got) == odd_docs.count()
    assert all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:], strict=False))


def test_small_files_and_blocks(spark, prose):
    from reportloom.session import fresh_folder

    docs = spark.createDataFrame([(i, prose(i, 5 + i)) for i in range(60)], "doc_id long, text string")
    folder = fresh_folder(spark, "tokens")
    manifest = packing.write_tokens(docs, folder, PATH, 1, block_ids=64, file_ids=150)
    assert manifest.count() > 8
    got = packing.read_tokens(manifest, folder).orderBy("key").collect()
    assert [tuple(r) for r in got] == want((r.doc_id, r.text) for r in docs.orderBy("doc_id").collect())


def test_no_rows(no_docs):
    assert packing.round_trip(no_docs, PATH, 1).collect() == []
