import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from reportloom.llm import simhash
from reportloom.llm.components import components


def plain(text, size=4):
    """Bit by bit from the definition."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] * bool(words)
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(st.sampled_from("aB cÉ\t\n\x1f ß😀"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode(), 4) == plain(text)


def groups(prints, bits):
    """Smallest member of each component by comparing all pairs."""
    up = {k: k for k in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: root(k) for k in keys}


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 7])
def test_links_of_random_fingerprints(spark, bits):
    draw = random.Random(bits)
    prints = {draw.getrandbits(64) for _ in range(30)}
    for start in list(prints)[:12]:
        for _ in range(6):
            start ^= sum(1 << b for b in draw.sample(range(64), draw.randint(0, bits + 1)))
            prints.add(start)
    prints |= {0, 2**64 - 1, 2**63, 1, 15}
    signed = lambda x: x - (x >> 63 << 64)
    got = simhash.linked_fingerprints(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), bits).collect()
    want = {frozenset((signed(a), signed(b))) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= bits}
    assert len(got) == len(want) and {frozenset((r.a, r.b)) for r in got} == want


def test_documents(spark, odd_docs):
    docs = odd_docs.where("doc_id IS NOT NULL")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    prints = {r.doc_id: plain(r.text) for r in docs.collect()}
    roots = groups(prints, 4)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(k, f"{p:016x}", roots[k]) for k, p in prints.items()}


def test_missing_keys(spark):
    docs = spark.createDataFrame([(None, "only one"), (None, "same words here now"), (7, "same words here now")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(None, None), (None, 7), (7, 7)}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    prints = {r.doc_id: plain(r.text) for r in docs.collect()}
    roots = groups(prints, 4)
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == roots


def test_one_of_each(spark, odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    docs = odd_docs.where("doc_id IS NOT NULL")
    roots = groups({r.doc_id: plain(r.text) for r in docs.collect()}, 4)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(roots.values()))
    # Without a key: the row with a NULL text is a copy of document 0, the other has no copy.
    assert [r.text for r in kept.collect() if r.doc_id is None] == [r.text for r in odd_docs.where("doc_id IS NULL AND text IS NOT NULL").collect()]
    assert set(kept.collect()) <= set(odd_docs.collect())
    assert simhash.one_of_each(no_docs).collect() == [] and simhash.near_duplicates(no_docs).collect() == []


def test_one_key_with_different_texts(spark, prose):
    a, b, c, d = (prose(i, 60) for i in range(4))
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (5, b, "x"), (6, b, "y"), (7, c, "x"), (7, d, "x"), (7, d, "w"), (8, d, "a"), (None, a, "n")]
    prints = {t: plain(t) for t in (a, b, c, d)}
    assert all((prints[x] ^ prints[y]).bit_count() > 4 for x, y in ((a, b), (a, c), (a, d), (b, c), (b, d), (c, d)))
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    # The copy without a key goes, as its text is kept with one.
    assert Counter(map(tuple, kept)) == Counter([(1, a, "x"), (5, b, "x"), (7, c, "x"), (7, d, "w")])


def test_every_component_keeps_one_row(spark, prose):
    draw = random.Random(3)
    texts = [prose(i // 2, 80) + " tail" * (i % 2) for i in range(24)]
    rows = [(draw.randrange(12), draw.choice(texts)) for _ in range(150)]
    prints = {i: plain(t) for i, (_, t) in enumerate(rows)}
    components_of = defaultdict(list)
    for place, root in groups(prints, 4).items():
        components_of[root].append(rows[place])
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(min(own) for own in components_of.values())


def test_components_of_random_graphs(spark):
    for seed in range(3):
        draw = random.Random(seed)
        edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
        up = {}
        for a, b in edges:
            up.setdefault(a, a), up.setdefault(b, b)

        def root(x, up=up):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in edges:
            x, y = sorted((root(a), root(b)))
            up[y] = x
        linked = defaultdict(set)
        for x in up:
            linked[root(x)].add(x)
        want = {(x, r) for r, own in linked.items() if len(own) > 1 for x in own}
        got = components(spark.createDataFrame(edges, "a long, b long"))
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))).collect() == []
