from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reportloom.llm import mixing


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.floats(1e-3, 1e3), min_size=1, max_size=20))
@settings(max_examples=60, deadline=None)
def test_less_than_one_block_off(weights):
    period, slots = mixing.plan(weights, 256)
    assert sorted(s for own in slots.values() for s in own) == list(range(period))
    for source, own in slots.items():
        share, served, at = len(own) / period, 0, set(own)
        assert len(own) >= 1
        for slot in range(period):
            served += slot in at
            assert abs(served - share * (slot + 1)) < 1
        for k, slot in enumerate(own):
            assert int(k / share + 1e-9) <= slot < -(-(k + 1) * period // len(own))


def test_weights_are_rounded_by_less_than_a_slot():
    period, blocks = mixing.quotas({"a": 5.0, "b": 3.0, "c": 2.0 / 3}, 4096)
    total = 5 + 3 + 2 / 3
    assert all(abs(blocks[s] - w / total * period) < 1 for s, w in {"a": 5.0, "b": 3.0, "c": 2 / 3}.items())


def test_many_sources_widen_the_period():
    period, blocks = mixing.quotas({f"s{i}": 1.0 + (i == 0) * 1e6 for i in range(1000)})
    assert period >= 16_000 and sum(blocks.values()) == period and min(blocks.values()) == 1


def test_bad_weights():
    with pytest.raises(ValueError):
        mixing.quotas({"a": 0.0})


def brute(rows, weights, block_chars):
    """Slots one after the other until every source has placed all of its blocks."""
    period, plan = mixing.plan({"" if s is None else f"={s}": w for s, w in weights.items()})
    owner = {slot: s for s, own in plan.items() for slot in own}
    blocks = defaultdict(lambda: defaultdict(list))
    sizes = Counter()
    for source, _, offset, block, chars in rows:
        name = "" if source is None else f"={source}"
        blocks[name][block].append(offset)
        sizes[name] += chars
    counts = {s: max(1, -(-n // block_chars)) for s, n in sizes.items()}
    served, slot, out = Counter(), 0, []
    while any(served[s] < counts[s] for s in counts):
        s = owner[slot % period]
        epoch, block = divmod(served[s], counts[s])
        out += [(s, slot, epoch, block, o) for o in blocks[s][block]]
        served[s] += 1
        slot += 1
    return Counter(out)


def test_schedule(spark, odd_docs):
    weights = {None: 1.0, "a": 2.0, "b": 0.5}
    got = [tuple(r) for r in mixing.schedule(odd_docs, weights, block_chars=500).select("source", "slot", "epoch", "block", "offset", "doc_id").collect()]
    first = [r for r in got if r[2] == 0]
    assert sorted(map(str, (r[5] for r in first))) == sorted(str(r.doc_id) for r in odd_docs.collect())
    texts = {r.doc_id: r.text for r in odd_docs.where("doc_id IS NOT NULL").collect()}
    by_source = defaultdict(list)
    for r in first:
        by_source[r[0]].append(r)
    chars = {}
    for source, own in by_source.items():
        real = sum(len(r.text or "") for r in odd_docs.where("source IS NULL" if source is None else f"source = '{source}'").collect())
        chars[source] = real
        order = sorted(own, key=lambda r: r[4])
        for a, b in zip(order, order[1:], strict=False):  # offsets follow each other without gaps
            if a[5] is not None and a[4] != b[4]:
                assert b[4] - a[4] == len(texts[a[5]] or "") or any(x[4] == a[4] and x[5] != a[5] for x in order)
        blocks = max(1, -(-real // 500))
        assert all(r[3] == min(r[4] // 500, blocks - 1) for r in own)
    rows = [(r[0], r[5], r[4], r[3], 0) for r in first]
    rows += [(s, None, -1, -1, n) for s, n in chars.items()]
    assert Counter(("" if r[0] is None else f"={r[0]}", *r[1:5]) for r in got) == brute(rows, weights, 500)


def test_mixed_keeps_columns_and_order(spark, prose):
    docs = spark.createDataFrame([(i, prose(i, 30), "en", "a" if i % 3 else "b", 1) for i in range(120)],
                                 "doc_id long, text string, lang string, source string, slot long")
    weights = {"a": 1.0, "b": 1.0}
    mixed = mixing.mixed(docs, weights, block_chars=1000)
    assert mixed.columns == docs.columns
    want = mixing.schedule(docs, weights, block_chars=1000).orderBy("slot", "offset", "doc_id")
    assert [r.doc_id for r in mixed.collect()] == [r.doc_id for r in want.collect()]
    assert {r.doc_id for r in mixed.collect()} == set(range(120))


def test_unknown_source(odd_docs):
    with pytest.raises(ValueError):
        mixing.schedule(odd_docs, {"a": 1.0})


def test_no_rows(no_docs):
    assert mixing.schedule(no_docs, {}).collect() == []
    assert mixing.mixed(no_docs, mixing.tempered(mixing.source_sizes(no_docs), 0.5)).collect() == []
