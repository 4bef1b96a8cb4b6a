from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from reportloom.llm import rank_order
from reportloom.llm.queries import QUERIES


def plain_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    while "  " in letters:
        letters = letters.replace("  ", " ")
    found = Counter()
    for n in (1, 2, 3):
        for i in range(len(letters) - n + 1):
            gram = letters[i:i + n]
            if gram.strip() and " " not in gram[1:-1]:
                found[gram] += 1
    return found


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | (1 if c == " " else ord(c))
    return value


@given(st.text(st.sampled_from("abÉß 1.\n日😀İ"), max_size=50))
@settings(max_examples=300, deadline=None)
def test_grams(text):
    found, counts = rank_order.grams(text)
    assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == {code(g): n for g, n in plain_grams(text).items()}


def ranked(counts, most=300):
    return [g for g, _ in sorted(((code(g), n) for g, n in counts.items()), key=lambda x: (-x[1], x[0]))[:most]]


def plain_identify(text, profiles):
    mine = ranked(plain_grams(text or ""))
    if not mine or not profiles:
        return "und", 0.0
    sums = {}
    for name, profile in profiles.items():
        place = {g: i for i, g in enumerate(profile)}
        sums[name] = sum(abs(place[g] - i) if g in place else 300 for i, g in enumerate(mine))
    best = min(sorted(sums), key=sums.get)
    return best, 1 - sums[best] / (300 * len(mine))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    counts = {}
    for r in rows:
        if r.lang and r.text:
            counts.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    profiles = {name: ranked(c) for name, c in counts.items()}
    got = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in rank_order.predict(docs, rank_order.learn(docs)).collect()}
    want = {r.doc_id: plain_identify(r.text, profiles) for r in rows}
    assert got == {k: (name, round(s, 9)) for k, (name, s) in want.items()}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in QUERIES["op9_rank_order_language"](spark, folder).collect() if r.held_out]
    assert len(held) > 250 and all(0 <= r.score <= 1 for r in held)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.98


def test_odd_documents(spark, odd_docs, no_docs):
    profiles = rank_order.learn(odd_docs)
    assert profiles.languages == ["de", "en"]
    got = rank_order.predict(odd_docs, profiles).collect()
    assert Counter(str(r.doc_id) for r in got) == Counter(str(r.doc_id) for r in odd_docs.collect())
    for r in got:
        if r.doc_id in (0, 1, 2):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    kept = rank_order.accepted(odd_docs, profiles, 0.0)
    assert kept.schema == odd_docs.schema
    assert Counter(r.text for r in kept.collect()) == Counter(r.text for r in odd_docs.collect() if r.text and any(map(str.isalpha, r.text)))
    none = rank_order.learn(no_docs)
    assert none.languages == [] and rank_order.identify("hello", none) == ("und", 0.0)
    assert rank_order.predict(no_docs, none).collect() == [] and rank_order.accepted(no_docs, none, 0.1).collect() == []


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(rank_order, "PIECE", 1 << 10)
    text = "palabra " * 1000
    found, counts = rank_order.grams(text)
    assert counts[found == ord("p")] == 1000
