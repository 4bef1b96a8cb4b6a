import base64
import random
from collections import Counter

import public_tokenizers
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from reportloom.llm import mixing, secrets, simhash
from tests.llm.test_mixing import brute as brute_mix
from tests.llm.test_rank_order import plain_grams, plain_identify, ranked
from tests.llm.test_simhash import groups, plain

SF = "/root/testdata/sf0.001"


def test_stage_names():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["known_language", "near_duplicates", "secrets_masked", "sources_mixed", "token_ids"]


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    counts = {}
    for r in rows.values():
        counts.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    profiles = {name: ranked(c) for name, c in counts.items()}
    known = {k: r for k, r in rows.items() if plain_identify(r.text, profiles)[1] >= corpus_pipeline.LEAST_SCORE}
    roots = groups({k: plain(r.text) for k, r in known.items()}, 4)
    texts = {k: secrets.masked(known[k].text, secrets.secrets_of(known[k].text)) for k in set(roots.values())}
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sizes = Counter()
    for k, t in texts.items():
        sizes[rows[k].source] += len(t)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == {k: model.encode(t) for k, t in texts.items()}
    # how often each document comes: from the slots of a plain run of the schedule over the operator's block numbers
    frame = spark.createDataFrame([(k, t, rows[k].source) for k, t in texts.items()], "doc_id long, text string, source string")
    weights = mixing.tempered(dict(sizes), corpus_pipeline.MIX_EXPONENT)
    placed = mixing.schedule(frame, weights).collect()
    first = [(r.source, r.doc_id, r.offset, r.block, len(texts[r.doc_id])) for r in placed if r.epoch == 0]
    times = Counter((s, o) for s, _, _, _, o in brute_mix(first, weights, mixing.BLOCK_CHARS).elements())
    assert Counter(r.doc_id for r in got) == Counter({k: times[f"={s}", o] for s, k, o, _, _ in first})


def test_order_of_the_mix_is_kept(spark, tmp_path):
    """The rows read back from storage, by their places, against the schedule over what the mixing stage was given."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weights = mixing.tempered(mixing.source_sizes(docs), corpus_pipeline.MIX_EXPONENT)
    want = mixing.schedule(docs, weights).orderBy("slot", "offset", "doc_id")
    corpus_pipeline.sources_mixed(spark, docs, SF).repartition(13, "doc_id").count()  # nothing may depend on how it is read
    corpus_pipeline.sources_mixed(spark, docs, SF).write.parquet(f"{tmp_path}/mixed")
    back = spark.read.parquet(f"{tmp_path}/mixed")
    last = corpus_pipeline.token_ids(spark, back, SF)
    assert last.columns == ["doc_id", "ids", "n_tokens", "round_trip", "mix_file", "mix_row"]
    assert last.groupBy("mix_file", "mix_row").count().where("count > 1").isEmpty()
    assert [r.doc_id for r in last.orderBy("mix_file", "mix_row").collect()] == [r.doc_id for r in want.collect()]


INNER = "_mix_slot _mix_block _mix_source _mix_slots _mix_at _again _dropped _row _order _key key row place fp root n text_ metadata _metadata"


def test_inner_names_and_other_types(spark, prose):
    """Columns called like the operators' own, of types without an order, and copies without a key."""
    names = INNER.split()
    extra = [f"'x' AS `{n}`" for n in names]
    texts = [prose(1, 60), prose(1, 60), prose(2, 50) + " password=hunter2hunter2", prose(3, 70), prose(3, 70), prose(4, 40)]
    keys = [1, None, 2, None, None, 3]
    docs = spark.createDataFrame([(k, t, "en", s, "many") for k, t, s in zip(keys, texts, "aabbab")],
                                 "doc_id long, text string, lang string, source string, n_chars string")
    docs = docs.selectExpr("*", *extra, "map('a', 1) AS m", "array(1) AS a", "struct(1 AS b) AS s")
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns
    assert sorted((r.doc_id, r.text) if r.doc_id else (0, r.text) for r in one.collect()) == sorted([(1, texts[0]), (2, texts[2]), (0, texts[3]), (3, texts[5])])
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert {(r["_mix_slot"], r["_again"], r["row"], r["n_chars"], r["m"]["a"]) for r in rows} == {("x", "x", "x", "many", 1)}, name
    assert len(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()) == len(texts)


def test_stages_return_the_columns_of_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.known_language(spark, docs, SF)
    lost = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert len(lost) <= 0.01 * docs.count()


POLISH = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. "
FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. "
ENGLISH = "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience. "


def test_noise_and_unlearned_languages_go(spark):
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = [base64.b64encode(draw.randbytes(n)).decode() for n in (300, 3000)] + [(t * 20)[:n] for t in (POLISH, FINNISH) for n in (200, 2000)]
    noise += [" ".join("".join(draw.choices(letters, k=draw.randint(2, 9))) for _ in range(n)) for n in (60, 500)]
    clean = [(ENGLISH * 20)[:n] for n in (64, 200, 2000)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(10**6 + i, t, None, "a", len(t)) for i, t in enumerate(noise)] + [(2 * 10**6 + i, t, None, "a", len(t)) for i, t in enumerate(clean)]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, docs.select(more.columns).unionByName(more), SF).collect()}
    assert not {k for k in kept if 10**6 <= k < 2 * 10**6}
    assert {r[0] for r in rows[len(noise):]} <= kept
