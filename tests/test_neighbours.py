import numpy as np
import pytest
from pyspark.sql import functions as F

from reportloom.functions.vectors import cosine, unit
from reportloom.operators.models import encode, score_requests
from reportloom.operators import neighbours as N
from reportloom.operators.neighbours import top_k
from reportloom.operators.vector_index import build_index, load_index, save_index

WHOLE, BLOCKS = {}, {"block_rows": 17}


def tables(spark, q, c, ids=int):
    queries = spark.createDataFrame([(ids(i), v.astype(float).tolist()) for i, v in enumerate(q)], f"query_id {'bigint' if ids is int else 'string'}, embedding array<float>")
    corpus = spark.createDataFrame([(ids(i), v.astype(float).tolist()) for i, v in enumerate(c)], f"corpus_id {'bigint' if ids is int else 'string'}, embedding array<float>")
    return queries.repartition(3), corpus.repartition(5)


def brute(q, c, k, normalized):
    out = set()
    for i, v in enumerate(q.astype(np.float32).astype(float)):
        w = c.astype(np.float32).astype(float)
        score = np.round(w @ v if normalized else ((w - v) ** 2).sum(1), 6)
        order = np.lexsort((np.arange(len(c)), -score if normalized else score))[:k]
        out |= {(i, int(j), r + 1, round(float(score[j]), 6)) for r, j in enumerate(order)}
    return out


@pytest.mark.parametrize("way", [WHOLE, BLOCKS], ids=["whole", "blocks"])
@pytest.mark.parametrize("normalized", [True, False])
@pytest.mark.parametrize("k", [1, 5, 500])
def test_equals_brute_force(spark, way, normalized, k):
    rng = np.random.default_rng(3)
    q, c = rng.integers(-2, 3, (40, 6)), rng.integers(-2, 3, (90, 6))  # many ties
    got = top_k(*tables(spark, q, c), k, normalized=normalized, **way)
    assert {(r.query_id, r.corpus_id, r["rank"], round(r.score, 6)) for r in got.collect()} == brute(q, c, k, normalized)


@pytest.mark.parametrize("way", [WHOLE, BLOCKS], ids=["whole", "blocks"])
def test_a_third_of_the_corpus_is_one_vector(spark, way):
    c = np.vstack([np.ones((60, 4)), np.random.default_rng(1).normal(size=(120, 4))])
    q = np.ones((30, 4))
    got = top_k(*tables(spark, q, c), 3, normalized=False, **way)
    assert {(r.query_id, r.corpus_id, r["rank"], r.score) for r in got.collect()} == {(i, j, j + 1, 0.0) for i in range(30) for j in range(3)}


@pytest.mark.parametrize("way", [WHOLE, BLOCKS], ids=["whole", "blocks"])
def test_text_ids_nulls_and_empty_sides(spark, way):
    q, c = np.eye(3), np.eye(3)[::-1]
    queries, corpus = tables(spark, q, c, ids=lambda i: f"v{i}")
    more = corpus.unionByName(spark.createDataFrame([("none", None)], corpus.schema))
    assert {(r.query_id, r.corpus_id) for r in top_k(queries, more, 1, **way).collect()} == {("v0", "v2"), ("v1", "v1"), ("v2", "v0")}
    assert top_k(queries.limit(0), corpus, 2, **way).count() == 0
    assert top_k(queries, corpus.limit(0), 2, **way).count() == 0


def test_no_pairwise_join_in_the_plan(spark):
    queries, corpus = tables(spark, np.eye(3), np.eye(3))
    for way in (WHOLE, BLOCKS):
        plan = top_k(queries, corpus, 2, **way)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_unit_and_cosine(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, b array<float>").select(
        unit(F.col("a")).alias("u"), unit(F.col("b")).alias("z"), cosine(F.col("a"), F.col("b")).alias("c")).first()
    assert row.u == pytest.approx([0.6, 0.8]) and row.z == [0.0, 0.0] and row.c == 0.0


def lengths():
    return lambda texts: np.array([[len(t), 1.0] for t in texts], dtype=np.float32)


def test_index_keeps_settings_and_refuses_another_model(spark, tmp_path):
    df = spark.createDataFrame([(1, "находка", "итог"), (2, "None", "x"), (3, " ", "y"), (4, None, "z")], "id int, finding_text string, result_text string")
    index = build_index(df, lambda d: encode(d, lengths, text="finding"), key="id")
    save_index(index, str(tmp_path / "i"), model_name="m", normalize=True)
    loaded, settings = load_index(spark, str(tmp_path / "i"), model_name="m")
    assert [(r.vec_id, r.finding, r.result) for r in loaded.collect()] == [(1, "находка", "итог")] and settings["normalize"] is True
    with pytest.raises(ValueError):
        load_index(spark, str(tmp_path / "i"), model_name="other")
    with pytest.raises(ValueError):
        save_index(index.limit(0), str(tmp_path / "j"), model_name="m")


def test_failing_requests_are_rows(spark):
    def scorer():
        def score(prompts):
            if "bad" in prompts:
                raise RuntimeError("refused")
            return [p.upper() for p in prompts]
        return score

    df = spark.createDataFrame([(1, "ok"), (2, "bad")], "id int, prompt string").coalesce(1)
    assert {tuple(r) for r in score_requests(df, scorer).collect()} == {
        (1, "ok", "OK", "ok", None), (2, "bad", None, "failed", "RuntimeError: refused")}


def test_broken_vectors_and_lengths(spark):
    rows = [(i, [float(i), 1.0]) for i in range(20)] + [(20, [float("nan"), 1.0]), (21, [float("inf"), 1.0]), (22, [None, 1.0])]
    df = spark.createDataFrame(rows, "query_id bigint, embedding array<double>")
    near = top_k(df, df.withColumnRenamed("query_id", "corpus_id"), 5)
    assert near.count() == 100 and near.agg(F.max("query_id")).first()[0] == 19
    mixed = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0])], "corpus_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="different lengths"):
        top_k(df, mixed, 2).collect()
    with pytest.raises(Exception, match="dimensions"):
        top_k(df, mixed.filter("corpus_id = 1"), 2).collect()


def test_distances_far_from_the_origin(spark):
    rows = [(i, [1e6 + i * 1e-3, 1e6]) for i in range(6)]
    df = spark.createDataFrame(rows, "query_id bigint, embedding array<double>")
    got = top_k(df.filter("query_id = 5"), df.withColumnRenamed("query_id", "corpus_id"), 6, normalized=False)
    assert [r.corpus_id for r in got.orderBy("rank").collect()] == [5, 4, 3, 2, 1, 0]


def test_a_failed_rebuild_keeps_the_index(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "b")], "id int, finding_text string, result_text string")
    index = build_index(df, lambda d: encode(d, lengths, text="finding"), key="id")
    save_index(index, str(tmp_path / "i"), model_name="m")
    with pytest.raises(ValueError):
        save_index(index.limit(0), str(tmp_path / "i"), model_name="m")
    assert load_index(spark, str(tmp_path / "i"))[0].count() == 1


def test_one_bad_prompt_costs_few_calls(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def scorer():
        import uuid

        def score(prompts):
            (log / uuid.uuid4().hex).write_text(str(len(prompts)))
            if "bad" in prompts:
                raise RuntimeError("refused")
            return list(prompts)
        return score

    df = spark.createDataFrame([(i, "bad" if i == 77 else f"p{i}") for i in range(256)], "id int, prompt string").coalesce(1)
    got = score_requests(df, scorer, batch_size=64).collect()
    assert [r.id for r in got if r.status == "failed"] == [77] and len(got) == 256
    assert len(list(log.iterdir())) <= 4 + 2 * 6


def test_few_prompts_at_a_time_are_python_texts(spark):
    def scorer():
        import tracemalloc

        class Score:
            def __init__(self):
                tracemalloc.start()

            def __call__(self, prompts):
                return [str(tracemalloc.get_traced_memory()[0]) for _ in prompts]

            def __del__(self):
                tracemalloc.stop()
        return Score()

    df = spark.range(0, 2_000, 1, 1).select("id", F.concat(F.repeat(F.lit("words "), 1_000), F.lit("\U0001f600"), F.col("id").cast("string")).alias("prompt"))
    got = score_requests(df, scorer, batch_size=64).agg(F.count("content").alias("n"), F.max(F.col("content").cast("long")).alias("most")).first()
    assert got.n == 2_000 and got.most < 30_000_000, got  # a batch of 12 MB and 64 texts of 24 kB, not all 48 MB of them


def clusters(rng, n, d=8, centres=12, spread=0.02):
    at = rng.normal(size=(centres, d))
    return at[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, d))


@pytest.mark.parametrize("normalized", [True, False])
@pytest.mark.parametrize("kind", ["clustered", "uniform", "scaled", "far"])
def test_pruned_search_is_exact(spark, kind, normalized):
    rng = np.random.default_rng(11)
    draw = {"clustered": lambda n: clusters(rng, n), "uniform": lambda n: rng.normal(size=(n, 8)),
            "scaled": lambda n: rng.normal(size=(n, 8)) * 10.0 ** rng.integers(-3, 3, (n, 1)), "far": lambda n: 1e3 + rng.normal(size=(n, 8))}[kind]
    c = draw(900)
    c[300:330] = c[0]
    q = np.vstack([draw(50), c[:10]])
    got = top_k(*tables(spark, q, c), 7, normalized=normalized, block_rows=40)
    found = {(r.query_id, r["rank"]): (r.corpus_id, r.score) for r in got.collect()}
    w, v = c.astype(np.float32).astype(float), q.astype(np.float32).astype(float)
    for i in range(len(v)):
        score = (w * v[i]).sum(1) if normalized else ((w - v[i]) ** 2).sum(1)
        order = np.lexsort((np.arange(len(w)), -score if normalized else score))[:7]
        assert [found[i, r + 1][0] for r in range(7)] == order.tolist()
        assert [found[i, r + 1][1] for r in range(7)] == pytest.approx(score[order], rel=1e-9, abs=1e-6)


def rings_of(spark, corpus, rows):
    _, c = tables(spark, corpus[:1], corpus)
    grouped, rings = N._grouped(c.select(F.col("corpus_id").alias("c_id"), F.col("embedding").alias("c_vec")), rows)
    return grouped, rings


@pytest.mark.parametrize("largest", [True, False])
def test_bounds_hold_for_every_vector(spark, largest):
    rng = np.random.default_rng(12)
    corpus = np.vstack([clusters(rng, 300), rng.normal(size=(200, 8)) * 5]).astype(np.float32)
    grouped, rings = rings_of(spark, corpus, 30)
    rows = {r.c_id: r.group for r in grouped.collect()}
    assert len(rows) == 500 and sum(r.rows for r in rings.rings) == 500 and len(rings.rings) > 8
    queries = np.vstack([rng.normal(size=(40, 8)), corpus[:40]]).astype(float)
    bound = N._bounds(queries, rings, largest)
    for i, group in rows.items():
        x = corpus[i].astype(float)
        cost = -(queries @ x) if largest else ((queries - x) ** 2).sum(1)
        assert (bound[:, group] <= cost).all()


def test_few_block_pairs_of_clustered_vectors(spark):
    """What is skipped: nearly all pairs of clustered vectors; nothing is given up where there is no structure."""
    rng = np.random.default_rng(13)
    shares = {}
    for kind, corpus in {"clustered": clusters(rng, 2000, centres=40), "uniform": rng.normal(size=(2000, 8))}.items():
        _, rings = rings_of(spark, corpus, 50)
        v = corpus[:100].astype(np.float32).astype(float)
        queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "q_id bigint, q_vec array<double>")
        exact = np.sort(((v[:, None] - corpus[None].astype(np.float32)) ** 2).sum(2), axis=1)[:, 4]
        border = spark.createDataFrame([(i, float(b)) for i, b in enumerate(exact)], "q_id bigint, border double")
        size = {i: r.rows for i, r in enumerate(rings.rings)}
        pairs = N._reached(queries, rings, 5, False, None).unionByName(N._reached(queries.join(border, "q_id"), rings, 5, False, "border"))
        shares[kind] = sum(size[r.group] for r in pairs.collect()) / (100 * 2000)
    assert shares["clustered"] < 0.1 and shares["clustered"] < shares["uniform"] <= 1


def test_far_from_the_origin_few_pairs_are_scored_exactly():
    rng = np.random.default_rng(14)
    c = 1e6 + rng.normal(size=(3000, 16))
    row, _ = N._candidates(c[:50], c, 5, False, np.full(50, np.inf))
    assert len(row) < 50 * 20


def test_a_known_border_leaves_few_pairs():
    rng = np.random.default_rng(15)
    c = rng.normal(size=(3000, 16))
    border = np.sort(-(c[:50] @ c.T), axis=1)[:, 4]
    row, _ = N._candidates(c[:50], c, 5, True, border)
    assert len(row) == 50 * 5


@pytest.mark.parametrize("largest", [True, False])
def test_small_blocks_do_not_multiply_the_queries(spark, largest):
    """However small the blocks are, a query is sent to a bounded number of tasks."""
    rng = np.random.default_rng(16)
    _, rings = rings_of(spark, rng.normal(size=(2000, 8)), 10)
    assert len(rings.rings) > 150
    queries = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(50)], "q_id bigint, q_vec array<double>")
    bundles = N._bundles(rings, N.BLOCK_ROWS)
    reached = N._reached(queries, rings, 5000, largest, None, bundles)
    assert reached.count() <= 50 * 2 * N.BUNDLES
    asked = sum(np.unpackbits(np.frombuffer(r.wanted, np.uint8)).sum() for r in reached.collect())
    assert asked == 50 * len(rings.rings)
