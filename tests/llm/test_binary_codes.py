import math

import numpy as np
import pytest

from reportloom.llm import binary_codes


def brute(rows, threshold):
    """Links and components by comparing all pairs."""
    good = [(k, v) for k, v in rows if v and None not in v and all(map(math.isfinite, v)) and any(v)]
    links = {i: 0 for i in range(len(good))}
    up = list(range(len(good)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(good)):
        for j in range(i):
            a, b = np.array(good[i][1], float), np.array(good[j][1], float)
            if len(a) == len(b):
                a, b = a / abs(a).max(), b / abs(b).max()
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold - 1e-15:
                    links[i] += 1
                    links[j] += 1
                    x, y = sorted((root(i), root(j)))
                    up[y] = x
    least = {}
    for i, (k, _) in enumerate(good):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    out = [(k, links[i], least.get(root(i))) for i, (k, _) in enumerate(good)]
    alone = [(k, 0, k) for k, v in rows if not (v and None not in v and all(map(math.isfinite, v)) and any(v))]
    return sorted(out + alone, key=str)


def clusters(seed, size, centres, each, spread):
    draw, rows = np.random.default_rng(seed), []
    for _ in range(centres):
        centre = draw.standard_normal(size)
        centre /= np.linalg.norm(centre)
        rows += [(centre + spread * draw.random() * draw.standard_normal(size) / math.sqrt(size)).astype(np.float32) for _ in range(each)]
    draw.shuffle(rows)
    return [(i, [float(x) for x in v]) for i, v in enumerate(rows)]


def run(spark, rows, threshold=0.95, kind="float"):
    frame = spark.createDataFrame([(k, v, "l", 1) for k, v in rows], f"vec_id long, embedding array<{kind}>, n_links string, keys int")
    got = binary_codes.near_vectors(frame, threshold=threshold)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())
    return sorted((tuple(r)[:3] for r in got.collect()), key=str)


@pytest.mark.parametrize(("size", "spread"), [(64, 0.5), (64, 0.3), (100, 0.45), (8, 0.4)])
def test_all_links(spark, size, spread):
    rows = clusters(size, size, 40, 12, spread)
    got, want = run(spark, rows), brute(rows, 0.95)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 100 and 0.99 * there <= found <= there
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))


def test_clear_groups_are_exact(spark):
    rows = clusters(3, 64, 60, 10, 0.2)
    assert run(spark, rows) == brute(rows, 0.95)


def test_crowded_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(binary_codes, "BLOCK", 16)
    rows = clusters(4, 16, 4, 60, 0.2)
    assert run(spark, rows) == brute(rows, 0.95)


def test_odd_vectors(spark):
    a = [1.0, 2.0, 3.0]
    rows = [(1, a), (2, a), (2, a), (3, [2.0, 4.0, 6.0]), (4, [-1.0, -2.0, -3.0]), (5, None), (6, []), (7, [0.0, -0.0, 0.0]), (8, [1.0, None, 3.0]),
            (9, [float("nan"), 1.0, 1.0]), (10, [float("inf"), 1.0, 1.0]), (11, [1.0, 2.0]), (None, a), (None, [0.0]), (12, [1e-30, 2e-30, 3e-30]), (13, [1e30, 2e30, 3e30])]
    assert run(spark, rows) == brute(rows, 0.95)


def test_no_vectors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1)]


def test_given_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert sorted((tuple(r)[:3] for r in binary_codes.near_vectors(frame).collect()), key=str) == brute(rows, 0.95)


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(9)
    errors, misses = [], 0
    for _ in range(30):
        units = binary_codes.unit(draw.standard_normal((60, 64)) + 2 * draw.standard_normal(64))
        codes = binary_codes.encoded(units)
        true = units @ units.T
        bounds = binary_codes.upper_bounds(codes, codes, 64)
        factor, step = codes[1][:, None], codes[4]
        spread = np.sqrt(1 - factor**2) / math.sqrt(63) / factor + step / 2 / factor
        off = ~np.eye(60, dtype=bool)
        errors.append((bounds - binary_codes.DEVIATIONS * spread - true)[off].mean())
        misses += (bounds < true)[off].sum()
    assert abs(np.mean(errors)) < 0.02 and misses <= 30 * 60 * 59 * 1e-3


def test_table_plan():
    bits, tables = binary_codes.table_plan(1_000_000, 0.95)
    assert 14 <= bits <= 16
    meets = (1 - math.acos(0.95) / math.pi) ** bits
    assert 1 - (1 - meets) ** tables >= 0.999
