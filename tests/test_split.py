import math

import pytest
from pyspark.sql import functions as F

from reportloom.operators.split import number_rows, split_sizes, three_way_split, train_eval_split, with_row_number


def sizes(df):
    return {r["split"]: r["n"] for r in split_sizes(df).collect()}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 25, 1000])
def test_sizes_are_exact(spark, n):
    df = spark.range(n)
    first = round(n * 0.2)
    second = round((n - first) * 0.4)
    want = {"simple": first, "medium": second, "cot": n - first - second}
    assert sizes(three_way_split(df, key="id")) == {k: v for k, v in want.items() if v}
    held = math.ceil(n * 0.1)
    assert sizes(train_eval_split(df, key="id")) == {k: v for k, v in {"eval": held, "train": n - held}.items() if v}


def test_same_seed_same_rows_another_seed_others(spark):
    df = spark.range(300).repartition(5)
    pick = lambda seed: {r.id for r in train_eval_split(df, key="id", seed=seed).filter("split = 'eval'").collect()}
    assert pick(1) == pick(1) and pick(1) != pick(2)


def test_every_row_once(spark):
    split = three_way_split(spark.range(500), key="id")
    assert split.count() == 500 == split.select("id").distinct().count()


def test_full_split_in_one_plan_has_no_pairwise_join(spark):
    plan = three_way_split(spark.range(10), key="id")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_fractions_are_checked(spark):
    for bad in ({"first": 0.0}, {"first": 0.7, "second": 0.4}, {"second": 1.0}):
        with pytest.raises(ValueError):
            three_way_split(spark.range(3), key="id", **bad)
    with pytest.raises(ValueError):
        train_eval_split(spark.range(3), key="id", test_size=1.5)


def test_disabled_split_is_all_train(spark):
    assert sizes(train_eval_split(spark.range(4), key="id", enabled=False)) == {"train": 4}


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_numbers_are_dense_and_follow_the_hash(spark, digits):
    rows = number_rows(spark.range(200), key="id", digits=digits).select(
        "orig_index", F.md5(F.concat(F.lit("42:"), F.col("id").cast("string"))).alias("h")).orderBy("orig_index").collect()
    assert [r.orig_index for r in rows] == list(range(200))
    assert [r.h for r in rows] == sorted(r.h for r in rows)


def test_eval_rows_come_first_in_numbering(spark):
    both = number_rows(train_eval_split(spark.range(100), key="id"), key="id")
    assert {r.orig_index for r in both.filter("split = 'eval'").collect()} == set(range(10))


def test_frequent_and_missing_keys_keep_sizes_and_rows(spark):
    df = spark.range(100).selectExpr("id", "CASE WHEN id < 30 THEN -1 WHEN id < 60 THEN NULL ELSE id END AS k")
    for _ in range(2):
        split = three_way_split(df, key="k")
        assert split.columns == ["id", "k", "split"]
        assert {r.split: r.n for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()} == {"simple": 20, "medium": 32, "cot": 48}
        assert {r.id for r in split.collect()} == set(range(100))
    assert sorted(r.orig_index for r in number_rows(df, key="k").collect()) == list(range(100))


def test_row_numbers_follow_the_input(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7)
    assert all(r.id == r.row_number for r in with_row_number(df).collect())


def test_rows_without_id_get_their_number(spark):
    from reportloom.operators.compiling import inference_rows

    rows = spark.createDataFrame([("a", "f0"), (None, "f1"), ("c", "f2")], "id string, finding string").coalesce(1)
    assert [r.id for r in inference_rows(rows).orderBy("finding").collect()] == ["a", "1", "c"]
    assert [r.id for r in inference_rows(rows.drop("id")).orderBy("finding").collect()] == ["0", "1", "2"]
