"""Runs that are repeated, broken off or gone on with."""

import pytest
from pyspark.sql import functions as F

from reportloom.operators.models import answer_log, score_once
from reportloom.sources.readers import read_csv_runs, read_log_runs
from reportloom.sources.runs import publish_run, read_runs, remove_superseded, run_folders, stage_run
from reportloom.sources.writers import append_csv, append_log

RUN_IDS = ["run 1", "a/b", "ä~ö", "", ".hidden", "_x", "50%"]


def plain(df, path):
    df.write.parquet(path)


def test_repeated_and_broken_runs_equal_clean_ones(spark, tmp_path):
    clean, rough = str(tmp_path / "clean"), str(tmp_path / "rough")
    rows = spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit('say "x"').alias("t"))
    for folder in (clean, rough):
        for run_id in RUN_IDS:
            append_csv(rows, folder, run_id=run_id)
    stage_run(rows.withColumn("run_id", F.lit("late")), rough, plain)  # broke off before it was published
    broken = rows.withColumn("t", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        append_csv(broken, rough, run_id="a/b")
    append_csv(rows, rough, run_id="a/b")
    want = sorted((str(i), 'say "x"', r) for i in range(5) for r in RUN_IDS)
    for folder in (clean, rough):
        assert sorted(tuple(r) for r in read_csv_runs(spark, folder).collect()) == want
    assert set(run_folders(spark, rough)) == set(RUN_IDS)
    assert remove_superseded(spark, rough) == 1 and remove_superseded(spark, rough) == 0
    assert read_csv_runs(spark, rough).count() == len(want)


def test_the_last_try_counts(spark, tmp_path):
    folder = str(tmp_path / "t")
    first, second = (stage_run(spark.range(n), folder, plain) for n in (2, 3))
    publish_run(spark, folder, "r", second)
    publish_run(spark, folder, "r", first)
    assert read_runs(spark, folder, lambda p: spark.read.parquet(*p)).count() == 2


def test_no_runs(spark, tmp_path):
    assert read_log_runs(spark, str(tmp_path / "n"), "id bigint").columns == ["id"]
    with pytest.raises(FileNotFoundError):
        read_csv_runs(spark, str(tmp_path / "n"))


def test_log_keeps_nested_rows_and_nulls(spark, tmp_path):
    folder = str(tmp_path / "log")
    rows = spark.createDataFrame([(1, None, [("a", None)])], "id long, t string, x array<struct<k:string,v:string>>")
    for _ in range(2):
        append_log(rows, folder, run_id="r")
    back = read_log_runs(spark, folder, "id long, t string, x array<struct<k:string,v:string>>, run_id string").collect()
    assert [r.asDict(True) for r in back] == [{"id": 1, "t": None, "x": [{"k": "a", "v": None}], "run_id": "r"}]


def counting(path, down=()):
    """A scorer that notes every prompt it is asked, and fails on some."""

    def make():
        def score(prompts):
            if any(p in down for p in prompts):
                raise ConnectionError("down")
            with open(path, "a") as out:
                out.writelines(f"{p}\n" for p in prompts)
            return [f"<{p}>" for p in prompts]

        return score

    return make


def test_a_second_run_asks_for_the_rest_only(spark, tmp_path):
    log, asked = str(tmp_path / "log"), tmp_path / "asked"
    prompts = [f"p{i % 7}" for i in range(40)] + ["", None]
    df = spark.createDataFrame(list(enumerate(prompts)), "request int, prompt string")
    once = score_once(df, counting(asked, {"p1", "p2"}), log, requests_per_commit=3).collect()
    assert {r.prompt for r in once if r.status == "failed"} == {"p1", "p2"} and len(once) == len(prompts)
    asked.write_text("")
    again = score_once(df, counting(asked), log, requests_per_commit=3).collect()
    assert sorted(asked.read_text().split()) == ["p1", "p2"]
    assert [(r.request, r.prompt, r.content, r.status) for r in sorted(again)] == [(i, p, f"<{p}>", "ok") for i, p in enumerate(prompts)]
    assert answer_log(spark, log).count() == 11  # nine prompts, two of them tried twice
    asked.write_text("")
    assert score_once(df, counting(asked), log).count() == len(prompts) and asked.read_text() == ""
    score_once(df, counting(asked), log, asker="other model")
    assert len(asked.read_text().split("\n")) == 10


def test_a_run_that_breaks_off_keeps_its_slices(spark, tmp_path, monkeypatch):
    from reportloom.operators import models

    log, asked, commits = str(tmp_path / "log"), tmp_path / "asked", []
    df = spark.createDataFrame([(f"p{i}",) for i in range(60)], "prompt string")
    publish = models.append_run

    def third_breaks(*args):
        if len(commits) == 2:
            raise KeyboardInterrupt
        commits.append(publish(*args))

    monkeypatch.setattr(models, "append_run", third_breaks)
    with pytest.raises(KeyboardInterrupt):
        score_once(df, counting(asked), log, requests_per_commit=15)
    kept = answer_log(spark, log).count()
    assert 0 < kept < 60
    monkeypatch.undo()
    asked.write_text("")
    assert score_once(df, counting(asked), log).filter("status = 'ok'").count() == 60
    assert len(asked.read_text().split()) == 60 - kept


def test_no_requests(spark, tmp_path):
    assert score_once(spark.createDataFrame([], "prompt string"), counting(tmp_path / "a"), str(tmp_path / "l")).count() == 0
