"""Reports sent again, over several micro-batches and a restart."""

import datetime as dt
import time

import pandas as pd
import pytest

from reportloom.operators.redaction import redact
from reportloom.streaming.versions import _newest, _newest_of_bucket, read_latest, redact_latest_stream

SCHEMA = "path string, modified timestamp, content string, sent int"
DAY = dt.datetime(2024, 5, 1)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


BATCHES = [
    [("a", at(0), "mail x@y.com"), ("b", at(1), "old"), ("a", at(0), "mail x@y.com"), (None, at(1), "no path"), ("c", None, "no time")],
    [("a", at(0), "mail x@y.com"), ("b", at(3), "new 12.03.2020"), ("b", at(2), "between"), ("d", at(2), "tie 1"), ("d", at(2), "tie 2")],
    [("d", at(2), "tie 1"), ("d", at(2), "tie 2"), ("e", at(4), None), ("f", at(4), "")],
    [("g", at(100), "far ahead")],
    [("h", at(5), "too late to be taken"), ("b", at(3), "new 12.03.2020"), ("g", at(90), "older"), ("b", at(101), "newest")],
]


def test_batches_and_restart(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    arriving = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    for number, rows in enumerate(BATCHES):
        spark.createDataFrame([(*r, number) for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        if number != 1:  # batches 1 and 2 come in one run, every run starts from the checkpoint
            redact_latest_stream(arriving(), target, checkpoint, lateness="1 day").awaitTermination()
    got = sorted(((r.path, r.modified, r.redacted, r.n_versions) for r in read_latest(spark, target).collect()), key=repr)

    best = {}
    for path, modified, content in (r for rows in BATCHES for r in rows if r[0] and r[1] and r[0] != "h"):
        digest = __import__("hashlib").md5(content.encode()).hexdigest() if content is not None else ""
        best.setdefault(path, set()).add((modified, digest, content))
    texts = [(p, *max(v)) for p, v in best.items()] + [(None, at(1), "", "no path"), ("c", None, "", "no time")]
    batch = redact(spark.createDataFrame(texts, "path string, modified timestamp, digest string, content string"), text="content")
    assert [g[:3] for g in got] == sorted(((r.path, r.modified, r.redacted) for r in batch.collect()), key=repr)
    taken = {g[0]: g[3] for g in got}
    assert taken["a"] == 1 and taken["b"] == 3 and taken["e"] == 1 and taken["g"] == 1


def test_empty_input(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    arriving = spark.readStream.schema(SCHEMA).parquet(source)
    redact_latest_stream(arriving, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    latest = redact_latest_stream(arriving, str(tmp_path / "out"), str(tmp_path / "state"))
    latest.awaitTermination()
    assert latest.exception() is None


def test_newest_version_is_found_without_sorting_frames(monkeypatch):
    class State:
        exists, hasTimedOut = True, False
        get = (5, "a")

        def update(self, value):
            self.kept = value

        def setTimeoutTimestamp(self, millis):
            self.until = millis

        def getCurrentWatermarkMs(self):
            return 0

    frames = [pd.DataFrame({"path": "p", "content": list("xyz"), "micros": [4, 5, 5], "digest": ["z", "b", "a"]}),
              pd.DataFrame({"path": "p", "content": [None], "micros": [6], "digest": [""]})]
    monkeypatch.delattr(pd.DataFrame, "sort_values")
    state = State()
    got = [row for frame in _newest(("p",), iter(frames), state) for row in frame.itertuples(index=False, name=None)]
    assert got == [("p", 6, None)] and state.kept == (6, "")
    assert not list(_newest(("p",), iter([frames[0].head(1)]), state))


class Bucket:
    """A state as Spark gives it, kept over calls."""

    def __init__(self):
        self.kept, self.watermark, self.hasTimedOut, self.until = None, 0, False, None

    exists = property(lambda self: self.kept is not None)
    get = property(lambda self: self.kept)

    def update(self, value):
        self.kept = value

    def remove(self):
        self.kept = None

    def setTimeoutTimestamp(self, millis):
        assert millis > self.watermark
        self.until = millis

    def getCurrentWatermarkMs(self):
        return self.watermark


def test_paths_of_a_bucket_share_one_call():
    state = Bucket()

    def sent(*rows):
        frames = [pd.DataFrame([row], columns=["path", "micros", "digest", "content"], dtype=object) for row in rows]
        return [r for f in _newest_of_bucket((1,), iter(frames), state) for r in f.itertuples(index=False, name=None)]

    assert sent(("a", 5000, "x", "1"), ("b", 7000, "x", None), ("a", 6000, "x", "2"), ("a", 5000, "y", "3")) == [("a", 6000, "2"), ("b", 7000, None)]
    assert sent(("a", 6000, "x", "2"), ("b", 6000, "z", "older")) == [] and state.until == 7
    assert sent(("a", 6000, "y", "4"), ("c", 9000, "", "5")) == [("a", 6000, "4"), ("c", 9000, "5")]
    state.watermark = 8  # paths behind it are compared once more, then forgotten
    assert sent(("b", 6500, "", "late"), ("b", 7500, "", "6")) == [("b", 7500, "6")]
    assert state.kept[0] == ["c"] and state.until == 10
    state.watermark, state.hasTimedOut = 11, True
    assert sent() == [] and not state.exists


@pytest.mark.parametrize("buckets", [1, 3, None])
def test_any_number_of_buckets(spark, tmp_path, buckets):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    for number, rows in enumerate(BATCHES):
        spark.createDataFrame([(*r, number) for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(SCHEMA).parquet(source)
        redact_latest_stream(arriving, target, checkpoint, lateness="1 day", buckets=buckets).awaitTermination()
    got = {(r.path, r.modified, r.n_versions) for r in read_latest(spark, target).collect() if r.path and r.modified}
    assert got == {("a", at(0), 1), ("b", at(101), 3), ("d", at(2), 1), ("e", at(4), 1), ("f", at(4), 1), ("g", at(100), 1)}


def test_a_run_leaves_no_shuffle_files(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(*r, 0) for r in BATCHES[0]], SCHEMA).coalesce(1).write.parquet(source)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in map(blocks.getAllFiles().apply, range(blocks.getAllFiles().size()))}
    before = files()
    redact_latest_stream(spark.readStream.schema(SCHEMA).parquet(source), target, checkpoint).awaitTermination()
    for _ in range(50):  # files go in the background
        left = [f for f in files() - before if f.startswith("shuffle_")]
        time.sleep(0.1 if left else 0)
    assert not left
