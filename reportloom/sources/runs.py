"""Tables that grow by whole runs, and appends that can be repeated.

A run writes its files to a folder of its own and then publishes that folder by one empty entry, whose name says which
run, which try of it and which folder counts. Creating an entry is a single step on any file system, so a run is there
as a whole or not at all: files of a run that broke off are never read, and a run done again takes the place of its
earlier try. Entries are as many as runs; only they are listed by the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run_id"


def _place(spark: SparkSession, path: str):
    """The path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _entries(spark: SparkSession, folder: str) -> dict[str, list[tuple[int, str]]]:
    """run -> its tries (number, folder name), oldest first. Of two tries with one number the larger name counts."""
    place, files = _place(spark, f"{folder}/entries")
    tries: dict[str, list[tuple[int, str]]] = {}
    if files.exists(place):
        for status in files.listStatus(place):
            run, number, part = status.getPath().getName().split("~")
            tries.setdefault(unquote(run[1:]), []).append((int(number), part))
    return {run: sorted(found) for run, found in tries.items()}


def stage_run(df: DataFrame, folder: str, write: Callable[[DataFrame, str], None]) -> str:
    """Write a run's rows where no reader looks; returns the name to publish them by."""
    part = uuid.uuid4().hex
    write(df, f"{folder}/data/{part}")
    return part


def publish_run(spark: SparkSession, folder: str, run_id: str, part: str) -> None:
    """From here on the rows staged as ``part`` are those of ``run_id``."""
    number = max((n for n, _ in _entries(spark, folder).get(run_id, [])), default=0) + 1
    # "~" is kept by quote(), so it is quoted by hand; a letter in front keeps an empty or dotted name visible
    name = quote(run_id, safe="").replace("~", "%7E")
    place, files = _place(spark, f"{folder}/entries/r{name}~{number}~{part}")
    files.create(place, False).close()


def append_run(df: DataFrame, folder: str, run_id: str, write: Callable[[DataFrame, str], None]) -> None:
    """Add a run's rows, or put them in the place of those the same run has there."""
    publish_run(df.sparkSession, folder, run_id, stage_run(df, folder, write))


def run_folders(spark: SparkSession, folder: str) -> dict[str, str]:
    """run -> folder of the rows that count."""
    return {run: f"{folder}/data/{tries[-1][1]}" for run, tries in sorted(_entries(spark, folder).items())}


def read_runs(spark: SparkSession, folder: str, read: Callable[[list[str]], DataFrame], empty: str | None = None) -> DataFrame:
    """Rows of all published runs; ``read`` gets their folders. Without a run: a table without rows of the schema
    ``empty``, or an error if that is not given."""
    folders = list(run_folders(spark, folder).values())
    if folders:
        return read(folders)
    if empty is None:
        raise FileNotFoundError(f"no run was published in {folder}")
    return spark.createDataFrame([], empty)


def remove_superseded(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete all but the last ``keep`` tries of every run, entry first; returns their number. Rows staged but not
    published may belong to a run at work and stay."""
    gone = 0
    for run, tries in _entries(spark, folder).items():
        name = quote(run, safe="").replace("~", "%7E")
        for number, part in tries[:-keep]:
            for path in (f"{folder}/entries/r{name}~{number}~{part}", f"{folder}/data/{part}"):
                place, files = _place(spark, path)
                files.delete(place, True)
            gone += 1
    return gone


def with_run(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumn(RUN, F.lit(run_id))
