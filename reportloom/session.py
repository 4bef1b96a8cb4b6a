"""Session helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: str = "8", memory: str = "16g", app: str = "reportloom") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per session; needless where it is installed on all machines."""
    context = spark.sparkContext
    if getattr(context, "_reportloom_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    packed = Path(tempfile.mkdtemp(prefix="reportloom-")).resolve() / f"reportloom-{uuid.uuid4().hex}.zip"  # read by the driver only
    with zipfile.ZipFile(packed, "w") as out:
        for folder in ("reportloom", "queries"):
            for source in sorted((root / folder).rglob("*.py")):
                out.write(source, source.relative_to(root))
    context.addPyFile(str(packed))
    context._reportloom_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="reportloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files; otherwise these stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
