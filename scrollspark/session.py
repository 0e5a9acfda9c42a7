"""Spark sessions for the engine, and the engine's code for Spark's executors."""

from __future__ import annotations

import contextlib
import re
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from tempfile import mkdtemp

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def create(app: str = "scrollspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults: UTC, ANSI SQL, adaptive plans with skew joins.

    The number of shuffle partitions is left to the cluster; adaptive execution merges small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for key, value in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session gets a folder of this machine, and a cluster an error.
    """
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(mkdtemp(prefix="scrollspark-"))
    return context.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: cuts the lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/scrollspark-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Bounds the rows of an Arrow batch for the actions inside, where rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors once per application, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        target = Path(mkdtemp(prefix="scrollspark-")) / "scrollspark.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for path in sorted(root.rglob("*.py")):
                archive.write(path, f"{root.name}/{path.relative_to(root)}")
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)
    return spark
