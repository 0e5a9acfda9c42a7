"""Input tables and the shared folder."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from scrollspark.session import arrow_rows, shared_folder

__all__ = ["arrow_rows", "fresh_path", "path_of", "removed", "scratch", "table", "written"]

# Joins of whole documents with tables of ids carry the hint "merge": such tables grow with the
# corpus, so the plan is the same at every size and never leans on a broadcast.


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_open: list[list[str]] = []


@contextlib.contextmanager
def scratch() -> Iterator[list[str]]:
    """The folders that are made inside, for whoever may delete them once their tables are read."""
    made: list[str] = []
    _open.append(made)
    try:
        yield made
    finally:
        _open.pop()


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/scrollspark-{name}-{uuid.uuid4().hex}"
    for made in _open:
        made.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def removed(spark: SparkSession, *paths: str) -> None:
    """Deletes tables of the shared folder that are no longer read."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_of(df: DataFrame) -> str:
    """The folder of a table made by written()."""
    return df.inputFiles()[0].rsplit("/", 1)[0] if df.inputFiles() else ""
