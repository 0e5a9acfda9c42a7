"""Incremental ingest: each new file is read once, and tables are published per micro-batch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrollspark.functions import parsing
from scrollspark.operators import ingest
from scrollspark.operators.store import SnapshotStore


def ingest_stream(spark: SparkSession, folder: str, store: SnapshotStore, checkpoint: str, files_per_batch: int | None = None, **options) -> None:
    """Ingests the files of folder that no earlier call has, then returns.  store holds papers, categories and links."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def apply(batch: DataFrame, _: int) -> None:
        store.begin()
        lines = ingest.with_ordinals(batch)
        result = ingest.load_into(store, lines, **options)
        store.publish(papers=result.papers, categories=result.categories, links=result.links)

    ingest.placed(reader.load(folder)).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def records_stream(spark: SparkSession, folder: str, target: str, checkpoint: str) -> DataFrame:
    """Parses new files of JSON lines to (id, title) rows in a Parquet folder; returns all rows so far."""
    lines = spark.readStream.format("text").load(folder)
    rec = parsing.record(F.col("value"))
    rows = lines.select(rec.alias("r")).where(F.col("r").isNotNull() & parsing.truthy(F.col("r")["id"])).select(F.col("r")["id"].alias("id"), F.col("r")["title"].alias("title"))
    rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("id string, title string").parquet(target)


def poll(select: Callable[[], DataFrame], handle: Callable[[DataFrame], None]) -> bool:
    """One turn of a worker: handles what there is to do; whether there was anything."""
    work = select()
    if work.isEmpty():
        return False
    handle(work)
    return True


def work(select: Callable[[], DataFrame], handle: Callable[[DataFrame], None], idle_limit: int = 30, pause: float = 10.0, sleep: Callable[[float], None] = time.sleep) -> int:
    """Turns of a worker until it finds nothing to do so many times one after the other; returns how many turns had work."""
    busy = idle = 0
    while idle < idle_limit:
        if poll(select, handle):
            busy, idle = busy + 1, 0
        else:
            idle += 1
            if idle < idle_limit:
                sleep(pause)
    return busy
