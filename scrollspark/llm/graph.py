"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrollspark.llm.tables import path_of, removed, written

MAX_ROUNDS = 60
SMALL = 200_000  # edges, checked by a count: up to so many one task joins them without rounds


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over all edges of one small table."""
    root: dict = {}
    kind = None

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        kind = batch.column(0).type
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    for at in range(0, len(nodes), 50_000):
        part = nodes[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([find(x) for x in part], kind)], ["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); the component is its smallest node.

    Up to SMALL edges are joined by one task; beyond, the rounds below share the work.
    Nodes are of any ordered type.  Every round is two aggregations to one
    minimum per node and two joins with them; neighbours are never collected.
    Each round is written to the shared folder.  A table of no edges has no
    components.
    """
    spark = edges.sparkSession
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _state(now)
    if seen[0] <= SMALL:
        kind = now.schema["u"].dataType.simpleString()
        return now.coalesce(1).mapInArrow(_joined, f"node {kind}, component {kind}")
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        old, now = now, written(small, "edges")
        state = _state(now)
        removed(spark, path_of(old))
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
