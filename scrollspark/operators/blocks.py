"""Lists of a key in blocks: a key of any number of rows has several rows of bounded lists, in one order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrollspark.session import written

PER_BLOCK = 65_536


def ranked(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """rows with _rank, from 0 in the order of some columns, and _all, the number of rows, of their key.

    Rows are dealt by ranges of (key, order), equal ones by chance, so that a large key is shared by many tasks, and written with
    their places in their part.  A rank is the place after the key's first row in the part, and the key's rows in the parts before.
    Nulls come first; a null key is a key of its own.  Key and order should be short, for samples of them go to the driver.
    """
    names = [key, *order, "_any"]
    # The upper bits of the place are the part.
    placed = rows.withColumn("_any", F.rand(7)).repartitionByRange(*names).sortWithinPartitions(*names).withColumn("_place", F.monotonically_increasing_id())
    parts = written(placed.drop("_any").withColumn("_part", F.shiftright("_place", 33)), "ranked")
    sizes = parts.groupBy(key, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_here"))
    of_key = Window.partitionBy(key)
    before = F.sum("_here").over(of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_here")
    known = sizes.select(F.col(key).alias("_key"), F.col("_part").alias("_of"), "_first", before.alias("_before"), F.sum("_here").over(of_key).alias("_all"))
    both = parts.join(known.hint("merge"), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of")))
    return both.select(*rows.columns, (F.col("_before") + F.col("_place") - F.col("_first")).alias("_rank"), "_all")


def list_blocks(rows: DataFrame, key: str, order: Sequence[str], value: str, per_block: int = PER_BLOCK) -> DataFrame:
    """key, block, blocks, total, items: the values of each key in order, at most per_block in a row.

    block counts from 0; blocks and total are the key's numbers of blocks and values.  Rows equal in order go by a hash of
    the value.  Null values are items, too; a null key is a key of its own; an empty table gives no rows; other columns are ignored.
    """
    if per_block < 1:
        raise ValueError(f"per_block must be at least 1, not {per_block}")
    by = [f"_by{i}" for i in range(len(order))]
    plain = rows.select(F.col(key).alias("_of_key"), *(F.col(c).alias(n) for c, n in zip(order, by, strict=True)), F.xxhash64(value).alias("_hash"), F.col(value).alias("_value"))
    found = ranked(plain, "_of_key", [*by, "_hash"])
    items = F.transform(F.sort_array(F.collect_list(F.struct("_rank", "_value"))), lambda x: x["_value"])
    out = found.groupBy("_of_key", F.floor(F.col("_rank") / per_block).cast("bigint").alias("block")).agg(F.first("_all").alias("total"), items.alias("items"))
    return out.select(F.col("_of_key").alias(key), "block", F.ceil(F.col("total") / per_block).cast("bigint").alias("blocks"), "total", "items")
