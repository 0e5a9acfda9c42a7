"""Mixing sources to target weights by temperature.

Source s with T_s tokens gets the weight T_s**a / sum of T**a.  The exponent a in
[0, 1] is bisected: the largest whose weights still reach a target entropy,
and not below the smallest at which no source is repeated more often than a
limit.  A budget of tokens then gives every source its share: whole passes over its
documents while the share lasts, and the front of one more pass.

Each pass is a block permutation.  Documents are dealt into blocks of about
``block_docs`` by hash; a pass visits the blocks in an order drawn by hash of (seed, pass,
block), and inside a block the documents in an order drawn likewise.  Prefix sums of
tokens are taken over the small table of blocks first, then inside each
block, so that no source, however large, is ordered in one piece.

Exponent and budget need the size of every source.  The driver reads how many sources
have each size: as d different sizes take at least d (d + 1) / 2 tokens, these are at most
the square root of twice the tokens, 1.4 million numbers for 10**12, however many sources.

Edge cases: null sources are one source, kept as null; sources without any token get one
pass; texts that are null or empty have 0 tokens and ride along in their block;
documents whose tokens no longer fit in the last pass end it; rows with equal ids are documents
of their own, in one block; rows without id are dealt one by one, by their place in the table, so they are spread over all blocks; an empty table gives no rows; extra columns are ignored, and pass
through ``mixed``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from scrollspark.llm.tables import written

ROUNDS = 60
SHELF_BITS = 10


def words(text: Column) -> Column:
    """Tokens of a text: its words between ASCII white space."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _columns(sizes: Sequence[tuple[float, int]]) -> np.ndarray:
    return np.asarray(sizes, np.float64).T


def _scale(sizes: Sequence[tuple[float, int]], a: float) -> float:
    """Sum of the weights with exponent a, where the largest source has 1."""
    size, k = _columns(sizes)
    return float((k * np.exp(a * np.log(size / size.max()))).sum())


def entropy(sizes: Sequence[tuple[float, int]], a: float) -> float:
    """Of the weights with exponent a; sizes: tokens, and how many sources have so many."""
    size, k = _columns(sizes)
    power = np.exp(a * np.log(size / size.max()))
    share = power / (k * power).sum()
    return -float((k * share * np.log(share)).sum())


def repeats(sizes: Sequence[tuple[float, int]], a: float, budget: float | None) -> float:
    """Passes over the smallest source; without a budget, when the largest source gets one."""
    size, k = _columns(sizes)
    least, top = float(size.min()), float(size.max())
    if budget is None:
        return (top / least) ** (1 - a)
    total = _scale(sizes, a)
    return budget * math.exp(a * math.log(least / top)) / total / least


def exponent(sizes: Sequence[tuple[float, int]], target_entropy: float, max_repeats: float, budget: float | None) -> float:
    """The largest exponent in [0, 1] of at least the target share of the greatest entropy, raised until the limit of repeats holds."""
    sizes = np.array([(s, k) for s, k in sizes if s > 0])
    if not len(sizes):
        return 1.0
    goal = target_entropy * math.log(_columns(sizes)[1].sum())

    def bisected(low_side) -> tuple[float, float]:
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            middle = (low + high) / 2
            low, high = (middle, high) if low_side(middle) else (low, middle)
        return low, high

    warm = 1.0 if entropy(sizes, 1.0) >= goal else bisected(lambda a: entropy(sizes, a) >= goal)[0]
    if repeats(sizes, warm, budget) <= max_repeats:
        return warm
    return 1.0 if repeats(sizes, 1.0, budget) > max_repeats else max(warm, bisected(lambda a: repeats(sizes, a, budget) > max_repeats)[1])


def _sizes(totals: DataFrame) -> list[tuple[float, int]]:
    """Every size of a source with tokens, and how many sources have it."""
    rows = totals.where("total > 0").groupBy("total").agg(F.count(F.lit(1)).alias("k")).collect()
    return sorted((float(r["total"]), r["k"]) for r in rows)


def _before(column: str, order: WindowSpec) -> Column:
    """The sum of the rows before each."""
    return F.coalesce(F.sum(column).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def mixture(
    docs: DataFrame, *, target_entropy: float = 0.95, max_repeats: float = 4.0, budget: int | None = None, whole: bool = False, seed: int = 1, block_docs: int = 4096,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """One row per document and pass in the mixture: id, source, pass, block, token_at, n_tokens.

    token_at: tokens of the source's stream before the document.
    budget: tokens of the mixture; by default as many as the documents have.
    whole: instead of a budget, the largest source gets exactly one pass, so that every document is in the mixture.
    """
    key = F.when(F.col(source_col).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source_col).cast("string")))
    own = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()).alias("_own")  # hashes pass over nulls: it counts for rows without id only
    base = written(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), key.alias("_key"), words(F.col(text_col)).alias("n_tokens"), own), "mixing-tokens")
    totals = written(base.groupBy("_key").agg(F.sum("n_tokens").alias("total"), F.count(F.lit(1)).alias("docs")), "mixing-sources")
    sizes = _sizes(totals)
    every = sum(s * k for s, k in sizes)
    tokens = None if whole else float(budget if budget is not None else every)
    a = exponent(sizes, target_entropy, max_repeats, tokens)
    if sizes:
        top = max(s for s, _ in sizes)
        scale = _scale(sizes, a)
        tokens = top * scale if tokens is None else tokens
        share = F.lit(tokens / scale) * F.exp(F.lit(a) * F.log(F.col("total") / F.lit(top)))
    else:
        share = F.lit(0.0)
    passes = F.when(F.col("total") > 0, share / F.col("total")).otherwise(1.0)
    passes = F.when(F.abs(passes - F.round(passes)) < 1e-9, F.round(passes)).otherwise(passes)
    passes = F.greatest(passes, F.lit(1.0)) if whole else passes
    plan = totals.withColumn("passes", passes).withColumn("full", F.floor("passes").cast("int")).withColumn("rest", F.floor((F.col("passes") - F.col("full")) * F.col("total")).cast("bigint"))
    plan = plan.withColumn("blocks", F.ceil(F.col("docs") / block_docs)).withColumn("last", F.when(F.col("rest") > 0, F.col("full")).otherwise(F.col("full") - 1))
    plan = written(plan.where("last >= 0").select("_key", "full", "rest", "blocks", "last"), "mixing-plan")

    dealt = base.join(plan.select("_key", "blocks"), "_key").withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "_id", "_own"), F.col("blocks")).cast("int")).drop("blocks")
    sums = dealt.groupBy("_key", "block").agg(F.sum("n_tokens").alias("in_block"))
    turns = sums.join(plan, "_key").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("last"))))
    turns = turns.withColumn("drawn", F.xxhash64(F.lit(seed + 1), "pass", "block")).withColumn("shelf", F.shiftright("drawn", 64 - SHELF_BITS))
    shelves = turns.groupBy("_key", "pass", "shelf").agg(F.sum("in_block").alias("in_shelf"))
    shelves = shelves.select("_key", "pass", "shelf", _before("in_shelf", Window.partitionBy("_key", "pass").orderBy("shelf")).alias("shelf_at"))
    turns = turns.join(shelves, ["_key", "pass", "shelf"])
    order = Window.partitionBy("_key", "pass", "shelf").orderBy("drawn", "block")
    turns = turns.withColumn("block_at", F.col("shelf_at") + _before("in_block", order)).where((F.col("pass") < F.col("full")) | (F.col("block_at") <= F.col("rest")))
    turns = written(turns.select("_key", "block", "pass", "block_at", F.when(F.col("pass") < F.col("full"), F.lit(None)).otherwise(F.col("rest")).cast("bigint").alias("rest")), "mixing-blocks")

    placed = dealt.join(turns, ["_key", "block"])
    inside = Window.partitionBy("_key", "block", "pass").orderBy(F.xxhash64(F.lit(seed + 2), "pass", "_id", "_own"), "_id", "n_tokens")
    placed = placed.withColumn("in_pass", F.col("block_at") + _before("n_tokens", inside)).where(F.col("rest").isNull() | (F.col("in_pass") + F.col("n_tokens") <= F.col("rest")))
    lengths = totals.select("_key", "total")
    out = placed.join(lengths, "_key")
    return out.select(
        F.col("_id").alias(id_col), F.col("_source").alias(source_col), F.col("pass").cast("int").alias("pass"), "block",
        (F.col("pass") * F.col("total") + F.col("in_pass")).cast("bigint").alias("token_at"), "n_tokens",
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents of the mixture with all their columns: a document in k passes is there k times.

    Rows that share an id are taken together: each is there as often as the id was drawn for one of them.
    """
    drawn = mixture(docs, id_col=id_col, **options).groupBy(F.col(id_col).alias("_drawn")).agg((F.max("pass") + 1).alias("_times"), F.min("pass").alias("_first"))
    drawn = written(drawn, "mixing-drawn")
    row = docs.select(F.struct("*").alias("_row"))
    ident = F.col(f"_row.`{id_col}`")
    joined = row.join(drawn.hint("merge"), ident.eqNullSafe(F.col("_drawn")))
    return joined.withColumn("_pass", F.explode(F.sequence(F.col("_first"), F.col("_times") - 1))).select("_row.*")
