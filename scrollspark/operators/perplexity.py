"""Sliding-window scoring of token sequences, and statistics of the windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scrollspark.operators.blocks import PER_BLOCK, list_blocks
from scrollspark.session import written

CONTEXT, STRIDE, POWER, WORST = 1024, 512, 2.0, 5
# Upper bounds of the quality bands.
BANDS = ((10, "Very low"), (50, "Low"), (100, "Moderate"), (500, "High"))
LAST_BAND = "Very high"
FREQUENT = 10_000  # a word is frequent from this part of all tokens on


def window_count(n: Column, context: int, stride: int) -> Column:
    more = F.least(F.greatest(F.ceil((n - context) / stride), F.lit(0)) + 1, F.ceil(n / stride))
    return F.when(n <= 1, 0).when(n <= context, 1).otherwise(more).cast("int")


def scored_tokens(n: Column, chunk: Column, size: Column, context: int, stride: int) -> Column:
    """Of a window of some size, in a sequence of n tokens."""
    overlap = context - stride
    later = F.when((size > overlap) & F.lit(overlap > 0), size - overlap).otherwise(size)
    return F.when(n <= context, n).when(chunk == 0, size - 1).otherwise(later)


def windows(sequences: DataFrame, key: str, length: str, context: int = CONTEXT, stride: int = STRIDE) -> DataFrame:
    """key, chunk, begin_loc, end_loc, scored of each window; windows without a scored token are left out.

    The first window scores all but its first token, a later one what lies beyond the
    overlap; a sequence of one window counts its whole length.
    """
    n = F.col(length)
    chunks = sequences.where(n > 1).select(key, n.alias("_n"), F.explode(F.sequence(F.lit(0), window_count(n, context, stride) - 1)).alias("chunk"))
    begin = F.col("chunk") * stride
    out = chunks.withColumn("begin_loc", begin.cast("bigint")).withColumn("end_loc", F.least(begin + context, F.col("_n")).cast("bigint"))
    scored = scored_tokens(F.col("_n"), F.col("chunk"), F.col("end_loc") - F.col("begin_loc"), context, stride)
    return out.select(key, F.col("chunk").cast("bigint").alias("chunk"), "begin_loc", "end_loc", scored.cast("bigint").alias("scored")).where("scored > 0")


def unigram_scores(tokens: DataFrame, key: str, words: str, context: int = CONTEXT, stride: int = STRIDE) -> DataFrame:
    """key, chunk, nll: the mean of -log p over each window's scored tokens, under add-one unigram frequencies.

    A stand-in for a language model.  With stride < context every token but the
    first is scored in exactly one window, so tokens are aggregated, not joined to windows.
    Frequent words, of which there are never more than FREQUENT, are priced where they stand, so that no task
    gets all tokens of one; the others meet their prices in hashed tables of the prices, and no tokens are sorted.
    """
    if stride >= context:
        raise ValueError("windows must overlap")
    spread = tokens.select(key, F.posexplode(words).alias("_i", "_w"))
    counts = written(spread.groupBy("_w").agg(F.count(F.lit(1)).alias("_c")), "word-counts")
    total = counts.agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_v"))
    often = (F.col("_c") * FREQUENT >= F.col("_n")).alias("_often")
    priced = counts.join(F.broadcast(total)).select("_w", (-F.log((F.col("_c") + 1.0) / (F.col("_n") + F.col("_v")))).alias("_nll"), often)  # the total is one row
    chunk = F.when(F.col("_i") < context, 0).otherwise(F.floor((F.col("_i") - context) / stride) + 1)
    frequent = F.broadcast(priced.where("_often").select("_w", F.col("_nll").alias("_known")))
    looked_up = spread.where("_i > 0").select(key, chunk.cast("bigint").alias("chunk"), "_w").join(frequent, "_w", "left")
    rare = looked_up.where("_known IS NULL").drop("_known").join(priced.where("NOT _often").select("_w", "_nll").hint("shuffle_hash"), "_w")
    scored = looked_up.where("_known IS NOT NULL").select(key, "chunk", F.col("_known").alias("_nll")).union(rare.select(key, "chunk", "_nll"))
    return scored.groupBy(key, "chunk").agg(F.avg("_nll").alias("nll"), F.count(F.lit(1)).alias("scored"))


Scorer = Callable[[list[str], int, int], float]
"""Mean negative log-likelihood of tokens[from:to] given those before in the window."""


BatchScorer = Callable[[list[tuple[list[str], int, int]]], Sequence[float]]
"""The same for many windows (tokens, from, to) at once, as models are run."""


def batch_scores(sequences: DataFrame, key: str, words: str, load: Callable[[], BatchScorer], context: int = CONTEXT, stride: int = STRIDE, batch: int = 64) -> DataFrame:
    """key, chunk, nll, scored, by a model that each Python worker loads once and that gets up to batch windows at a time, of whatever sequences.

    Windows are cut by Spark, so that a long sequence is many rows when it comes to Python.  Null and empty sequences, and those of one token, have none.
    """
    n, size = F.size(words), F.size("_tokens")
    cut = F.transform(F.sequence(F.lit(0), window_count(F.col("_n"), context, stride) - 1), lambda c: F.slice(words, c * stride + 1, context))
    rows = sequences.select(F.col(key).alias("_key"), F.col(words), n.alias("_n")).where("_n > 1").select("_key", "_n", F.posexplode(cut).alias("_chunk", "_tokens"))
    chunk = F.col("_chunk").cast("bigint").alias("chunk")
    rows = rows.select("_key", chunk, scored_tokens(F.col("_n"), F.col("_chunk"), size, context, stride).cast("bigint").alias("scored"), "_tokens").where("scored > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = load()
        for found in batches:
            for at in range(0, found.num_rows, batch):
                part = found.slice(at, batch)
                chunks, counts, tokens = (part.column(i).to_pylist() for i in (1, 2, 3))
                nll = score([(t, len(t) - k if c else 1, len(t)) for c, k, t in zip(chunks, counts, tokens, strict=True)])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(nll, pa.float64()), part.column(2)], ["_key", "chunk", "nll", "scored"])

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"_key {kind}, chunk bigint, nll double, scored bigint").withColumnRenamed("_key", key)


def model_scores(sequences: DataFrame, key: str, words: str, load: Callable[[], Scorer], context: int = CONTEXT, stride: int = STRIDE) -> DataFrame:
    """batch_scores() by a model that takes one window at a time."""

    def one_by_one() -> BatchScorer:
        score = load()
        return lambda some: [score(*window) for window in some]

    return batch_scores(sequences, key, words, one_by_one, context, stride)


def plan(n: int, context: int, stride: int) -> Iterator[tuple[int, int, int, int]]:
    """The same windows as windows(), for one sequence."""
    if n <= 1:
        return
    if n <= context:
        yield 0, 0, n, n
        return
    for chunk, begin in enumerate(range(0, n, stride)):
        end = min(begin + context, n)
        size, overlap = end - begin, context - stride
        scored = size - 1 if chunk == 0 else size - overlap if 0 < overlap < size else size
        if scored > 0:
            yield chunk, begin, end, scored
        if end >= n:
            return


def statistics(chunks: DataFrame, key: str, ppl: str = "ppl", scored: str = "scored", power: float = POWER, keys: DataFrame | None = None) -> DataFrame:
    """Weighted mean, exact percentiles, extremes and power mean of the windows' perplexities.

    keys: sequences to report even if they have no window: with infinite values and counts of 0.
    """
    x, n = F.col(ppl), F.col(scored)
    out = chunks.groupBy(key).agg(
        F.exp(F.sum(F.log(x) * n) / F.sum(n)).alias("mean_ppl"), *(F.percentile(x, F.lit(q)).alias(name) for name, q in (("median_ppl", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))),
        F.max(x).alias("max_ppl"), F.min(x).alias("min_ppl"), F.pow(F.avg(F.pow(x, F.lit(power))), F.lit(1 / power)).alias("penalized_ppl"),
        F.count(F.lit(1)).alias("num_chunks"), F.sum(n).alias("total_tokens"),
    )
    if keys is None:
        return out
    full = keys.select(key).join(out, key, "left")
    return full.select(key, *(F.coalesce(c, F.lit(0)) .alias(c) if c in ("num_chunks", "total_tokens") else F.coalesce(F.col(c), F.lit(float("inf"))).alias(c) for c in out.columns if c != key))


PERCENTILES = {"median_ppl": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def exact_percentiles(chunks: DataFrame, key: str, value: str = "ppl", wanted: Mapping[str, float] | None = None) -> DataFrame:
    """key and percentiles with linear interpolation, exact for keys of any number of rows.

    Equal values are counted before they move.  The counts are dealt by ranges of (key, value), so that a large key is shared by
    many tasks, and written; a value's ranks follow from the counts of its key in the parts before, and those inside its part.  Null values do
    not count; a key with null values only has no row.
    """
    wanted = PERCENTILES if wanted is None else wanted
    counted = chunks.where(F.col(value).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(value).alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    parts = written(counted.repartitionByRange("_key", "_x").withColumn("_part", F.spark_partition_id()), "percentiles")
    sizes = parts.groupBy("_key", "_part").agg(F.sum("_n").alias("_here"))  # of a key one row a part, at most
    by_key = Window.partitionBy("_key")
    before = F.sum("_here").over(by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_here")
    sizes = sizes.select("_key", "_part", before.alias("_before"), F.sum("_here").over(by_key).alias("_all"))
    inside = F.sum("_n").over(Window.partitionBy("_key", "_part").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A null key is a key of its own.
    left, right = parts.withColumn("_end", inside).alias("l"), sizes.alias("r")
    ranked = left.join(right, F.col("l._key").eqNullSafe(F.col("r._key")) & (F.col("l._part") == F.col("r._part"))).select(
        F.col("l._key").alias("_key"), "_x", "_all", (F.col("_before") + F.col("_end") - F.col("_n")).alias("_from"), (F.col("_before") + F.col("_end")).alias("_to")
    )
    place = {name: F.lit(q) * (F.col("_all") - 1) for name, q in wanted.items()}
    at = lambda rank: F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_x")))
    ends = [c for name, p in place.items() for c in (at(F.floor(p)).alias(f"_low_{name}"), at(F.ceil(p)).alias(f"_high_{name}"))]
    found = ranked.groupBy("_key").agg(F.first("_all").alias("_all"), *ends)

    def between(name: str) -> Column:
        low, high, p = F.col(f"_low_{name}"), F.col(f"_high_{name}"), place[name]
        return F.when(F.floor(p) == F.ceil(p), low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high).alias(name)

    return found.select(F.col("_key").alias(key), *map(between, wanted))


def chunk_lists(chunks: DataFrame, key: str, chunk: str = "chunk", ppl: str = "ppl") -> DataFrame:
    """key, chunks: a sequence's perplexities in window order.  As long as the sequence has windows."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(chunk).alias("chunk"), F.col(ppl).alias("ppl"))))
    return chunks.groupBy(key).agg(pairs.alias("chunks"))


def chunk_list_blocks(chunks: DataFrame, key: str, chunk: str = "chunk", ppl: str = "ppl", per_block: int = PER_BLOCK) -> DataFrame:
    """key, block, blocks, total, items: chunk_lists() for sequences of any number of windows, whose lists go over several rows; equal windows by perplexity."""
    pair = F.struct(F.col(chunk).alias("chunk"), F.col(ppl).alias("ppl")).alias("pair")
    return list_blocks(chunks.select(F.col(key).alias("key"), pair), "key", ["pair"], "pair", per_block).withColumnRenamed("key", key)


def worst_chunks(chunks: DataFrame, key: str, chunk: str, ppl: str, k: int = WORST) -> DataFrame:
    """key, chunk, rk of the k highest; equal ones in chunk order."""
    w = Window.partitionBy(key).orderBy(F.desc(ppl), chunk)
    return chunks.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k).select(key, chunk, "rk")


def token_range(chunk: Column, total_scored: Column, context: int = CONTEXT, stride: int = STRIDE) -> tuple[Column, Column]:
    """Reported start and end of a window: the end is cut at the number of scored tokens."""
    return chunk * stride, F.least(chunk * stride + context, total_scored)


def band(ppl: Column) -> Column:
    out = None
    for bound, name in BANDS:
        out = F.when(ppl < bound, name) if out is None else out.when(ppl < bound, name)
    return out.otherwise(LAST_BAND)
