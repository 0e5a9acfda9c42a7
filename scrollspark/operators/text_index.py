"""A full-text index that is kept: segments of posting blocks, added to batch by batch and merged.

A segment holds the texts of one batch: their keys by number, and for each term and each block of
65,536 numbers the offsets and counts of the texts that have it.  Blocks bound every
list, so a term of all texts is many rows.  Postings are files of term ranges (ranges.py),
so that a search opens the files of its terms; their offsets are stored with Parquet's delta encoding.

A text that comes again replaces the earlier one: of a key, only the newest segment counts; a null text takes it out.
Every change is one publication of the store.  Edge cases: null columns count as empty; rows that share a key in one batch are
texts of their own, and a key is found once; rows without key are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrollspark.functions.stemming import stem_of
from scrollspark.operators import ranges, search
from scrollspark.operators.store import SnapshotStore
from scrollspark.session import arrow_rows

BLOCK_BITS = 16
TEXTS, WORDS = 500, 250_000  # of a batch, and of what is counted at a time: a Python worker holds no more, however many texts its task has
SEGMENTS = 8  # so many are searched one by one; one more, and they are merged


class TextIndex:
    def __init__(self, shop: SnapshotStore, name: str, key: str, columns: Sequence[str], stem: Callable[[str], str] = stem_of, stops: Sequence[str] = search.STOP_WORDS, rows_per_file: int = ranges.ROWS_PER_FILE):
        self.shop, self.name, self.key, self.columns = shop, name, key, list(columns)
        self.stem, self.stops, self.rows_per_file = stem, list(stops), rows_per_file

    def segments(self) -> list[str]:
        """From the oldest to the newest."""
        head = f"{self.name}_keys_"
        return [t.removeprefix(head) for t in self.shop.tables() if t.startswith(head)]

    def _keys(self, segment: str) -> DataFrame:
        return self.shop.read(f"{self.name}_keys_{segment}")

    def _postings(self, segment: str) -> ranges.Ranged:
        return self.shop.ranged(f"{self.name}_postings_{segment}", "term")

    def _next(self) -> str:
        have = self.segments()
        return f"{int(have[-1]) + 1 if have else 0:08d}"

    def terms(self, text: Column) -> Column:
        """Words of a text, without stop words, not yet stems."""
        words = F.split(F.lower(text), search.SEPARATORS)
        return F.filter(words, lambda w: (w != "") & ~w.isin(self.stops))

    # Writing

    def _staged(self, rows: DataFrame) -> DataFrame:
        path = self.shop.folder(f"{self.name}_staged")
        with arrow_rows(self.shop.spark, TEXTS):
            rows.write.parquet(path)
        return self.shop.spark.read.schema(rows.schema).parquet(path)

    def _segment(self, keys: DataFrame, postings: DataFrame, *drop: str) -> None:
        """keys: number, key.  postings: term, number, tf, once each."""
        offset = F.col("number").bitwiseAND((1 << BLOCK_BITS) - 1)
        packed = F.shiftleft(offset, 32).bitwiseOR(F.col("tf").cast("bigint"))  # one number for a text, so that lists are short; 2**16 of them at most
        lists = postings.groupBy("term", F.shiftright("number", BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list(packed)).alias("p"))
        part = lambda f: F.transform("p", lambda x: f(x).cast("int"))
        blocks = lists.select("term", "block", part(lambda x: F.shiftright(x, 32)).alias("offsets"), part(lambda x: x.bitwiseAND((1 << 32) - 1)).alias("tfs"))
        name, number = self.name, self._next()
        written = ranges.ranged(blocks, self.shop.folder(f"{name}_postings_{number}"), "term", ("block",), self.rows_per_file, parquet__writer__version="PARQUET_2_0")
        self.shop.publish(*drop, **{f"{name}_keys_{number}": keys.select("number", "key"), f"{name}_postings_{number}": written})

    def add(self, texts: DataFrame) -> None:
        """A new segment of these texts; segments are merged where they have become many."""
        text = F.concat_ws(" ", *(F.col(c).cast("string") for c in self.columns))
        counts = counted_stems(self.terms(text), self.stem).alias("terms")
        rows = self._staged(texts.where(F.col(self.key).isNotNull()).select(F.monotonically_increasing_id().alias("number"), F.col(self.key).alias("key"), counts))
        self._segment(rows, rows.select("number", F.explode("terms").alias("t")).select("t.term", "number", "t.tf"))
        if len(self.segments()) > SEGMENTS:
            self.merge()

    def merge(self) -> None:
        """All segments as one, without the texts that newer ones have replaced."""
        old = self.segments()
        if len(old) < 2:
            return
        live = reduce(DataFrame.union, (self._live(s).withColumn("segment", F.lit(s)) for s in old))
        live = self._staged(live.select("segment", F.col("number").alias("_number"), "key", F.monotonically_increasing_id().alias("_new")))
        every = reduce(DataFrame.union, (_exploded(self._postings(s).read()).withColumn("segment", F.lit(s)) for s in old))
        postings = every.join(live.withColumnRenamed("segment", "_segment"), (F.col("segment") == F.col("_segment")) & (F.col("number") == F.col("_number")))
        gone = [f"{self.name}_{kind}_{s}" for s in old for kind in ("keys", "postings")]
        self._segment(live.select(F.col("_new").alias("number"), "key"), postings.select("term", F.col("_new").alias("number"), "tf"), *gone)

    # Reading

    def _live(self, segment: str) -> DataFrame:
        """Numbers and keys of a segment that no newer one has."""
        keys = self._keys(segment)
        for newer in (s for s in self.segments() if s > segment):
            keys = keys.join(self._keys(newer).select("key"), "key", "left_anti")
        return keys.select("number", "key")

    def postings(self) -> DataFrame:
        """term, key, tf of all texts."""
        parts = [_exploded(self._postings(s).read()).join(self._live(s), "number") for s in self.segments()]
        return reduce(DataFrame.union, parts).select("term", F.col("key").alias(self.key), "tf")

    def wanted(self, terms: Sequence[str]) -> list[str]:
        """Stems of what is asked for, without stop words."""
        return sorted({self.stem(t) for t in {t.lower() for t in terms} - set(self.stops)})

    def files_of(self, terms: Sequence[str]) -> list[str]:
        """The posting files that a search for these terms opens."""
        return [f for s in self.segments() for f in self._postings(s).lookup(self.wanted(terms)).inputFiles()]

    def search(self, terms: Sequence[str]) -> DataFrame:
        """Keys of the texts that have all terms; none, if nothing but stop words is asked for."""
        wanted = self.wanted(terms)
        parts = []
        for segment in self.segments():
            found = self._postings(segment).lookup(wanted)
            # Blocks that lack a term go before any list is unfolded.
            whole = found.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(wanted)).select("block")
            hits = _exploded(found.join(whole, "block", "left_semi")).groupBy("number").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(wanted))
            parts.append(hits.join(self._live(segment), "number").select(F.col("key").alias(self.key)))
        return reduce(DataFrame.union, parts).distinct()


def counted_stems(words: Column, stem: Callable[[str], str]) -> Column:
    """Of each list of words its distinct stems (term) and how often each is there (tf)."""

    def counted(lists: pa.Array, sizes: np.ndarray) -> pa.Array:
        coded = pc.fill_null(pc.list_flatten(lists), "").dictionary_encode()
        stems = pa.array([stem(t) for t in coded.dictionary.to_pylist()], pa.string()).dictionary_encode()
        n = max(1, len(stems.dictionary))
        term = stems.indices.to_numpy()[coded.indices.to_numpy()].astype(np.int64)
        pairs, tf = np.unique(np.repeat(np.arange(len(lists)), sizes) * n + term, return_counts=True)
        cut = np.searchsorted(pairs // n, np.arange(len(lists) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays([stems.dictionary.take(pa.array(pairs % n)), pa.array(tf.astype(np.int32))], ["term", "tf"]))

    @F.arrow_udf("array<struct<term: string, tf: int>>")
    def counts(lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        # Rows whose words begin in the same stretch of WORDS are counted together.
        begin = (np.cumsum(sizes, dtype=np.int64) - sizes) // WORDS
        edges = [0, *(np.flatnonzero(np.diff(begin)) + 1).tolist(), len(lists)]
        out = pa.concat_arrays([counted(lists.slice(a, b - a), sizes[a:b]) for a, b in zip(edges, edges[1:], strict=False)])
        pa.default_memory_pool().release_unused()
        return out

    return counts(words)


def _exploded(blocks: DataFrame) -> DataFrame:
    """term, number, tf of posting blocks."""
    each = blocks.select("term", "block", F.explode(F.arrays_zip("offsets", "tfs")).alias("p"))
    return each.select("term", (F.shiftleft("block", BLOCK_BITS) + F.col("p.offsets")).alias("number"), F.col("p.tfs").cast("bigint").alias("tf"))
