"""Tables kept as files of key ranges: a change, a lookup or a page of rows touches the files of its keys only.

A table is a list of Parquet files, each with the smallest and largest key it holds.  Files
overlap in nothing but such end points, so the files of a key are found by two binary
searches.  Rows are sorted inside a file, and every file has a Bloom filter of its keys.
The list has one line a file and is kept by the driver; keys are strings or integers, and never null.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_FILE = 1_000_000
Key = str | int


@dataclass(frozen=True)
class Part:
    path: str
    low: Key
    high: Key
    rows: int


def _array(keys: Iterable[Key]) -> np.ndarray:
    keys = list(keys)
    return np.array(keys, np.int64 if keys and isinstance(keys[0], int) else object)


def _covering(lows: np.ndarray, highs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last part whose range holds each key; the part before it, or the first one, if it is in none."""
    first, last = np.searchsorted(highs, keys, "left"), np.searchsorted(lows, keys, "right") - 1
    alone = first > last
    last = np.where(alone, np.maximum(last, 0), last)
    return np.where(alone, last, first), last


@dataclass(frozen=True)
class Ranged:
    spark: SparkSession
    schema: T.StructType
    key: str
    also: tuple[str, ...]  # further columns of the order, for keys of many rows
    parts: tuple[Part, ...]
    rows_per_file: int = ROWS_PER_FILE

    # Reading

    def of(self, numbers: Iterable[int]) -> DataFrame:
        paths = [self.parts[i].path for i in sorted(numbers)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self.of(range(len(self.parts)))

    def count(self) -> int:
        return sum(p.rows for p in self.parts)

    def _fences(self) -> tuple[np.ndarray, np.ndarray]:
        return _array(p.low for p in self.parts), _array(p.high for p in self.parts)

    def touched(self, keys: DataFrame) -> list[int]:
        """Numbers of the parts that hold one of the keys, or would have to; a task sends each number once."""
        if len(self.parts) < 2:
            return list(range(len(self.parts)))
        lows, highs = self._fences()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                pairs = np.unique(np.stack(_covering(lows, highs, _array(batch.column(0).drop_null().to_pylist())), axis=1), axis=0) if batch.num_rows else []
                new = {i for a, b in pairs for i in range(a, b + 1)} - seen
                seen |= new
                yield pa.RecordBatch.from_arrays([pa.array(sorted(new), pa.int32())], ["part"])

        found = keys.select(F.col(self.key).cast(self.schema[self.key].dataType)).where(F.col(self.key).isNotNull())
        return sorted(r["part"] for r in found.mapInArrow(run, "part int").distinct().collect())

    def number_of(self, key: Column) -> Column:
        """Number of the part that holds a key, or would have to; of several, the first."""
        lows, highs = self._fences()

        @F.arrow_udf("int")
        def number(keys: pa.Array) -> pa.Array:
            return pa.array(_covering(lows, highs, _array(keys.to_pylist()))[0], pa.int32())

        return number(key)

    def near(self, keys: DataFrame) -> DataFrame:
        """The rows of all files that hold one of the keys."""
        return self.of(self.touched(keys))

    def lookup(self, keys: Iterable[Key]) -> DataFrame:
        """The rows of a few keys: of their files only, and in these by row-group statistics and Bloom filters."""
        keys = sorted(set(keys))
        if not keys or not self.parts:
            return self.of([])
        first, last = _covering(*self._fences(), _array(keys))
        return self.of({i for a, b in zip(first.tolist(), last.tolist(), strict=True) for i in range(a, b + 1)}).where(F.col(self.key).isin(keys))

    def page(self, n: int, after: Key | None = None, where: Column | str | None = None) -> DataFrame:
        """The first n rows in the order of keys, of those behind a key; with a condition, more and more files are read until there are n."""
        begin = 0 if after is None else bisect_right([p.high for p in self.parts], after)
        rows, end = 0, begin
        while end < len(self.parts) and rows < n:
            # The first file may have rows up to the key, and a condition drops rows: those are counted below.
            rows += self.parts[end].rows
            end += 1
        while True:
            found = self.of(range(begin, end))
            found = found if after is None else found.where(F.col(self.key) > F.lit(after))
            found = (found if where is None else found.where(where)).orderBy(self.key, *self.also).limit(n)
            if end >= len(self.parts) or (where is None and self._surely(begin, end, after) >= n) or found.count() >= n:
                return found
            end = min(len(self.parts), end + max(1, end - begin))

    def _surely(self, begin: int, end: int, after: Key | None) -> int:
        """Rows that are behind the key by the list of files alone."""
        return sum(p.rows for p in self.parts[begin:end] if after is None or p.low > after)

    # Writing

    def changed(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame], folder: str) -> Ranged:
        """The table after a change of the rows of some keys.

        change: from the rows of all touched files to their new rows; it may add rows of the given keys.
        Files that hold none of the keys stay as they are.
        """
        hit = self.touched(keys)
        return self._rewritten(hit, change(self.of(hit)), folder)

    def compacted(self, folder: str) -> Ranged:
        """The table with runs of files of less than half the rows that a file may have written as one."""
        small = [p.rows * 2 < self.rows_per_file for p in self.parts]
        hit = [i for i in range(len(small)) if small[i] and (small[i - 1 : i] == [True] or small[i + 1 : i + 2] == [True])]
        return self._rewritten(hit, self.of(hit), folder) if hit else self

    def _rewritten(self, hit: list[int], rows: DataFrame, folder: str) -> Ranged:
        out = set(hit)
        kept = tuple(p for i, p in enumerate(self.parts) if i not in out)
        rows = rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema))
        parts = _written(rows, folder, self, [p.low for p in kept])
        table = replace(self, parts=tuple(sorted((*kept, *parts), key=lambda p: (p.low, p.high))))
        for a, b in zip(table.parts, table.parts[1:], strict=False):
            if a.high > b.low:
                raise ValueError(f"rows of keys that were not given: {a} and {b} overlap")
        return table

    # The list of files

    def to_json(self) -> str:
        head = {"schema": self.schema.json(), "key": self.key, "also": self.also, "rows_per_file": self.rows_per_file}
        return "\n".join([json.dumps(head), *(json.dumps(asdict(p)) for p in self.parts)])

    @classmethod
    def from_json(cls, spark: SparkSession, text: str) -> Ranged:
        head, *parts = map(json.loads, text.split("\n"))
        return cls(spark, T.StructType.fromJson(json.loads(head["schema"])), head["key"], tuple(head["also"]), tuple(Part(**p) for p in parts), head["rows_per_file"])


def _written(rows: DataFrame, folder: str, like: Ranged, fences: list[Key], **options: str) -> list[Part]:
    """Writes rows so that no file reaches over a fence; a range of many rows becomes several files."""
    order, bounds = [like.key, *like.also], _array(fences)
    if fences:

        @F.arrow_udf("int")
        def slot(keys: pa.Array) -> pa.Array:
            return pa.array(np.searchsorted(bounds, _array(keys.to_pylist()), "right"), pa.int32())

        rows, order = rows.withColumn("_slot", slot(F.col(like.key))), ["_slot", *order]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = sorted_rows.write.option("maxRecordsPerFile", like.rows_per_file)
    writer = writer.option(f"parquet.bloom.filter.enabled#{like.key}", "true").option(f"parquet.bloom.filter.expected.ndv#{like.key}", like.rows_per_file)
    writer = writer.options(**{name.replace("__", "."): value for name, value in options.items()})
    (writer.partitionBy("_slot") if fences else writer).parquet(folder)
    key = F.col(like.key)
    files = like.spark.read.schema(like.schema).parquet(folder).groupBy(F.col("_metadata.file_path").alias("path"))
    found = files.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows"), F.count(key).alias("known")).collect()  # a row a file
    if any(r["rows"] != r["known"] for r in found):
        raise ValueError(f"rows without {like.key}")
    return [Part(r["path"], r["low"], r["high"], r["rows"]) for r in found]


def ranged(df: DataFrame, folder: str, key: str, also: tuple[str, ...] = (), rows_per_file: int = ROWS_PER_FILE, **options: str) -> Ranged:
    """Writes a table as files of key ranges; options are those of the Parquet writer, with __ for a dot."""
    empty = Ranged(df.sparkSession, df.schema, key, tuple(also), (), rows_per_file)
    return replace(empty, parts=tuple(sorted(_written(df, folder, empty, [], **options), key=lambda p: (p.low, p.high))))
