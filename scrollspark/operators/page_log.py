"""State of page work: waves of pages, whose results are kept after each wave.

A run over many pages is cut into waves.  A wave's results are appended to a log and published
before the next begins, so that a run that is broken off loses one wave at most.  The log is
folded into a table of key ranges, of which only the touched files are rewritten.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrollspark.operators.ranges import ROWS_PER_FILE, Ranged
from scrollspark.operators.store import Appended, SnapshotStore

WAVE_PAGES = 100_000
FOLD_AFTER = 64


def _slices(first: dict[int, int], wave_pages: int) -> Iterator[tuple[int, int, int]]:
    """first: pages of the first batches in each part.  Runs of parts (from, to) with about a wave's pages, and in how many a part with more is split."""
    begin, end, pages = None, None, 0
    for part in sorted(first):
        if begin is not None and pages + first[part] > wave_pages:
            yield begin, end, 1
            begin, pages = None, 0
        if first[part] > wave_pages:
            yield part, part, -(-first[part] // wave_pages)
            continue
        begin, end, pages = part if begin is None else begin, part, pages + first[part]
    if begin is not None:
        yield begin, end, 1


def waves(plan: DataFrame, papers: Ranged, folder: str, wave_pages: int = WAVE_PAGES) -> Iterator[DataFrame]:
    """plan: key, page, batch (ocr_work.page_plan).  Waves of its rows, of about wave_pages rows each.

    Papers of one file, or of files next to each other, come together, so that a wave reads few files; their
    batches come in order, several in one wave where they are small.  A batch is never divided.
    The plan is written to the folder once.  The driver sees one count for each file and batch.
    """
    key = papers.key
    plan.withColumn("_part", papers.number_of(F.col(key))).repartition("_part", "batch").write.partitionBy("_part").parquet(folder)
    kept = papers.spark.read.schema(f"`{key}` {papers.schema[key].dataType.simpleString()}, page int, batch bigint, _part int").parquet(folder)
    counts: dict[int, dict[int, int]] = {}
    for row in kept.groupBy("_part", "batch").count().collect():  # a row for each file and batch
        counts.setdefault(row["_part"], {})[row["batch"]] = row["count"]
    for begin, end, split in _slices({part: found.get(0, 0) for part, found in counts.items()}, wave_pages):
        inside = kept.where(F.col("_part").between(begin, end))
        sizes: dict[int, int] = {}
        for part in counts.keys() & range(begin, end + 1):
            for batch, n in counts[part].items():
                sizes[batch] = sizes.get(batch, 0) + -(-n // split)
        for turn in range(split):
            mine = inside if split == 1 else inside.where(F.pmod(F.xxhash64(key), F.lit(split)) == turn)
            low, pages = 0, 0
            for batch in range(max(sizes) + 1):
                if pages and pages + sizes.get(batch, 0) > wave_pages:
                    yield mine.where(F.col("batch").between(low, batch - 1)).select(key, "page")
                    low, pages = batch, 0
                pages += sizes.get(batch, 0)
            yield mine.where(F.col("batch") >= low).select(key, "page")


class PageLog:
    """Results of pages in a store: a table of key ranges, and a log of what has come since it was last folded.

    Both hold key, page, content and error; the log also the run.  A page is settled by a result without
    error.  Errors belong to their run: they are kept until the run has ended, and such pages are wanted again.
    """

    def __init__(self, shop: SnapshotStore, name: str = "ocr_pages", key: str = "id", kind: str = "string", rows_per_file: int = ROWS_PER_FILE):
        self.shop, self.name, self.key = shop, name, key
        self.columns = f"`{key}` {kind}, page int, content string, error string"
        self.rows_per_file = rows_per_file

    def _base(self) -> Ranged:
        if self.name in self.shop.tables():
            return self.shop.ranged(self.name, self.key, ("page",), self.rows_per_file)
        return Ranged(self.shop.spark, self.shop.spark.createDataFrame([], self.columns).schema, self.key, ("page",), (), self.rows_per_file)

    def _log(self) -> Appended:
        return self.shop.appended(f"{self.name}_log", f"{self.columns}, run string")

    def good(self, keys: DataFrame | None = None) -> DataFrame:
        """key, page, content of settled pages, of some keys or of all; a page with several results has the smallest."""
        base = self._base()
        both = (base.read() if keys is None else base.near(keys)).unionByName(self._log().read().drop("run")).where("error IS NULL")
        both = both if keys is None else both.join(keys.select(self.key), self.key, "left_semi")
        return both.groupBy(self.key, "page").agg(F.min("content").alias("content"))

    def processed(self, keys: DataFrame) -> DataFrame:
        """key, processed: the settled pages of each paper."""
        return self.good(keys).groupBy(self.key).agg(F.collect_set("page").alias("processed"))

    def errors(self, run: str) -> DataFrame:
        """key, page, error of a run's failed pages."""
        return self._log().read().where((F.col("run") == run) & F.col("error").isNotNull()).select(self.key, "page", "error")

    def append(self, results: DataFrame, run: str, fold_after: int = FOLD_AFTER) -> None:
        """Publishes results of a wave: key, page, content, error.  A long log is folded first."""
        log = self._log()
        if len(log.folders) >= fold_after:
            self.shop.publish(**self.folded(run))
            log = self._log()
        self.shop.publish(**{f"{self.name}_log": log.with_rows(results.withColumn("run", F.lit(run)), self.shop.folder(f"{self.name}_log"))})

    def folded(self, keep_errors_of: str | None = None) -> dict[str, Ranged | Appended]:
        """New versions of both tables, to be published together: settled pages move from the log to the files of their keys."""
        base, log = self._base(), self._log()
        fresh = log.read().where("error IS NULL").select(self.key, "page", "content", "error")
        value: Column = F.min("content").alias("content")
        merged = lambda near: near.where("error IS NULL").unionByName(fresh).groupBy(self.key, "page").agg(value).withColumn("error", F.lit(None).cast("string"))
        empty = replace(log, folders=())
        if keep_errors_of is not None:
            empty = empty.with_rows(log.read().where((F.col("run") == keep_errors_of) & F.col("error").isNotNull()), self.shop.folder(f"{self.name}_log"))
        return {self.name: base.changed(fresh, merged, self.shop.folder(self.name)), f"{self.name}_log": empty}
