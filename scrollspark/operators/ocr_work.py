"""Page-level OCR work: planning, folding page results, finishing a paper."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import Future

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrollspark.operators.blocks import PER_BLOCK, list_blocks


def target_pages(requested: Column, total: Column) -> Column:
    """Pages to process: as many as asked for (0 or null: all), never more than there are."""
    return F.least(F.coalesce(F.nullif(requested, F.lit(0)), total), total)


def needed_pages(processed: Column, target: Column) -> Column:
    """Ascending 0-based pages below target that are not among the processed ones."""
    every = F.when(target > 0, F.sequence(F.lit(0), (target - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.array_sort(F.array_except(every, F.coalesce(processed, F.array().cast("array<int>"))))


def page_plan(work: DataFrame, key: str, per_run: int | None = 100, per_batch: int = 8) -> DataFrame:
    """work: key, target, processed (array of pages).  One row per page to do now: key, page, batch, is_partial."""
    need = work.select(key, needed_pages(F.col("processed"), F.col("target")).alias("_need"))
    cut = F.slice("_need", 1, per_run) if per_run else F.col("_need")
    partial = F.size("_need") > per_run if per_run else F.lit(False)
    pages = need.select(key, partial.alias("is_partial"), F.posexplode(cut).alias("_pos", "page"))
    return pages.select(key, "page", F.floor(F.col("_pos") / per_batch).cast("bigint").alias("batch"), "is_partial")


def last_results(results: DataFrame, key: str, order: str) -> DataFrame:
    """One result of each (key, page_index): the last.  An aggregate, so that repeats are combined before the shuffle."""
    last = results.groupBy(key, "page_index").agg(F.max_by(F.struct("*"), order).alias("_row"))
    return last.select("_row.*")


def build_results(pages: DataFrame, key: str, page: str = "page_index", result: str = "result") -> DataFrame:
    """key, results (in page order), processed_pages.  A paper's pages are bounded by its length."""
    folded = pages.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(page).alias("p"), F.col(result).alias("r")))).alias("_all"))
    return folded.select(key, F.transform("_all", lambda x: x["r"]).alias("results"), F.size("_all").cast("bigint").alias("processed_pages"))


def result_blocks(pages: DataFrame, key: str, page: str = "page_index", result: str = "result", per_block: int = PER_BLOCK) -> DataFrame:
    """key, block, blocks, processed_pages, results: build_results() for papers of any number of pages, whose results go over several rows."""
    blocks = list_blocks(pages, key, [page], result, per_block)
    return blocks.select(key, "block", "blocks", F.col("total").alias("processed_pages"), F.col("items").alias("results"))


def final_status(processed: Column, errors: Column, target: Column, is_partial: Column) -> Column:
    return F.when(errors > 0, "failed").when((processed >= target) & ~is_partial, "complete").otherwise("partial")


def error_text(errors: Column) -> Column:
    """The first three errors."""
    return F.array_join(F.slice(errors, 1, 3), "; ")


def save_results(papers: DataFrame, done: DataFrame, now: Column, clear_error: bool = False, keep_partial: bool = True) -> DataFrame:
    """done: id, results, completed, error.  Completed papers get flag and time and lose their error.

    keep_partial: an unreadable paper (null results) keeps the results it has.
    """
    from scrollspark.operators import store

    completed = F.coalesce(F.col("s.completed"), F.lit(False))
    kept = F.coalesce(F.col("s.results"), F.col("t.ocr_results")) if keep_partial else F.col("s.results")
    error = F.when(completed, F.lit(None)).when(F.col("s.error").isNotNull(), F.col("s.error")).otherwise(F.lit(None) if clear_error else F.col("t.ocr_error"))
    return store.update_from(papers, done, "id", {
        "ocr_results": kept, "ocr_processed": completed | F.col("t.ocr_processed"),
        "ocr_processed_at": F.when(completed, now).otherwise(F.col("t.ocr_processed_at")), "ocr_error": error,
    })


OcrModel = Callable[[bytes, int], str]
"""From a page's image and number to its text; loaded once for each Python worker."""
BATCH_SECONDS, PAGES_OF_A_WORKER = 600.0, 100


def mock_model(image: bytes | None, page: int) -> str:
    return f"Mock Content {page}"


def queue_size(workers: int, per_batch: int) -> int:
    """Pages that wait at a time: rows of an Arrow batch.  Between 8 and 64."""
    return min(64, max(8, 2 * workers * per_batch))


def device_of(task: int, devices: Sequence[str]) -> str | None:
    """Tasks take the devices in turn."""
    return devices[task % len(devices)] if devices else None


class TimedOut(Exception):
    pass


class Recycled:
    """A model that is loaded again after so many pages, with a limit of time for the pages of a batch.

    A call that outlasts the batch's time counts as failed and its thread is left
    behind with the model it used; the pages after it in the batch fail at once.
    """

    def __init__(self, load: Callable[[], OcrModel], seconds: float | None, pages: int | None, clock: Callable[[], float] = time.monotonic):
        self.load, self.seconds, self.pages, self.clock = load, seconds, pages, clock
        self.model: OcrModel | None = None
        self.used = 0
        self.ends = float("inf")

    def begin(self) -> None:
        """A batch begins."""
        self.ends = float("inf") if self.seconds is None else self.clock() + self.seconds

    def __call__(self, image: bytes, page: int) -> str:
        if self.model is None or self.pages and self.used >= self.pages:
            self.model, self.used = self.load(), 0
        self.used += 1
        if self.seconds is None:
            return self.model(image, page)
        left = self.ends - self.clock()
        answer: Future = Future()
        if left > 0:
            threading.Thread(target=_answer, args=(answer, self.model, image, page), daemon=True).start()
        try:
            return answer.result(max(left, 0))
        except TimeoutError:
            if answer.done():
                raise
            self.model = None
            raise TimedOut(f"batch took more than {self.seconds:g} s") from None


def _answer(answer: Future, model: OcrModel, image: bytes, page: int) -> None:
    try:
        answer.set_result(model(image, page))
    except BaseException as problem:  # goes to the caller
        answer.set_exception(problem)


def recognised(
    pages: DataFrame, key: str, load: Callable[..., OcrModel] = lambda: mock_model, *, seconds: float | None = None, recycle_after: int | None = None, devices: Sequence[str] = ()
) -> DataFrame:
    """pages: key, page, image.  Adds content or error; a page that fails does not stop the others.

    seconds: time of an Arrow batch of pages; recycle_after: pages after which the model is loaded
    again; devices: load gets one of them, in turn by task.
    """
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        device = device_of(TaskContext.get().partitionId(), devices)
        model = Recycled(load if device is None else lambda: load(device), seconds, recycle_after)
        for batch in batches:
            content, error = [], []
            model.begin()
            for image, page in zip(batch["image"], batch["page"], strict=True):
                try:
                    content.append(model(image, page))
                    error.append(None)
                except Exception as problem:  # the page's failure is its result
                    content.append(None)
                    error.append(str(problem))
            yield pd.DataFrame({key: batch[key], "page": batch["page"], "content": content, "error": error})

    return pages.select(key, "page", "image").mapInPandas(run, f"`{key}` {kind}, page int, content string, error string")
