"""Download and OCR status: counts, reconciliation, candidates, paging, outcomes.

Papers here have id, has_content (or pdf_content), pdf_downloaded, pdf_download_error,
ocr_processed, ocr_error, has_ocr and categories.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrollspark.functions import parsing
from scrollspark.operators import store


def counts(papers: DataFrame) -> DataFrame:
    """The ten progress counts, in one pass."""
    error = F.col("pdf_download_error").isNotNull()
    return papers.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("has_content").alias("with_pdfs"), F.count_if(~F.col("has_content")).alias("need_pdfs"), F.count_if(error).alias("failed"),
        F.count_if("ocr_processed").alias("ocr_done"), F.count_if("has_ocr").alias("with_ocr"), F.count_if(F.col("ocr_error").isNotNull()).alias("ocr_failed"),
    )


def reconcile_counts(papers: DataFrame) -> DataFrame:
    return papers.agg(F.count_if(F.col("has_content") & ~F.col("pdf_downloaded")).alias("need_true"), F.count_if(~F.col("has_content") & F.col("pdf_downloaded")).alias("need_false"))


def reconciled(papers: DataFrame) -> DataFrame:
    """The flag follows the content; null flags count as neither and stay."""
    flag = F.col("pdf_downloaded")
    return papers.withColumn("pdf_downloaded", F.when(F.col("has_content") & (flag == F.lit(False)), True).when(~F.col("has_content") & flag, False).otherwise(flag))


def page(rows: DataFrame, order: str = "id", limit: int | None = None, offset: int | None = None) -> DataFrame:
    out = rows.orderBy(order)
    out = out.offset(offset) if offset else out
    return out.limit(limit) if limit else out


def keyset_page(rows: DataFrame, after: str, limit: int, order: str = "id") -> DataFrame:
    return rows.where(F.col(order) > after).orderBy(order).limit(limit)


def needing_pdf(papers: DataFrame, limit: int | None = None) -> DataFrame:
    return page(papers.where(~F.col("has_content")).select("id"), limit=limit)


def is_false(flag: Column) -> Column:
    return F.coalesce(~flag, F.lit(False))


def download_candidates(papers: DataFrame, limit: int | None = 100, categories: Sequence[str] = (), include_errors: bool = False) -> DataFrame:
    """Not downloaded, by default without an error, in any of the categories.

    A category is a part of the text, upper and lower case alike; % and _ in it are wildcards.
    """
    wanted = is_false(F.col("pdf_downloaded"))
    if not include_errors:
        wanted &= F.col("pdf_download_error").isNull()
    if categories:
        wanted &= reduce(lambda a, b: a | b, (F.col("categories").ilike(f"%{c}%") for c in categories))
    return page(papers.where(wanted).select("id"), limit=limit)


def ocr_candidates(papers: DataFrame, limit: int | None = 10, offset: int = 0, retry_errors: bool = False) -> DataFrame:
    wanted = F.col("has_content") & is_false(F.col("ocr_processed"))
    if not retry_errors:
        wanted &= F.col("ocr_error").isNull()
    return page(papers.where(wanted).select("id"), limit=limit, offset=offset)


def available(papers: DataFrame, limit: int | None = 20, title: str = "title", processed_only: bool = False) -> DataFrame:
    wanted = F.col("has_ocr") & (F.col("ocr_processed") if processed_only else F.lit(True))
    return page(papers.where(wanted).select("id", parsing.prefix(F.col(title), 60).alias("title"), "ocr_processed"), limit=limit)


def file_sync(papers: DataFrame, files: DataFrame) -> DataFrame:
    """id, pdf_downloaded as the listing says, and whether that changes the flag (a null flag changes)."""
    seen = files.select("id").distinct().withColumn("_there", F.lit(True))
    both = papers.select("id", F.col("pdf_downloaded").alias("_flag")).join(seen, "id", "left")
    there = F.coalesce("_there", F.lit(False))
    return both.select("id", there.alias("pdf_downloaded"), (~there.eqNullSafe(F.col("_flag"))).alias("changed"))


def store_outcomes(papers: DataFrame, outcomes: DataFrame, now: Column, clears_flag: bool = False) -> DataFrame:
    """outcomes: id, error (null: success), content.  A failure keeps the flag, or clears it where clears_flag is set."""
    good = F.col("s.error").isNull()
    flag = F.when(good, True).otherwise(F.lit(False) if clears_flag else F.col("t.pdf_downloaded"))
    values = {"pdf_downloaded": flag, "pdf_download_error": F.col("s.error"), "pdf_download_attempted_at": now}
    if "pdf_content" in papers.columns:
        values["pdf_content"] = F.when(good, F.col("s.content")).otherwise(F.col("t.pdf_content"))
    return store.update_from(papers, outcomes, "id", values)


def store_files(papers: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """files: id, content.  Papers with content and flag set (errors stay as they are), and files without a paper."""
    values = {"pdf_content": F.col("s.content"), "pdf_downloaded": F.lit(True)}
    return store.update_from(papers, files, "id", values), files.join(papers.select("id"), "id", "left_anti")


def matched_files(files: DataFrame, papers: DataFrame, on: Column) -> DataFrame:
    """Each file with whether a paper has its id."""
    return files.join(papers, on, "left")


def run_summary(outcomes: DataFrame, good: Column, size: Column) -> DataFrame:
    return outcomes.agg(F.count_if(good).alias("success"), F.count_if(~good).alias("errors"), F.sum(size).alias("total_bytes"))


def throughput(progress: DataFrame, when: str, done: Column | None = None) -> DataFrame:
    """Records, seconds between the first and the last, and records a second (null where no time has passed)."""
    seconds = (F.unix_micros(F.max(F.col(when).cast("timestamp"))) - F.unix_micros(F.min(F.col(when).cast("timestamp")))) / 1e6
    counted = progress.agg((F.count(F.lit(1)) if done is None else F.count_if(done)).alias("records"), seconds.alias("seconds"))
    return counted.withColumn("rate", F.col("records") / F.nullif("seconds", F.lit(0.0)))
