"""End-to-end runs over a snapshot store: metadata and downloads, OCR, perplexity reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrollspark.functions import ocr_document, parsing
from scrollspark.operators import ingest, ocr_work, page_log, perplexity, schema, status, store
from scrollspark.operators.store import SnapshotStore
from scrollspark.session import written
from scrollspark.sources import fetch


def initialised(shop: SnapshotStore) -> SnapshotStore:
    """A store with the three tables, empty where they are missing."""
    spark, have = shop.spark, set(shop.tables())
    empty = {"papers": schema.papers_ddl(), "categories": schema.CATEGORIES, "links": schema.LINKS}
    if new := {name: spark.createDataFrame([], kind) for name, kind in empty.items() if name not in have}:
        shop.publish(**new)
    return shop


def flagged(papers: DataFrame) -> DataFrame:
    """Papers with has_content and has_ocr, as the status operators want them."""
    return papers.withColumn("has_content", F.col("pdf_content").isNotNull()).withColumn("has_ocr", F.col("ocr_results").isNotNull())


def process(shop: SnapshotStore, lines: DataFrame | Iterable[DataFrame] | None, url_base: str, fetcher: Callable[[], fetch.Fetcher] | None, *, limit: int | None = None, resume: bool = True, now: Column | None = None, workers: int = 4, delay: float = fetch.DELAY, tries: str | None = None, **options) -> dict[str, int]:
    """Loads metadata (unless lines is None), downloads what is wanted (unless fetcher is None), and reconciles flags.

    lines: (value, ordinal), or waves of them (ingest.waves), each published by itself; waves end with the limit.
    After loading, the papers of this run are downloaded; without loading, all that lack content.
    tries: folder of finished downloads; a run that is given an earlier one's folder goes on where that ended.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    shop.begin()
    initialised(shop)
    counts = {"accepted": 0, "skipped": 0, "downloaded": 0, "failed": 0}
    if lines is not None:
        parts, left = [], limit
        for wave in [lines] if isinstance(lines, DataFrame) else lines:
            batch = ingest.load_into(shop, wave, limit=left, resume=resume, now=now)
            shop.publish(papers=batch.papers, categories=batch.categories, links=batch.links)
            parts.append(batch.accepted.select("id"))
            new = parts[-1].count()
            counts["accepted"] += new
            counts["skipped"] += batch.skipped.count()
            left = None if left is None else left - new
            if left == 0:
                break
        wanted = reduce(DataFrame.union, parts).distinct()
    else:
        wanted = status.needing_pdf(flagged(shop.read("papers")), limit)
    if fetcher is not None:
        urls = wanted.select("id", parsing.url_of(url_base, F.col("id")).alias("url"))
        tries = f"{shop.root}/tries/{uuid.uuid4().hex}" if tries is None else tries
        shop.publish(outcomes=fetch.downloaded_in_slices(urls, fetcher, tries, workers=workers, delay=delay, **options))
        outcomes = shop.read("outcomes")
        shop.publish(papers=shop.changed("papers", outcomes, lambda near: status.store_outcomes(near, outcomes, now), "id"))
        failed = outcomes.where("error IS NOT NULL").count()
        counts |= {"downloaded": outcomes.count() - failed, "failed": failed}
    reconcile(shop)
    return counts


def reconcile(shop: SnapshotStore) -> None:
    shop.begin()
    papers = shop.ranged("papers", "id")
    old, new = F.col("pdf_downloaded"), F.col("_new")
    wrong = status.reconciled(flagged(papers.read()).withColumn("_old", old)).withColumnRenamed("pdf_downloaded", "_new").where(~new.eqNullSafe(F.col("_old"))).select("id")
    shop.publish(papers=papers.changed(wrong, lambda near: status.reconciled(flagged(near)).select(*near.columns), shop.folder("papers")))


def sync_folder(shop: SnapshotStore, files: DataFrame) -> int:
    """Sets the download flag to whether a file is there; returns how many flags changed."""
    shop.begin()
    papers = shop.ranged("papers", "id")
    changed = written(status.file_sync(papers.read(), files).where("changed").select("id", "pdf_downloaded"), "file-sync")
    new = lambda near: store.update_from(near, changed, "id", {"pdf_downloaded": F.col("s.pdf_downloaded")})
    shop.publish(papers=papers.changed(changed, new, shop.folder("papers")))
    return changed.count()


def load_files(shop: SnapshotStore, files: DataFrame, skip_existing: bool = True) -> dict[str, int]:
    """files: id, content.  Stores contents of papers; counts of loaded, skipped and unknown files."""
    shop.begin()
    papers = shop.ranged("papers", "id")
    near = papers.near(files)
    have = near.where("pdf_content IS NOT NULL").select("id")
    fresh = files.join(have, "id", "left_anti") if skip_existing else files
    total, new, strange = files.count(), fresh.count(), fresh.join(near.select("id"), "id", "left_anti").count()
    shop.publish(papers=papers.changed(fresh, lambda rows: status.store_files(rows, fresh.select("id", "content"))[0], shop.folder("papers")))
    return {"loaded": new - strange, "skipped": total - new, "unknown": strange}


def run_ocr(shop: SnapshotStore, renderer: Callable[[], fetch.PageRenderer], model: Callable[[], ocr_work.OcrModel] = lambda: ocr_work.mock_model, *, limit: int | None = 10, offset: int = 0, pages: int | None = None, per_run: int | None = 100, per_batch: int = 8, wave_pages: int = page_log.WAVE_PAGES, dpi: int = 200, retry_errors: bool = False, now: Column | None = None, **limits) -> int:
    """Recognises pages of candidate papers; returns how many papers were worked on.

    Pages come in waves, whose results are published one by one (page_log.py), so that a paper's pages can be spread
    over several runs, and a run that is broken off is gone on with by the next one, from its last wave on.
    limits: seconds, recycle_after and devices of ocr_work.recognised().
    """
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    shop.begin()
    papers, log, run = shop.ranged("papers", "id"), page_log.PageLog(shop), uuid.uuid4().hex
    chosen = status.ocr_candidates(flagged(papers.read()), limit, offset, retry_errors)
    source = papers.read().select("id", "pdf_content").join(chosen, "id", "left_semi")

    def count(batches):
        reader = renderer()
        for batch in batches:
            totals, errors = [], []
            for content in batch["pdf_content"]:
                try:
                    totals.append(reader.page_count(content))
                    errors.append(None)
                except Exception as problem:  # an unreadable paper is a result
                    totals.append(0)
                    errors.append(str(problem))
            batch["total"], batch["error"] = totals, errors
            yield batch[["id", "total", "error"]]

    shop.publish(ocr_work=source.mapInPandas(count, "id string, total int, error string"))
    work = shop.read("ocr_work")
    if work.isEmpty():
        return 0
    targets = work.where("error IS NULL").withColumn("target", ocr_work.target_pages(F.lit(pages).cast("int"), F.col("total")))
    plan = ocr_work.page_plan(targets.join(log.processed(work), "id", "left"), "id", per_run, per_batch).drop("is_partial")
    for wave in page_log.waves(plan, papers, shop.folder("ocr_plan"), wave_pages):
        contents = papers.near(wave).select("id", F.col("pdf_content").alias("content"))
        log.append(ocr_work.recognised(fetch.rendered(wave.join(contents, "id"), renderer, dpi), "id", model, **limits), run)

    errors = log.errors(run).groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("page", "error"))), lambda x: x["error"]).alias("errors"))
    box = F.struct(F.lit("text").alias("label"), F.col("content"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("score"), F.lit(None).cast("array<double>").alias("coordinate"))
    page = F.struct(F.col("page").alias("page_index"), F.lit(dpi).alias("dpi"), F.struct(F.array(box).alias("boxes")).alias("layout_det_res")).alias("result")
    folded = ocr_work.build_results(log.good(work).select("id", "page", page), "id", "page")
    none = F.array().cast("array<string>")
    result = targets.join(folded, "id", "left").join(errors, "id", "left").withColumn("errors", F.coalesce("errors", none)).withColumn("n", F.coalesce("processed_pages", F.lit(0)))
    finished = ocr_work.final_status(F.col("n"), F.size("errors"), F.col("target"), F.lit(False))
    document = F.struct("results", F.col("total").alias("total_pages"), F.col("n").cast("int").alias("processed_pages")).cast(ocr_document.DOCUMENT)
    rows = result.select("id", document.alias("results"), (finished == "complete").alias("completed"), F.nullif(ocr_work.error_text(F.col("errors")), F.lit("")).alias("error"))
    bad = work.where("error IS NOT NULL").select("id", F.lit(None).cast(ocr_document.DOCUMENT).alias("results"), F.lit(False).alias("completed"), "error")
    saved = rows.unionByName(bad)
    shop.publish(papers=papers.changed(work, lambda near: ocr_work.save_results(near, saved, now), shop.folder("papers")), **log.folded())
    return work.count()


@dataclass
class Report:
    statistics: DataFrame
    worst: DataFrame
    bands: DataFrame


def perplexity_report(papers: DataFrame, *, context: int = perplexity.CONTEXT, stride: int = perplexity.STRIDE, power: float = perplexity.POWER, worst: int = perplexity.WORST, scorer: Callable[[], perplexity.Scorer] | None = None, batch_scorer: Callable[[], perplexity.BatchScorer] | None = None) -> Report:
    """Scores of papers with OCR results: statistics, worst windows and bands of each.  Without a scorer: unigram frequencies."""
    text = papers.where("ocr_results IS NOT NULL").select("id", parsing.words(ocr_document.document_text(F.col("ocr_results"))).alias("words"))
    if batch_scorer is not None:
        scores = perplexity.batch_scores(text, "id", "words", batch_scorer, context, stride)
    else:
        scores = perplexity.unigram_scores(text, "id", "words", context, stride) if scorer is None else perplexity.model_scores(text, "id", "words", scorer, context, stride)
    chunks = scores.withColumn("ppl", F.exp("nll"))
    stats = perplexity.statistics(chunks, "id", power=power, keys=text)
    return Report(stats, perplexity.worst_chunks(chunks, "id", "chunk", "ppl", worst), stats.select("id", perplexity.band(F.col("penalized_ppl")).alias("band")))
