"""Queries that run whole operators: ingest, files, downloads, OCR state, migrations, snapshots.

What passes through files goes to a new folder of the shared one.
"""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrollspark.functions import ocr_document, parsing, payload, stemming
from scrollspark.operators import ingest, ocr_work, page_log, perplexity, profile, ranges, schema, search, status, text_index
from scrollspark.operators import store as tables
from scrollspark.operators.store import SnapshotStore
from scrollspark.plans.catalog import _documents_of_turns, _order_chunks, _papers, query
from scrollspark.session import shared_folder
from scrollspark.sources import fetch, files
from scrollspark.sources.files import table
from scrollspark.streaming import incremental



def _day() -> Column:
    """The time of all runs."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Ingest


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of the documents, some broken, some with unsafe ids, some with the id of the line before."""
    doc = F.col("doc_id")
    ident = F.when(doc % 7 == 0, F.concat(F.lit("../"), doc)).otherwise(F.concat(F.lit("cs\\"), F.when(doc % 3 == 1, doc - 1).otherwise(doc)))
    good = F.to_json(F.struct(ident.alias("id"), F.concat_ws("-", "lang", doc).alias("title"), F.concat_ws("  ", "lang", "source", "lang").alias("categories")))
    return table(spark, sf_dir, "documents").select(F.when(doc % 11 == 0, F.concat(F.lit("{broken "), doc)).otherwise(good).alias("value"), doc.alias("ordinal"))


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Papers, categories and links before the ingest: every tenth document, in the category "old"."""
    old = table(spark, sf_dir, "documents").where("doc_id % 10 = 0").select(F.concat(F.lit("cs/"), "doc_id").alias("id"), F.lit("old").alias("title"), F.lit(True).alias("pdf_downloaded"))
    papers = spark.createDataFrame([], schema.papers_ddl()).unionByName(old, allowMissingColumns=True)
    return papers, spark.createDataFrame([("old", None, None)], schema.CATEGORIES), old.select(F.col("id").alias("paper_id"), F.lit("old").alias("category"))


def _loaded(spark: SparkSession, sf_dir: str, **options) -> ingest.Batch:
    return ingest.load(_lines(spark, sf_dir), *_tables(spark, sf_dir), now=_day(), **options)


@query
def ingest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).papers.select("id", "title", "categories", "pdf_downloaded", F.col("created_at").isNotNull().alias("created"))


@query
def ingest_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, resume=False).papers.select("id", "title", "pdf_downloaded", F.col("updated_at").isNotNull().alias("updated"))


@query
def ingest_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, resume=False).links


@query
def ingest_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).categories.select("category", F.col("created_at").isNotNull().alias("created"))


@query
def ingest_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limits are the feature: of the first 600 lines, the first 40 new papers, and those skipped before the last of them."""
    batch = _loaded(spark, sf_dir, limit=40, max_records=600)
    return batch.accepted.select("id", F.lit("new").alias("kind")).union(batch.skipped.select("id", F.lit("known").alias("kind")))


@query
def first_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the feature: the first 25 documents without a label."""
    return ingest.first_new(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", ["doc_id"], 25)


@query
def known_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")


@query
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written to several files by document, and read again in the order of files; the cap on lines is the feature."""
    folder = _folder(spark, "lines")
    table(spark, sf_dir, "documents").orderBy("doc_id").select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"))).alias("value")).write.text(folder)
    return files.numbered_lines(spark, folder, 700).select("ordinal", parsing.record(F.col("value"))["id"].alias("id"))


@query
def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of files through the stream into a store; the second repeats papers of the first."""
    root = _folder(spark, "ingest-stream")
    shop = SnapshotStore(spark, f"{root}/store")
    schema.run_migrations(shop)
    docs = table(spark, sf_dir, "documents")
    for turn, part in ((1, docs.where("doc_id % 2 = 0")), (2, docs.where("doc_id % 4 <> 2"))):
        title = F.concat_ws("-", F.col("lang"), F.lit(turn))
        part.select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), title.alias("title"), F.col("source").alias("categories"))).alias("value")).write.mode("append").text(f"{root}/in")
        incremental.ingest_stream(spark, f"{root}/in", shop, f"{root}/checkpoint", now=_day())
    return shop.read("papers").join(shop.read("links"), F.col("id") == F.col("paper_id")).select("id", "title", "category")


@query
def record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    names = F.when(key % 2 == 0, F.array(F.array(F.col("o_orderstatus"), F.lit("x"))))
    line = F.to_json(F.struct(
        key.cast("string").alias("id"), F.when(key % 3 == 0, F.col("o_orderpriority")).alias("title"), F.col("o_orderstatus").alias("journal-ref"),
        F.when(key % 5 == 0, key.cast("string")).alias("report-no"), names.alias("authors_parsed"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("update_date"),
    ))
    rec = orders.select(parsing.record(line).alias("r")).select(*parsing.record_columns(F.col("r"), empty_arrays=True))
    return rec.select("id", "title", "journal_ref", "report_no", F.size("authors_parsed").alias("n_authors"), F.size("versions").alias("n_versions"), "update_date")


# Store


@query
def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publications of a table of three; the newest counts, the other tables stay."""
    shop = SnapshotStore(spark, _folder(spark, "store"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    shop.publish(a=docs, b=docs, c=docs.limit(0))
    shop.publish(a=shop.read("a").withColumn("lang", F.upper("lang")))
    return shop.read("a").withColumn("part", F.lit("a")).union(shop.read("b").withColumn("part", F.lit("b"))).union(shop.read("c").withColumn("part", F.lit("c")))


#: Rows of a file of a table in key ranges; small, so that the tests' tables have several.
RANGE_ROWS = 1_000


@query
def ranged_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in key ranges; the orders of returned lines are marked, and each of a large line gets a copy under a negative key; then small files are merged."""
    root = _folder(spark, "ranged")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.lit(None).cast("string").alias("note"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_quantity").alias("most"), F.max("l_returnflag").alias("flag"))
    changes = lines.where("flag = 'R'").select(F.col("l_orderkey").alias("id"), F.lit("returned").alias("note"))
    new = lines.where("most >= 50").select((-F.col("l_orderkey")).alias("id"), F.lit("large").alias("note"))
    source = changes.union(new).withColumn("status", F.lit("X"))
    kept = ranges.ranged(orders, f"{root}/v1", "id", rows_per_file=RANGE_ROWS)
    kept = kept.changed(source, lambda near: tables.merge(near, source, "id", {"note": tables.REPLACE}, defaults={"status": "N"}), f"{root}/v2")
    return kept.compacted(f"{root}/v3").read()


@query
def ranged_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batched lookups by key: orders of the customers' first orders, read from the files that have them."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    kept = ranges.ranged(orders, _folder(spark, "ranged"), "id", rows_per_file=RANGE_ROWS)
    asked = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("id"))
    return asked.join(kept.near(asked), "id")


@query
def ranged_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of 50 open orders behind a key."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    kept = ranges.ranged(orders, _folder(spark, "ranged"), "id", rows_per_file=RANGE_ROWS)
    return kept.page(50, after=500, where="status = 'O'")


@query
def first_new_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 documents without a label, from a folder of JSON lines that is read file by file until they are found."""
    folder = _folder(spark, "waves")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    docs.repartitionByRange(8, F.col("id").cast("bigint")).sortWithinPartitions(F.col("id").cast("bigint")).select(F.to_json(F.struct("id", F.col("lang").alias("title"))).alias("value")).write.text(folder)
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return reduce(DataFrame.union, ingest.first_new_of_files(spark, folder, known, 25, first=1)).select("id", "title")


@query
def fts_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stem of every distinct word of the documents."""
    words = F.split(F.lower("text"), search.SEPARATORS)
    terms = table(spark, sf_dir, "documents").select(F.explode(words).alias("term")).where("term <> ''").distinct()
    return terms.select("term", stemming.english_stem(F.col("term")).alias("stem"))


@query
def fts_kept_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A kept index: all documents, then new texts of the labelled ones in a second segment, then both merged; its terms."""
    kept = text_index.TextIndex(SnapshotStore(spark, _folder(spark, "fts")), "fts", "doc_id", ["source", "text"], rows_per_file=RANGE_ROWS)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id").distinct()
    kept.add(docs)
    kept.add(docs.join(labels, "doc_id").withColumn("text", F.concat(F.lit("Revised editions: "), "lang")))
    kept.merge()
    return kept.postings()


@query
def fts_kept_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a kept index of two segments that have all of some words."""
    kept = text_index.TextIndex(SnapshotStore(spark, _folder(spark, "fts")), "fts", "doc_id", ["source", "text"], rows_per_file=RANGE_ROWS)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id").distinct()
    kept.add(docs)
    kept.add(docs.join(labels, "doc_id").withColumn("text", F.concat(F.lit("und der "), "lang")))
    return kept.search(["the", "und", "Der"])


@query
def migrated_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level 1 to 4 and back to 2: the columns of level 2 have their defaults, later ones are gone."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("title"))
    papers = spark.createDataFrame([], schema.papers_ddl(1)).unionByName(docs, allowMissingColumns=True)
    head = schema.migrate(papers, 1, schema.HEAD)
    back = schema.migrate(head.withColumn("pdf_downloaded", F.col("id").endswith("0")), schema.HEAD, 2)
    return back.select("id", "title", "pdf_downloaded", F.col("pdf_download_error").isNull().alias("no_error"), F.lit(len(back.columns)).alias("n_columns"), F.lit(len(head.columns)).alias("n_head"))


@query
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    papers = parts.select(F.when(F.col("p_partkey") % 50 != 0, F.repeat(F.concat(F.lit("p"), F.col("p_partkey") % 700), F.when(F.col("p_partkey") % 90 == 7, 20).otherwise(1))).alias("id"))
    categories = parts.select(F.when(F.col("p_partkey") % 400 != 0, F.col("p_brand")).alias("category")).where("p_partkey % 3 = 0 OR p_partkey % 400 = 0")
    links = parts.select(F.concat(F.lit("p"), F.col("p_partkey") % 800).alias("paper_id"), F.when(F.col("p_size") < 45, F.col("p_brand")).otherwise(F.lit("none")).alias("category"))
    return schema.violations(papers, categories, links)


@query
def upsert_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older policy: path and time of update are replaced, new rows are not downloaded, tracking stays."""
    docs = table(spark, sf_dir, "documents")
    target = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("title"), F.lit("/old").alias("pdf_path"), (F.col("doc_id") % 2 == 0).alias("pdf_downloaded"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    source = docs.where("doc_id % 3 = 0").select((F.col("doc_id") + 100).alias("id"), F.col("source").alias("title"), F.concat(F.lit("/new/"), "doc_id").alias("pdf_path"))
    policy = {"title": tables.REPLACE, "pdf_path": tables.REPLACE, "updated_at": tables.NOW}
    out = tables.merge(target, source, "id", policy, _day(), {"pdf_downloaded": False})
    return out.select("id", "title", "pdf_path", "pdf_downloaded", F.col("updated_at").isNotNull().alias("updated"))


@query
def categories_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New words of the vocabulary are added, known ones keep their label."""
    parts = table(spark, sf_dir, "part")
    known = ingest.vocabulary(parts.where("p_partkey % 40 = 0"), F.col("p_name")).withColumn("label", F.lit("known"))
    words = parts.select(F.explode(parsing.words(F.concat_ws(" ", "p_name", "p_type"))).alias("category"))
    return tables.add_new(known, words, "category")


@query
def paper_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers that go take their links along; a renamed category takes its links along."""
    parts = table(spark, sf_dir, "part")
    papers, links = parts.select(F.col("p_partkey").alias("id")), ingest.categories_of(parts, F.col("p_partkey"), F.col("p_name"))
    left, kept = tables.delete_cascade(papers, links, parts.where("p_size > 20").select(F.col("p_partkey").alias("id")))
    names = spark.createDataFrame([("small", "ring"), ("ring", "band")], "category string, new_category string")
    renamed, _ = tables.rename_categories(kept, ingest.vocabulary(parts, F.col("p_name")), names)
    return left.join(renamed, F.col("id") == F.col("paper_id"), "left").select("id", "category")


@query
def outcomes_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older rule: a failed download clears the flag."""
    papers = _papers(spark, sf_dir).withColumn("pdf_download_attempted_at", F.lit(None).cast("timestamp_ntz"))
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 0, "HTTP 500").alias("error"), F.lit(None).cast("binary").alias("content"))
    return status.store_outcomes(papers, outcomes, _day(), clears_flag=True).select("id", "pdf_downloaded", "pdf_download_error")


# Files, downloads and pages


def _pdf(html: str) -> Column:
    return F.concat(F.lit("%PDF-"), F.col(html)).cast("binary")


@query
def files_from_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages saved as files, listed and read again, and matched with documents of five times their number."""
    folder = _folder(spark, "pdfs")
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("p/"), F.col("page_id") * 5).alias("id"), _pdf("html").alias("content"))
    fetch.saved(pages, folder).count()
    found = files.pdf_files(spark, folder)
    papers = table(spark, sf_dir, "documents").select(F.concat(F.lit("p/"), "doc_id").alias("_paper"))
    both = status.matched_files(found, papers, F.col("id") == F.col("_paper"))
    return both.select("id", "length", F.sha2("content", 256).alias("sha256"), F.col("_paper").isNotNull().alias("matched"))


@query
def files_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents go to their papers; errors stay as they are."""
    papers = _papers(spark, sf_dir).withColumn("pdf_content", F.lit(None).cast("binary"))
    found = table(spark, sf_dir, "pages").select((F.col("page_id") * 3).cast("string").alias("id"), _pdf("html").alias("content"))
    stored, unknown = status.store_files(papers, found)
    rows = stored.select("id", F.octet_length("pdf_content").alias("bytes"), "pdf_downloaded", "pdf_download_error")
    return rows.union(unknown.select("id", F.lit(-1), F.lit(None).cast("boolean"), F.lit("no paper")))


@query
def paths_and_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident = F.concat(F.lit("cs/"), "page_id")
    kind = F.when(F.col("page_id") % 4 == 0, "Application/PDF; q=1").when(F.col("page_id") % 4 == 1, "text/html").when(F.col("page_id") % 4 == 2, "")
    path = parsing.path_under("/data/", ident)
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"), parsing.url_of("https://x.org/pdf/", ident).alias("url"), parsing.id_of_file(path).alias("id"), payload.content_type_ok(kind).alias("type_ok"))


def _answers():
    """A stand-in for the network: what a URL answers follows from its number; odd numbers fail at first."""
    tried: set[str] = set()

    def get(url: str, timeout: float) -> fetch.Response:
        n = int(url.rsplit("/", 1)[1].removesuffix(".pdf"))
        if n % 2 and url not in tried:
            tried.add(url)
            raise OSError("connection lost")
        if n % 5 == 0:
            return fetch.Response(404, None, None, b"")
        if n % 7 == 0:
            return fetch.Response(200, "text/html", None, b"%PDF-")
        return fetch.Response(200, "application/pdf", "not a number", (b"%PDF-" if n % 11 else b"<html") + bytes(n % 13))

    return get


@query
def downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id")).withColumn("url", parsing.url_of("http://x/pdf", F.col("id")))
    got = fetch.downloaded_in_slices(urls, _answers, _folder(spark, "tries"), slices=4, delay=0.0, pause=0.0, max_bytes=16)
    return got.select("id", F.octet_length("content").alias("bytes"), "error")


class _Pages:
    """A stand-in for a PDF library: a page for every 4,000 bytes, whose image is these bytes."""

    def page_count(self, content: bytes) -> int:
        return -(-len(content) // 4000)

    def render(self, content: bytes, page: int, dpi: int) -> bytes:
        return content[4000 * page : 4000 * (page + 1)]


@query
def pages_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), F.col("html").cast("binary").alias("content"))
    numbered = pages.withColumn("page", F.explode(F.sequence(F.lit(0), F.ceil(F.octet_length("content") / 4000).cast("int") - 1)))
    return fetch.rendered(numbered, _Pages).select("id", "page", F.md5("image").alias("image_md5"))


# OCR


@query
def ocr_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed papers get results, flag and time and lose their error; unreadable ones keep the results they have."""
    papers = _papers(spark, sf_dir).select(
        "id", F.when(F.col("doc_id") % 2 == 0, "old").alias("ocr_results"), (F.col("doc_id") % 5 == 0).alias("ocr_processed"),
        F.lit(None).cast("timestamp_ntz").alias("ocr_processed_at"), F.when(F.col("doc_id") % 3 == 0, "old error").alias("ocr_error"),
    )
    done = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 1, "new").alias("results"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("completed"),
        F.when(F.col("toxic") == 1, "bad page").alias("error"),
    )
    saved = ocr_work.save_results(papers, done, _day())
    return saved.select("id", "ocr_results", "ocr_processed", F.col("ocr_processed_at").isNotNull().alias("timed"), "ocr_error")


@query
def ocr_last_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") % 3).alias("page_index"), F.col("turn").alias("position"), "role")
    return ocr_work.last_results(turns, "conv_id", "position")


@query
def ocr_page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as pages, recognised in mock mode: a run that is broken off after its first wave, and one that goes on; what the log has of each page."""
    shop = SnapshotStore(spark, _folder(spark, "pages"))
    totals = table(spark, sf_dir, "conversations").where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("target"))
    papers, log = ranges.ranged(totals, shop.folder("papers"), "conv_id", rows_per_file=RANGE_ROWS), page_log.PageLog(shop, "pages", "conv_id", "bigint", RANGE_ROWS)
    for run, stop in (("broken off", 1), ("goes on", None)):
        plan = ocr_work.page_plan(papers.read().join(log.processed(papers.read()), "conv_id", "left"), "conv_id", None, 2)
        for wave in islice(page_log.waves(plan, papers, shop.folder("plan"), papers.count()), stop):
            log.append(ocr_work.recognised(wave.withColumn("image", F.lit(None).cast("binary")), "conv_id"), run)
    shop.publish(**log.folded())
    return log.good()


@query
def ocr_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three errors of a paper are its error."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.concat_ws(" ", "role", "turn").alias("e")))).alias("all"))
    return turns.select("conv_id", ocr_work.error_text(F.transform("all", lambda x: x["e"])).alias("error"))


@query
def ocr_dpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = F.when(F.col("conv_id") % 3 > 0, F.col("document"))
    return _documents_of_turns(spark, sf_dir).select("conv_id", ocr_document.dpi_of(document).alias("dpi"), ocr_document.dpi_of(document, 72).alias("wanted"))


@query
def ocr_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr_document.drawn_boxes(_documents_of_turns(spark, sf_dir), "conv_id").select("conv_id", "page_index", "colour", "caption", F.get("coordinate", F.lit(1)).alias("top"))


@query
def text_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text panel of each turn."""

    @F.pandas_udf("array<string>")
    def lines(text: pd.Series) -> pd.Series:
        return text.fillna("").map(ocr_document.wrapped)

    return table(spark, sf_dir, "conversations").select("conv_id", "turn", lines("text").alias("lines"))


# Reports


def _mean_length():
    return lambda tokens, start, end: sum(len(t) for t in tokens[start:end]) / (end - start)


@query
def ppl_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows scored by a model that takes the mean length of words for likelihood."""
    docs = table(spark, sf_dir, "documents").select("doc_id", parsing.words(F.col("text")).alias("words"))
    return perplexity.model_scores(docs, "doc_id", "words", _mean_length, 128, 64).select("doc_id", "chunk", F.round("nll", 6).alias("nll"), "scored")


@query
def ppl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all customers; those without windows have infinite values and counts of 0."""
    customers = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("doc_id"))
    found = perplexity.statistics(_order_chunks(spark, sf_dir), "doc_id", keys=customers)
    return found.select("doc_id", F.round("mean_ppl", 4).alias("mean_ppl"), F.round("max_ppl", 4).alias("max_ppl"), "num_chunks", "total_tokens")


@query
def ppl_chunk_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = perplexity.chunk_lists(_order_chunks(spark, sf_dir), "doc_id")
    shown = F.transform("chunks", lambda x: F.concat_ws(":", x["chunk"], F.round(x["ppl"] * 1000, 0).cast("bigint")))
    return lists.select("doc_id", F.array_join(shown, " ").alias("chunks"))


@query
def run_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = status.throughput(table(spark, sf_dir, "events"), "ts", F.col("event_type") != "error")
    return rate.select("records", F.round("seconds", 3).alias("seconds"), F.round("rate", 6).alias("rate"))


@query
def profile_years_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a file, split in parallel, of which some are broken and some have no versions."""
    folder = _folder(spark, "profile")
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    versions = F.when(key % 5 > 0, F.array(F.struct(F.lit("v1").alias("version"), parsing.http_date(F.col("o_orderdate")).alias("created"))))
    line = F.when(key % 9 == 0, "[1, 2").otherwise(F.to_json(F.struct(key.cast("string").alias("id"), versions.alias("versions"))))
    orders.select(line.alias("value")).write.text(folder)
    return profile.year_histogram(profile.articles(files.lines(spark, folder)))
