"""Queries over the driver's tables, one per operator, and their oracles.

Analogues: an article with versions is a customer with orders; a paper is a
document, with flags derived from ids and labels; an OCR page and box are a
conversation and a turn; a token sequence is the words of a document.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrollspark.functions import ocr_document, parsing, payload
from scrollspark.operators import ingest, ocr_work, perplexity, profile, search, status, store
from scrollspark.plans.oracles import LIST_BLOCK, ORACLE_SQL, PAPER_FLAGS
from scrollspark.session import shared_folder
from scrollspark.sources.files import table
from scrollspark.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_label"), "toxic")
    both = docs.join(labels, docs["doc_id"] == F.col("_label"), "left")
    return both.select(
        F.col("doc_id").cast("string").alias("id"), "doc_id", "text", F.concat_ws(" ", "lang", "source").alias("categories"), *(F.expr(sql).alias(name) for name, sql in PAPER_FLAGS.items())
    )


def _article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON line per customer with its orders as versions."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.struct("o_orderdate", "o_orderkey").alias("o"))
    grouped = orders.groupBy("o_custkey").agg(F.sort_array(F.collect_list("o")).alias("o"))
    versions = F.transform("o", lambda x, i: F.struct(F.concat(F.lit("v"), i + 1).alias("version"), parsing.http_date(x["o_orderdate"]).alias("created")))
    return grouped.select(F.to_json(F.struct(F.col("o_custkey").cast("string").alias("id"), versions.alias("versions"))).alias("value"))


@query
def profile_year_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.year_histogram(profile.articles(_article_lines(spark, sf_dir)))


@query
def profile_version_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.version_histogram(profile.articles(_article_lines(spark, sf_dir)))


@query
def profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.summary(profile.articles(_article_lines(spark, sf_dir)))


@query
def profile_last_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.last_years(profile.year_histogram(profile.articles(_article_lines(spark, sf_dir))), 3)


@query
def ingest_parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), "event_id")).otherwise(F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("title"))))
    return ingest.parse_counts(events.select(line.alias("value")))


@query
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderkey").alias("id"), parsing.date_of(F.date_format("o_orderdate", "yyyy-M-d")).alias("update_date"))


@query
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.counts(_papers(spark, sf_dir))


@query
def flag_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.reconcile_counts(_papers(spark, sf_dir))


@query
def flag_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.reconciled(_papers(spark, sf_dir)).select("id", "pdf_downloaded")


@query
def papers_needing_pdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.needing_pdf(_papers(spark, sf_dir))


@query
def download_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.download_candidates(_papers(spark, sf_dir), None, ["EN src1", "fr"])


@query
def ocr_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paging is the feature: 20 candidates after the first 5."""
    return status.ocr_candidates(_papers(spark, sf_dir), limit=20, offset=5)


@query
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paging is the feature: 30 papers after an id."""
    return status.keyset_page(_papers(spark, sf_dir).select("id", "pdf_downloaded"), "150", 30)


@query
def list_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paging is the feature: the first 20 papers with results."""
    return status.available(_papers(spark, sf_dir), limit=20, title="text")


@query
def category_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.vocabulary(table(spark, sf_dir, "part"), F.col("p_name"))


@query
def paper_category_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.categories_of(table(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_name"))


@query
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = ingest.categories_of(_papers(spark, sf_dir), F.col("id"), F.col("categories"))
    return links.groupBy("category").agg(F.count(F.lit(1)).alias("papers"))


@query
def replace_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    old = ingest.categories_of(part, F.col("p_partkey"), F.col("p_name"))
    new = part.where(F.col("p_partkey") % 5 == 0).select(F.col("p_partkey").alias("paper_id"), F.col("p_brand").alias("category"))
    return store.replace_links(old, new)


@query
def ingest_new_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return ingest.first_new(docs.select("doc_id"), labels, "doc_id", ["doc_id"])


@query
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    target = customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("title"), F.round("c_acctbal", 2).alias("preserved"))
    title = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    source = customer.where(F.col("c_custkey") % 2 == 0).select((F.col("c_custkey") + 10).alias("id"), title.alias("title"))
    return store.merge(target, source, "id", {"title": store.REPLACE, "preserved": store.PRESERVE})


@query
def file_load_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, docs = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents").select("doc_id")
    both = status.matched_files(pages, docs, docs["doc_id"] == pages["page_id"] * 5)
    return both.select(F.col("page_id").alias("file_id"), F.col("doc_id").isNotNull().alias("matched"), F.octet_length("html").cast("bigint").alias("bytes"))


@query
def fs_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"))
    return status.file_sync(_papers(spark, sf_dir), files)


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.run_summary(table(spark, sf_dir, "pages"), F.col("html").startswith("<!DOCTYPE"), F.octet_length("html"))


@query
def download_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = _papers(spark, sf_dir).withColumn("pdf_download_attempted_at", F.lit(None).cast("timestamp_ntz"))
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 0, "HTTP 500").alias("error"), F.lit(None).cast("binary").alias("content"))
    stored = status.store_outcomes(papers, outcomes, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return stored.select("id", "pdf_downloaded", "pdf_download_error", F.col("pdf_download_attempted_at").isNotNull().alias("attempted"))


@query
def payload_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", payload.outcome(F.col("html").cast("binary"), 8000, "<!DOCTYPE").alias("outcome"))


@query
def id_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, n = table(spark, sf_dir, "pages"), F.col("page_id").cast("string")
    kind = F.col("page_id") % 6
    raw = F.when(kind == 0, F.concat(F.lit("../"), n)).when(kind == 1, F.concat(F.lit("cs.AI/"), n)).when(kind == 2, F.concat(F.lit(" "), n, F.lit(".0001 ")))
    raw = raw.when(kind == 3, F.concat(F.lit("a/b/"), n)).when(kind == 4, F.concat(F.lit("x\\"), n)).otherwise(F.concat(F.lit("~"), n))
    return pages.select("page_id", parsing.file_name(parsing.normal_id(raw)).alias("file_name"))


@query
def box_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    label = F.when(F.col("role") == "user", "Text").when(F.col("role") == "assistant", "table").otherwise(F.col("role"))
    return turns.select("conv_id", "turn", ocr_document.colour(label).alias("colour"), ocr_document.caption(F.col("turn"), F.col("role")).alias("caption"))


@query
def ocr_page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    work = turns.groupBy("conv_id").agg(
        ocr_work.target_pages(F.max("turn") + 3, F.lit(8)).alias("target"), F.collect_set(F.when(F.col("turn") % 2 == 0, F.col("turn").cast("int"))).alias("processed")
    )
    return ocr_work.page_plan(work, "conv_id", per_run=4, per_batch=2).select("conv_id", F.col("page").cast("bigint").alias("page"), "batch")


@query
def ocr_build_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("page_index"), F.col("role").alias("result"))
    return ocr_work.build_results(pages, "conv_id").select("conv_id", F.array_join("results", "|").alias("results"), "processed_pages")


@query
def ocr_result_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of few papers with very many pages, in blocks: a role's turns, in the order of conversations."""
    pages = table(spark, sf_dir, "conversations").select("role", F.struct("conv_id", "turn").alias("page"), "text")
    found = ocr_work.result_blocks(pages, "role", "page", "text", LIST_BLOCK)
    return found.select("role", "block", "blocks", "processed_pages", F.md5(F.array_join("results", "|", "-").cast("binary")).alias("digest"))


@query
def ocr_finalize_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("processed"), F.count_if(F.col("role") == "system").alias("errors"))
    return state.select("conv_id", ocr_work.final_status(F.col("processed"), F.col("errors"), F.lit(4), F.col("processed") > 6).alias("status"))


def _documents_of_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as an OCR document: one page whose boxes are the turns, placed by the length of the role."""
    box = F.struct(
        F.col("role").alias("label"), F.col("text").alias("content"), F.lit(None).cast("string").alias("text"), F.lit("0.5").alias("score"),
        F.array(F.lit(0.0), F.length("role").cast("double"), F.lit(1.0), F.lit(1.0)).alias("coordinate"),
    )
    boxes = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", box.alias("box")))).alias("b"))
    page = F.struct(F.lit(0).alias("page_index"), F.lit(200).alias("dpi"), F.struct(F.transform("b", lambda x: x["box"]).alias("boxes")).alias("layout_det_res"))
    return boxes.select("conv_id", F.struct(F.array(page).alias("results"), F.lit(1).alias("total_pages"), F.lit(1).alias("processed_pages")).alias("document"))


@query
def ocr_text_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents_of_turns(spark, sf_dir).select("conv_id", ocr_document.document_text(F.col("document")).alias("text"))


@query
def ocr_text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", parsing.word_count(F.col("text")).alias("words"), F.char_length("text").alias("chars"))


@query
def ocr_mock_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("page"), F.col("text").cast("binary").alias("image"))
    return ocr_work.recognised(pages, "conv_id")


@query
def ppl_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", parsing.word_count(F.col("text")).cast("bigint").alias("n"))
    return perplexity.windows(docs, "doc_id", "n", context=128, stride=64)


@query
def ppl_chunk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", parsing.words(F.col("text")).alias("words"))
    scores = perplexity.unigram_scores(docs, "doc_id", "words", context=128, stride=64)
    return scores.select("doc_id", "chunk", F.round("nll", 4).alias("nll"), "scored")


def _order_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("chunk"), (1.0 + F.col("o_totalprice") / 100000.0).alias("ppl"), (1 + F.col("o_orderkey") % 7).alias("scored"), "o_totalprice"
    )


@query
def ppl_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perplexity.statistics(_order_chunks(spark, sf_dir), "doc_id")
    return found.select("doc_id", *(F.round(c, 4).alias(c) for c in ("mean_ppl", "median_ppl", "p90", "p95", "p99", "max_ppl", "min_ppl", "penalized_ppl")), "num_chunks", "total_tokens")


@query
def ppl_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of keys that hold large shares of all rows: the prices of lines by their flag."""
    found = perplexity.exact_percentiles(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice")
    return found.select("l_returnflag", *(F.round(F.col(c).cast("double"), 4).alias(c) for c in perplexity.PERCENTILES))


@query
def ppl_chunk_list_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of keys that hold large shares of all rows: the prices of lines by their flag, in blocks."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), "l_extendedprice")
    found = perplexity.chunk_list_blocks(lines, "l_returnflag", "line", "l_extendedprice", LIST_BLOCK)
    shown = F.transform("items", lambda x: F.concat_ws(":", x["chunk"], F.round(x["ppl"] * 100, 0).cast("bigint")))
    return found.select("l_returnflag", "block", "blocks", "total", F.md5(F.array_join(shown, " ").cast("binary")).alias("digest"))


@query
def ppl_worst_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.worst_chunks(_order_chunks(spark, sf_dir), "doc_id", "chunk", "o_totalprice", 5)


@query
def ppl_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", perplexity.band(F.col("n_chars")).alias("band"))


@query
def fts_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.index(table(spark, sf_dir, "documents"), "doc_id", ["source", "text"]), "doc_id", ["the", "und", "Der"])


@query
def fts_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.index(table(spark, sf_dir, "documents"), "doc_id", ["source", "text"])


@query
def json_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    text = F.to_json(F.struct("role", F.col("text").alias("content"), F.struct(F.lit("x").alias("input_img"), F.col("turn").alias("page_index")).alias("layout")))
    return turns.select("conv_id", "turn", ocr_document.scrubbed_json(text).alias("document"))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file stream over JSON lines written from the documents, run to its end."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    docs.select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("title"))).alias("value")).write.text(f"{root}/in")
    return incremental.records_stream(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint")


from scrollspark.plans import runs  # noqa: E402, F401  registers its queries
