"""Ingest of JSON-lines metadata: parsing, resume, limits, vocabulary and links."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scrollspark.functions import parsing
from scrollspark.operators import schema, store
from scrollspark.operators.ranges import Ranged
from scrollspark.session import written


def parsed(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines with a column ok and the record's columns; other columns, such as ordinal, stay."""
    rec = lines.withColumn("_rec", parsing.record(F.col(line)))
    ok = F.col("_rec").isNotNull() & parsing.truthy(F.col("_rec")["id"])
    return rec.select(*(c for c in lines.columns if c != line), ok.alias("ok"), *parsing.record_columns(F.col("_rec")))


def parse_counts(lines: DataFrame, line: str = "value") -> DataFrame:
    """How many lines are records and how many are not."""
    ok = parsing.is_object(F.col(line))
    return lines.agg(F.count_if(~ok).alias("errors"), F.count_if(ok).alias("parsed"))


def first_or_last(records: DataFrame, last: bool, key: str = "id", order: str = "ordinal") -> DataFrame:
    """One record of each id: the first (resumed runs) or the last (fresh runs) in file order.

    A struct's minimum is combined before the shuffle, so an id that is there very often moves once per task.
    """
    pick = F.max if last else F.min
    chosen = records.groupBy(key).agg(pick(order).alias(order))
    return records.join(chosen, [key, order], "left_semi")


def first_new(records: DataFrame, existing: DataFrame, key: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Records whose key the table lacks, in order; at most limit of them."""
    fresh = records.join(existing.select(key), key, "left_anti").orderBy(*order)
    return fresh if limit is None else fresh.limit(limit)


def categories_of(records: DataFrame, key: Column, text: Column) -> DataFrame:
    """(paper_id, category), each once."""
    return records.select(key.alias("paper_id"), F.explode(parsing.words(text)).alias("category")).distinct()


def vocabulary(records: DataFrame, text: Column) -> DataFrame:
    return records.select(F.explode(parsing.words(text)).alias("category")).distinct()


@dataclass
class Batch:
    papers: DataFrame | Ranged
    categories: DataFrame | Ranged
    links: DataFrame | Ranged
    accepted: DataFrame
    skipped: DataFrame


def records(lines: DataFrame, *, max_records: int | None = None, resume: bool = True, validate_ids: bool = True) -> DataFrame:
    """One record of each usable id: with resume the first, else the last."""
    if max_records is not None:
        lines = lines.where(F.col("ordinal") < max_records)
    good = parsed(lines).where("ok").drop("ok")
    if validate_ids:
        good = good.withColumn("id", parsing.normal_id(F.col("id"))).where(F.col("id").isNotNull())
    return first_or_last(good.where(F.char_length("id") <= schema.ID_LENGTH), last=not resume)


def chosen(one: DataFrame, ids: DataFrame, limit: int | None, resume: bool) -> tuple[DataFrame, DataFrame]:
    """Records that are accepted, and those that the table has already and that come before the last accepted one."""
    known = one.join(ids, "id", "left_semi")
    accepted = one.join(ids, "id", "left_anti") if resume else one
    if limit is not None:
        accepted = accepted.orderBy("ordinal").limit(limit)
        edge = accepted.agg(F.max("ordinal").alias("_edge"))
        known = known.join(F.broadcast(edge), F.col("ordinal") < F.col("_edge"), "left_semi")  # one row
    return accepted, known


def with_records(papers: DataFrame, accepted: DataFrame, now: Column) -> DataFrame:
    """Papers with the accepted records: metadata replaced, all other columns of known papers kept."""
    policy = dict.fromkeys(schema.METADATA, store.REPLACE) | {"updated_at": store.NOW}
    source = accepted.drop("ordinal").withColumn("created_at", now).withColumn("updated_at", now)
    merged = store.merge(papers, source, "id", policy, now, {"pdf_downloaded": False, "ocr_processed": False})
    return merged.withColumn("created_at", F.coalesce("created_at", "updated_at")) if "created_at" in papers.columns else merged


def _links_of(accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The accepted papers as paper_id, and their links."""
    return accepted.select(F.col("id").alias("paper_id")), categories_of(accepted, F.col("id"), F.col("categories"))


def load(
    lines: DataFrame, papers: DataFrame, categories: DataFrame, links: DataFrame, *,
    limit: int | None = None, max_records: int | None = None, resume: bool = True, validate_ids: bool = True, now: Column | None = None,
) -> Batch:
    """New versions of the three tables after ingesting lines (value, ordinal from 0).

    limit caps the records accepted, max_records the lines read.  With resume,
    ids that the table has are skipped and the first of repeated ids counts; without,
    they are updated and the last counts.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    accepted, known = chosen(records(lines, max_records=max_records, resume=resume, validate_ids=validate_ids), papers.select("id"), limit, resume)
    touched, new_links = _links_of(accepted)
    words = new_links.select("category").distinct().withColumn("created_at", now)
    return Batch(with_records(papers, accepted, now), store.add_new(categories, words, "category"), store.replace_links(links, new_links, batch=touched), accepted, known)


def load_into(
    shop: store.SnapshotStore, lines: DataFrame, *, limit: int | None = None, max_records: int | None = None, resume: bool = True, validate_ids: bool = True, now: Column | None = None
) -> Batch:
    """The same over a store, as files of key ranges to be published: files without an accepted paper are neither read nor written.

    Lines are parsed once; the records are kept in the store's folder until it is cleaned.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now

    def staged(rows: DataFrame, name: str) -> DataFrame:
        path = shop.folder(name)
        rows.write.parquet(path)
        return shop.spark.read.schema(rows.schema).parquet(path)

    one = staged(records(lines, max_records=max_records, resume=resume, validate_ids=validate_ids), "staged")
    papers = shop.ranged("papers", "id")
    accepted, known = chosen(one, papers.near(one).select("id"), limit, resume)
    accepted, known = staged(accepted, "staged"), staged(known.select("id"), "staged")
    touched, new_links = _links_of(accepted)
    words = new_links.select("category").distinct().withColumn("created_at", now)
    return Batch(
        papers.changed(accepted, lambda near: with_records(near, accepted, now), shop.folder("papers")),
        shop.changed("categories", words, lambda near: store.add_new(near, words, "category"), "category"),
        shop.changed("links", touched, lambda near: store.replace_links(near, new_links, batch=touched), "paper_id", ("category",)),
        accepted, known,
    )


def placed(texts: DataFrame) -> DataFrame:
    """value of a text source, and the file and the place of the split that each line is from."""
    return texts.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))


def with_ordinals(texts: DataFrame) -> DataFrame:
    """(value, ordinal) of a text source, or of placed() lines: numbered in the order of files by name, and in file order.

    Numbers are dense: the lines of each split are counted first, and only one count per split goes through one task.
    """
    lines = texts if "_file" in texts.columns else placed(texts)
    marked = lines.withColumn("_mono", F.monotonically_increasing_id())
    sizes = marked.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_base"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_file", "_start", "_base", before.alias("_before"))
    return marked.join(starts, ["_file", "_start"]).select("value", (F.col("_mono") - F.col("_base") + F.col("_before")).alias("ordinal"))


def waves(spark: SparkSession, path: str, first: int = 4) -> Iterator[DataFrame]:
    """(value, ordinal) of the files of a folder by name, a few files at a time and twice as many each time, for a reader that stops early."""
    files, base, at = sorted(spark.read.text(path).inputFiles()), 0, 0
    while at < len(files):
        part = with_ordinals(spark.read.text(files[at : at + first]))
        yield part.withColumn("ordinal", F.col("ordinal") + base)
        at, first = at + first, first * 2
        if at < len(files):
            base += part.count()


def first_new_of_files(spark: SparkSession, path: str, existing: DataFrame, limit: int, first: int = 4) -> list[DataFrame]:
    """The first so many new records of a folder in file order, in parts, one for each wave of files that was read; later files are not opened."""
    found: list[DataFrame] = []
    for lines in waves(spark, path, first):
        one = records(lines)
        for earlier in (existing, *found):
            one = one.join(earlier.select("id"), "id", "left_anti")
        part = written(one.orderBy("ordinal").limit(limit), "first-new")
        found.append(part)
        limit -= part.count()
        if limit <= 0:
            break
    return found
