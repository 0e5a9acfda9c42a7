"""Exact deduplication by 128-bit content hash, built from DataFrame functions only.

Texts are equal when they are identical after lower-casing A-Z; null is the
empty text.  The steps:

1.  One pass over the texts writes each row's id and SHA-256, whose first 128 bits
    are the content hash, and a fast 64-bit mark of the text as it is.
2.  Rows are grouped by content hash: the id that stays and the size.  Only numbers and
    hashes are shuffled; partial aggregation collapses a large group of copies inside
    each map task.
3.  Bytes are compared inside groups of more than one row.  Their marks set bits
    in a bitmap of fixed size (2 MB), by which a second pass over the texts passes on little
    more than the rows of such groups; their distinct (hash, text) pairs are counted.
4.  Groups whose texts differ are grouped again by the text itself.  With the
    default hash there are none; ``content_hash`` takes another one.
5.  Groups are joined back to the written rows by content hash.  Both inputs of the join
    are plain shuffles, so that a key with a third of all rows is split at run time.

Edge cases: an empty table gives no rows; null ids never stay unless the whole
group has only null ids, and then keep_id is null; rows that repeat an id with
the same text are one document and share its verdict in ``decisions``, and one of them, the first as JSON text, stays in ``deduplicated``;
rows that share an id but not a text each go with their own text; extra columns, whatever
their names, pass through ``deduplicated`` and are ignored by ``decisions``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrollspark.llm.tables import path_of, removed, written

#: A-Z, lower-cased alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITMAP_BITS = 1 << 24  # beyond about as many repeated texts the bitmap holds back no text, and results are the same

Hash = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    """Lower-cases A-Z only; ASCII texts take the faster built-in, which does the same there."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def first_128_bits(digest: Column) -> Column:
    return F.substring(digest, 1, 16)


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def mark_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _hashed(texts: DataFrame, content_hash: Hash | None) -> DataFrame:
    """Written: _id, _key, _digest, _mark of every row."""
    text = normalised(F.col("_raw"))
    own = [] if content_hash is None else [content_hash(text).alias("_key")]
    table = written(texts.select("_id", _digest(text).alias("_digest"), mark_of(F.col("_raw")).alias("_mark"), *own), "exact-hashes")
    return table.withColumn("_key", first_128_bits(F.col("_digest"))) if content_hash is None else table


def _order(keep: str) -> Column:
    """Of these the largest or smallest belongs to the id that stays; ids come before nulls."""
    ident = F.col("_id")
    return F.struct((ident.isNull() if keep == "min" else ident.isNotNull()).alias("known"), ident.alias("id"))


#: Of _bitmap, the bit at _place.
BIT_IS_SET = "shiftright(cast(conv(hex(substring(_bitmap, cast(_place div 8 as int) + 1, 1)), 16, 10) as int), cast(_place % 8 as int)) & 1 = 1"


def _texts_to_compare(texts: DataFrame, hashed: DataFrame, groups: DataFrame, content_hash: Hash | None) -> DataFrame:
    """_id, _mark, _text, _key of all rows whose hash others have too, and of the few others whose mark's bit is set."""
    repeated = hashed.join(groups.where("_size > 1").select("_key"), "_key", "left_semi")
    bit = F.col("_mark").bitwiseAND(F.lit(BITMAP_BITS - 1))  # never null, so no filter computes it again
    bits = repeated.select(F.bitmap_bucket_number(bit).alias("_bucket"), F.bitmap_bit_position(bit).alias("_place"))
    bitmaps = written(bits.groupBy("_bucket").agg(F.bitmap_construct_agg("_place").alias("_bitmap")), "exact-bitmaps")
    rows = texts.withColumn("_mark", mark_of(F.col("_raw"))).withColumn("_bucket", F.bitmap_bucket_number(bit)).withColumn("_place", F.bitmap_bit_position(bit))
    # All bitmaps together have BITMAP_BITS bits at most.
    rows = rows.join(F.broadcast(bitmaps), "_bucket").where(BIT_IS_SET).select("_id", "_mark", normalised(F.col("_raw")).alias("_text"))
    return rows.withColumn("_key", first_128_bits(_digest(F.col("_text"))) if content_hash is None else content_hash(F.col("_text")))


def _best_of(rows: DataFrame, keep: str, *key: str) -> DataFrame:
    """Of each key the id and mark that stay, how many rows have both, and the size."""
    pick = {"min": F.min, "max": F.max}[keep]
    alike = rows.groupBy(*key, "_id", "_mark").agg(F.count(F.lit(1)).alias("_copies"))
    best = pick(F.struct(_order(keep).alias("order"), "_mark", "_copies")).alias("_best")
    return alike.groupBy(*key).agg(best, F.sum("_copies").alias("_size")).select(*key, F.col("_best.order.id").alias("_keep"), "_best._mark", "_best._copies", "_size")


def _groups(texts: DataFrame, keep: str, content_hash: Hash | None, copies: bool) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame]:
    """Hashes of all rows; groups by _key; keys whose texts differ, or None; and the texts of repeated keys.

    copies: groups say which mark stays, and how many rows have its id and mark.
    """
    pick = {"min": F.min, "max": F.max}[keep]
    hashed = _hashed(texts, content_hash)
    if copies:
        groups = _best_of(hashed, keep, "_key")
    else:
        groups = hashed.groupBy("_key").agg(pick("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
    groups = written(groups, "exact-groups")
    compared = _texts_to_compare(texts, hashed, groups, content_hash)
    mixed = written(compared.select("_key", "_text").distinct().groupBy("_key").agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1").select("_key"), "exact-collisions")
    return hashed, groups, None if mixed.isEmpty() else mixed, compared


def _by_text(compared: DataFrame, mixed: DataFrame, keep: str) -> tuple[DataFrame, DataFrame]:
    """Rows of keys whose texts differ, and their groups by key and text."""
    rows = compared.join(mixed, "_key", "left_semi")
    return rows, written(_best_of(rows, keep, "_key", "_text"), "exact-by-text")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", content_hash: Hash | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    keep: "min" or "max", the id that stays of each group of equal texts.
    content_hash: of a text, instead of the first 128 bits of its SHA-256.
    """
    hashed, groups, mixed, compared = _groups(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_raw")), keep, content_hash, copies=False)
    if mixed is not None:
        rows, texts = _by_text(compared, mixed, keep)
        apart = rows.join(texts, ["_key", "_text"]).select("_id", "_keep", "_size", _digest(F.col("_text")).alias("_digest"))
        hashed = hashed.join(mixed, "_key", "left_anti")
    found = hashed.join(groups.select("_key", "_keep", "_size"), "_key").select("_id", "_keep", "_size", "_digest")
    found = found if mixed is None else found.union(apart)
    return found.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", content_hash: Hash | None = None) -> DataFrame:
    """One row of each group of equal texts, with all its columns; of rows that share id and text, one."""
    named = docs.select(F.struct("*").alias("_row"))
    ident, text = F.col(f"_row.`{id_col}`"), F.col(f"_row.`{text_col}`")
    hashed, groups, mixed, compared = _groups(named.select(ident.alias("_id"), text.alias("_raw")), keep, content_hash, copies=True)
    if mixed is not None:
        texts = _by_text(compared, mixed, keep)[1]
        groups = groups.join(mixed, "_key", "left_anti")
    columns = ("_keep", F.col("_mark").alias("_staying"), "_copies")
    staying = groups.select(*columns)
    staying = written(staying if mixed is None else staying.union(texts.select(*columns)), "exact-kept")
    removed(docs.sparkSession, path_of(hashed))
    rows = named.withColumn("_id", ident).withColumn("_mark", mark_of(text))
    same = F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_mark") == F.col("_staying"))
    found = rows.join(staying.hint("merge"), same).select("_row", "_id", "_mark", "_copies")
    # Rows that share id and text are few in tables of documents; only they are grouped.
    once = found.where("_copies = 1").select("_row.*")
    again = found.where("_copies > 1").groupBy("_id", "_mark").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row.*")
    return once.union(again)
