"""Table schemas by migration level, and migrations as functions of DataFrames."""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrollspark.functions.ocr_document import DOCUMENT
from scrollspark.functions.parsing import VERSIONS

if TYPE_CHECKING:
    from scrollspark.operators.store import SnapshotStore

HEAD = 4
ID_LENGTH = 50

_TEXT, _NTZ = T.StringType(), T.TimestampNTZType()
#: Columns of papers by the level that brings them, with the default of existing rows.
LEVELS: dict[int, list[tuple[str, T.DataType | None, object]]] = {
    1: [
        ("id", _TEXT, None), ("submitter", _TEXT, None), ("authors", _TEXT, None), ("authors_parsed", T.ArrayType(T.ArrayType(_TEXT)), None),
        ("title", _TEXT, None), ("abstract", _TEXT, None), ("comments", _TEXT, None), ("journal_ref", _TEXT, None), ("doi", _TEXT, None),
        ("report_no", _TEXT, None), ("categories", _TEXT, None), ("license", _TEXT, None), ("versions", VERSIONS, None), ("update_date", T.DateType(), None),
        ("pdf_path", _TEXT, None), ("created_at", _NTZ, None), ("updated_at", _NTZ, None),
    ],
    2: [("pdf_downloaded", T.BooleanType(), False), ("pdf_download_attempted_at", _NTZ, None), ("pdf_download_error", _TEXT, None)],
    3: [("pdf_content", T.BinaryType(), None)],
    4: [("ocr_results", None, None), ("ocr_processed", T.BooleanType(), False), ("ocr_processed_at", _NTZ, None), ("ocr_error", _TEXT, None)],
}
CATEGORIES = T.StructType([T.StructField("category", _TEXT, False), T.StructField("label", _TEXT), T.StructField("created_at", _NTZ)])
LINKS = T.StructType([T.StructField("paper_id", _TEXT, False), T.StructField("category", _TEXT, False)])

#: Columns that a metadata upsert replaces; all others of an existing paper stay.
METADATA = [name for name, _, _ in LEVELS[1] if name not in ("id", "pdf_path", "created_at", "updated_at")]


def _type(name: str, kind: T.DataType | None) -> str:
    return DOCUMENT if name == "ocr_results" else kind.simpleString()


def papers_ddl(level: int = HEAD) -> str:
    return ", ".join(f"`{n}` {_type(n, k)}" for at in range(1, level + 1) for n, k, _ in LEVELS[at])


def migrate(papers: DataFrame, start: int, end: int) -> DataFrame:
    """Adds the columns of later levels with their defaults, or drops those of levels above end."""
    for level in range(start + 1, end + 1):
        papers = papers.withColumns({n: F.lit(d).cast(_type(n, k)) for n, k, d in LEVELS[level] if n not in papers.columns})
    for level in range(start, end, -1):
        papers = papers.drop(*(n for n, _, _ in LEVELS[level]))
    return papers


def too_long(papers: DataFrame, column: str = "id", length: int = ID_LENGTH) -> DataFrame:
    """Rows that the id's length rules out."""
    return papers.where(F.char_length(column) > length)


VERSION = "level int"
VERSION_TABLE = "schema_level"


def level_of(shop: SnapshotStore) -> int:
    """The migration level that a store's tables are at; 0 without tables."""
    if VERSION_TABLE in shop.tables():
        return shop.read(VERSION_TABLE).first()["level"]
    if "papers" not in shop.tables():
        return 0
    have = set(shop.read("papers").columns)
    return max(at for at in LEVELS if {n for n, _, _ in LEVELS[at]} <= have)


def run_migrations(shop: SnapshotStore, target: int = HEAD) -> list[int]:
    """Takes a store up or down to a level, one publication a level, and returns the levels it went through.

    Level 1 makes the three tables; below it there are none, so down is possible to level 1 only.
    """
    if not 1 <= target <= HEAD:
        raise ValueError(f"no level {target}")
    spark, passed, at = shop.spark, [], level_of(shop)
    while at != target:
        after = at + 1 if at < target else at - 1
        mark = spark.createDataFrame([(after,)], VERSION)
        if at == 0:
            empty = {"papers": papers_ddl(1), "categories": CATEGORIES, "links": LINKS}
            shop.publish(**{name: spark.createDataFrame([], kind) for name, kind in empty.items()}, **{VERSION_TABLE: mark})
        else:
            shop.publish(papers=migrate(shop.read("papers"), at, after), **{VERSION_TABLE: mark})
        passed.append(after)
        at = after
    return passed


def violations(papers: DataFrame, categories: DataFrame, links: DataFrame) -> DataFrame:
    """constraint, rows: how many rows break each key and reference that the tables declare."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("constraint"), "rows")
    repeated = lambda df, *key: df.groupBy(*key).count().where("count > 1")
    checks = {
        "papers: id is null": papers.where("id IS NULL"),
        "papers: id is too long": too_long(papers),
        "papers: id is not unique": repeated(papers, "id"),
        "categories: category is null": categories.where("category IS NULL"),
        "categories: category is not unique": repeated(categories, "category"),
        "links: pair is not unique": repeated(links, "paper_id", "category"),
        "links: paper is missing": links.join(papers, links["paper_id"] == papers["id"], "left_anti"),
        "links: category is missing": links.join(categories, "category", "left_anti"),
    }
    return reduce(DataFrame.union, (count(df, name) for name, df in checks.items()))
