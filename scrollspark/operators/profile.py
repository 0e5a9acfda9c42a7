"""Profile of a metadata snapshot: articles per year, versions per article, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrollspark.functions import parsing

THRESHOLD = 0.001
# JSON values of "versions" that count as missing.
FALSY = ("null", "0", "0.0", "false", '""', "[]", "{}")


def articles(lines: DataFrame, line: str = "value") -> DataFrame:
    """(ok, year, n_versions) of each line that is counted or an error; lines without versions are left out.

    An error is a line that is no JSON object, or whose first version has no date in the HTTP form.
    """
    text = F.col(line)
    raw = F.get_json_object(text, "$.versions")
    versions = parsing.versions_of(raw)
    created = F.try_element_at(versions, F.lit(1))["created"]
    parts = lines.select(parsing.is_object(text).alias("object"), raw.alias("raw"), F.year(parsing.http_timestamp(created)).alias("year"), F.size(versions).alias("n"))
    ignored = F.col("object") & (F.col("raw").isNull() | (F.col("raw") == "") | F.col("raw").isin(*FALSY))
    ok = F.col("object") & F.col("year").isNotNull()
    return parts.where(~ignored).select(ok.alias("ok"), F.when(ok, F.col("year")).alias("year"), F.when(ok, F.col("n").cast("bigint")).alias("n_versions"))


def year_histogram(found: DataFrame) -> DataFrame:
    return found.where("ok").groupBy("year").agg(F.count(F.lit(1)).alias("articles"))


def version_histogram(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """n_versions, articles, kept (more than the threshold's share), pct of all articles.

    The total is one row, joined to at most a few hundred histogram rows.
    """
    counts = found.where("ok").groupBy("n_versions").agg(F.count(F.lit(1)).alias("articles"))
    total = counts.agg(F.sum("articles").alias("total"))
    both = counts.join(F.broadcast(total))
    return both.select("n_versions", "articles", (F.col("articles") > F.col("total") * threshold).alias("kept"), F.round(parsing.percentage(F.col("articles"), F.col("total")), 4).alias("pct"))


def summary(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """total, min_year, max_year, peak_year (ties: earliest), max_versions and multi_version of what the threshold keeps; nulls for an empty snapshot."""
    years = year_histogram(found).agg(
        F.sum("articles").alias("total"), F.min("year").alias("min_year"), F.max("year").alias("max_year"), F.max_by("year", F.struct("articles", -F.col("year"))).alias("peak_year")
    )
    kept = version_histogram(found, threshold).where("kept")
    versions = kept.agg(F.max("n_versions").alias("max_versions"), F.sum(F.when(F.col("n_versions") > 1, F.col("articles"))).alias("multi_version"))
    return years.join(F.broadcast(versions))  # one row each


def last_years(histogram: DataFrame, n: int = 10) -> DataFrame:
    """The last n years that are present, in order."""
    return histogram.orderBy(F.desc("year")).limit(n).orderBy("year")
