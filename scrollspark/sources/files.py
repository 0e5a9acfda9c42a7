"""Readers of lines, binary files, tables and databases."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrollspark.functions import parsing
from scrollspark.operators.ingest import with_ordinals


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value) of a text source; splits are read in parallel."""
    return spark.read.text(path)


def numbered_lines(spark: SparkSession, path: str, max_records: int | None = None) -> DataFrame:
    """(value, ordinal); max_records caps the lines read, blank and bad ones included."""
    out = with_ordinals(spark.read.text(path))
    return out if max_records is None else out.where(F.col("ordinal") < max_records)


def pdf_files(spark: SparkSession, folder: str, limit: int | None = None, content: bool = True) -> DataFrame:
    """path, id, length[, content] of the folder's own *.pdf files; a limit counts files by path."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "false").load(folder)
    listing = found.select("path", parsing.id_of_file(F.col("path")).alias("id"), "length", *(["content"] if content else []))
    return listing.orderBy("path").limit(limit) if limit else listing


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def database_url(env: Mapping[str, str] = os.environ, password: str | None = None) -> str:
    """A PostgreSQL URL from SQLALCHEMY_URL, or DB_HOST, DB_PORT, DB_NAME, DB_USER and DB_PASSWORD."""
    if url := env.get("SQLALCHEMY_URL"):
        return url
    secret = env.get("DB_PASSWORD", "") if password is None else password
    user = quote(env.get("DB_USER", "postgres"), safe="") + (f":{quote(secret, safe='')}" if secret else "")
    host = env.get("DB_HOST", "")
    place = f"{host}:{env.get('DB_PORT', '5432')}" if host else ""
    return f"postgresql://{user}@{place}/{env.get('DB_NAME', 'papers')}"


def shown_url(url: str) -> str:
    """The URL without its password."""
    head, sep, rest = url.partition("://")
    credentials, at, place = rest.rpartition("@")
    user, colon, _ = credentials.partition(":")
    return f"{head}{sep}{user}{':***' if colon else ''}{at}{place}"


def _asked() -> str:
    from getpass import getpass

    return getpass("Password of the database: ")


def resolve_password(password_file: str | None = None, prompt: bool = False, env_var: str = "DB_PASSWORD") -> str:
    """The first answer of: the file named, the environment, a question where that is allowed."""
    answers = (
        lambda: password_file and Path(password_file).read_text().strip(),
        lambda: os.environ.get(env_var),
        lambda: prompt and _asked(),
    )
    return next(filter(None, (answer() for answer in answers)), "")


def jdbc_options(url: str) -> dict[str, str]:
    """A database URL as options of Spark's JDBC source: drivers take user and password beside the URL, not in it."""
    if url.startswith("jdbc:"):
        return {"url": url}
    scheme, _, rest = url.partition("://")
    credentials, _, place = rest.rpartition("@")
    user, _, password = credentials.partition(":")
    options = {"url": f"jdbc:{scheme.partition('+')[0]}://{place}", "user": unquote(user), "password": unquote(password)}
    return {name: value for name, value in options.items() if value}


def jdbc(spark: SparkSession, url: str, name: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8) -> DataFrame:
    """A database table; split by a numeric key where one is given, whose bounds the database is asked for unless given.

    Needs the database's driver on the class path; names are quoted as in standard SQL.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(url)).option("fetchsize", "1000")
    if key and not bounds:
        quoted = '"' + key.replace('"', '""') + '"'
        bounds = tuple(reader.option("dbtable", f"(SELECT MIN({quoted}) AS a, MAX({quoted}) AS b FROM {name}) bounds").load().first())
    if key and None not in bounds:
        # Rows beyond the bounds and rows without a key are in the outer parts.
        reader = reader.option("partitionColumn", key).option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1] + 1)).option("numPartitions", str(partitions))
    return reader.option("dbtable", name).load()


def to_jdbc(df: DataFrame, url: str, name: str, mode: str = "append", partitions: int = 8) -> None:
    """Writes rows to a database table over at most so many connections.  A task that runs again may write rows twice: give the table a key."""
    df.coalesce(partitions).write.format("jdbc").options(**jdbc_options(url)).option("dbtable", name).option("batchsize", "2000").mode(mode).save()
