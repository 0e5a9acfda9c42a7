"""Parsing of metadata records, dates, identifiers and names, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The metadata record's JSON keys and the columns they become.
RECORD_KEYS = {
    "id": "id",
    "submitter": "submitter",
    "authors": "authors",
    "authors_parsed": "authors_parsed",
    "title": "title",
    "abstract": "abstract",
    "comments": "comments",
    "journal-ref": "journal_ref",
    "doi": "doi",
    "report-no": "report_no",
    "categories": "categories",
    "license": "license",
    "versions": "versions",
    "update_date": "update_date",
}
# What Python's str.split() and str.strip() take for white space beyond Java's \s.
SPACE = r"(?U)[\s\x1c-\x1f]"
NOT_SPACE = r"(?U)[^\s\x1c-\x1f]+"
HTTP_DATE = r"^(?i)(?:mon|tue|wed|thu|fri|sat|sun),\s+(\d{1,2}\s+[a-z]{3}\s+\d{4}\s+\d{1,2}:\d{1,2}:\d{1,2})\s+(?:gmt|utc)$"
SAFE_ID = r"^(?!\.{1,2}(/|$))[A-Za-z0-9._-]+(/(?!\.{1,2}$)[A-Za-z0-9._-]+)?$"

VERSIONS = T.ArrayType(T.StructType([T.StructField("version", T.StringType()), T.StructField("created", T.StringType())]))
NESTED = {"authors_parsed": T.ArrayType(T.ArrayType(T.StringType())), "versions": T.StringType()}
RECORD = T.StructType([*(T.StructField(k, NESTED.get(k, T.StringType())) for k in RECORD_KEYS), T.StructField("_corrupt", T.StringType())])


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def words(text: Column) -> Column:
    """Non-empty pieces between white space; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda x: x != "")


def word_count(text: Column) -> Column:
    """As many as words() has, without making them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_SPACE))


def is_object(line: Column) -> Column:
    """Whether a line is a JSON object (arrays and scalars parse, but are not records)."""
    return F.coalesce(F.ltrim(line).startswith("{") & F.try_parse_json(line).isNotNull(), F.lit(False))


def record(line: Column) -> Column:
    """A metadata record as a struct; null where the line is not a JSON object.

    versions stays JSON text of any type.
    """
    return F.when(is_object(line), F.from_json(line, RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))


def versions_of(json_text: Column) -> Column:
    """The versions array; null where the JSON is something else."""
    return F.from_json(json_text, VERSIONS)


def record_columns(rec: Column, empty_arrays: bool = False) -> list[Column]:
    """The record's fields as table columns: renamed keys, empty title by default, arrays null or empty."""
    out = []
    for key, name in RECORD_KEYS.items():
        value = rec.getField(key)
        if name == "title":
            value = F.coalesce(value, F.lit(""))
        elif name == "update_date":
            value = date_of(value)
        elif name == "authors_parsed" and empty_arrays:
            value = F.coalesce(value, F.array().cast("array<array<string>>"))
        elif name == "versions":
            value = versions_of(value)
            if empty_arrays:
                value = F.coalesce(value, F.array().cast(VERSIONS))
        out.append(value.alias(name))
    return out


def date_of(text: Column) -> Column:
    """Dates like 2008-01-02 or 2008-1-2; anything else is null."""
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-M-d")))


def http_timestamp(text: Column) -> Column:
    """Dates like "Mon, 2 Apr 2007 19:18:42 GMT": any weekday, any case, GMT or UTC; anything else is null."""
    inner = F.regexp_replace(F.regexp_extract(text, HTTP_DATE, 1), r"\s+", " ")
    return F.try_to_timestamp(F.nullif(inner, F.lit("")), F.lit("d MMM yyyy H:m:s"))


def http_date(when: Column) -> Column:
    return F.concat(F.date_format(when, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def normal_id(raw: Column) -> Column:
    """The trimmed id with forward slashes; null where it is unsafe as a path."""
    value = F.replace(strip(raw), F.lit("\\"), F.lit("/"))
    return F.when(value.rlike(SAFE_ID), value)


def id_problem(raw: Column) -> Column:
    """Why an id is rejected; null if it is not."""
    value = F.replace(strip(raw), F.lit("\\"), F.lit("/"))
    return (
        F.when(raw.isNull() | (value == ""), "empty")
        .when(value.contains("\0"), "NUL character")
        .when(value.startswith("/"), "absolute")
        .when(value.startswith("~"), "home folder")
        .when(F.size(F.split(value, "/")) > 2, "too many segments")
        .when(value.rlike(r"(^|/)(\.{0,2})(/|$)"), "empty or relative segment")
        .when(~value.rlike(SAFE_ID), "unsafe character")
    )


def file_name(ident: Column) -> Column:
    return F.concat(F.replace(ident, F.lit("/"), F.lit("__")), F.lit(".pdf"))


def id_of_file(path: Column) -> Column:
    """The id whose file name this is: the stem, with the slash put back."""
    return F.replace(F.regexp_extract(path, r"([^/]+)[.]pdf$", 1), F.lit("__"), F.lit("/"))


def path_under(base: str, ident: Column) -> Column:
    return F.concat_ws("/", F.lit(base.rstrip("/")), file_name(normal_id(ident)))


def url_of(base: str, ident: Column) -> Column:
    return F.concat(F.lit(f"{base.rstrip('/')}/"), ident, F.lit(".pdf"))


def truthy(value: Column) -> Column:
    """Python's truth of a text."""
    return value.isNotNull() & (value != "")


def prefix(text: Column, n: int, one_line: bool = False) -> Column:
    cut = F.substring(text, 1, n)
    return F.replace(cut, F.lit("\n"), F.lit(" ")) if one_line else cut


def percentage(part: Column, whole: Column) -> Column:
    return part / whole * F.lit(100.0)
