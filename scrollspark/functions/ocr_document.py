"""Nested OCR documents: extraction, captions, scrubbing."""

from __future__ import annotations

import json
import textwrap

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrollspark.functions.parsing import strip

BOX = "struct<label: string, content: string, text: string, score: string, coordinate: array<double>>"
PAGE = f"struct<page_index: int, dpi: int, layout_det_res: struct<boxes: array<{BOX}>>>"
DOCUMENT = f"struct<results: array<{PAGE}>, total_pages: int, processed_pages: int>"
DEFAULT_DPI = 200

# Red, green and blue of layout labels.
COLOURS = {
    "doc_title": (220, 53, 69),
    "header": (40, 167, 69),
    "footer": (0, 123, 255),
    "text": (255, 152, 0),
    "paragraph": (255, 152, 0),
    "aside_text": (156, 39, 176),
    "table": (0, 188, 212),
    "figure": (233, 30, 99),
    "figure_caption": (121, 85, 72),
    "table_caption": (0, 150, 136),
    "equation": (255, 235, 59),
    "list": (139, 195, 74),
    "code": (96, 125, 139),
    "reference": (63, 81, 181),
}
DEFAULT_COLOUR = (128, 128, 128)
# Keys that hold images, the depth of the scrub and its mark, and the rows from which a list of lists is an image.
IMAGE_KEYS = ("input_img", "img", "image", "visualization", "vis_img", "preprocessed_img")
MAX_DEPTH, DEPTH_MARK, IMAGE_ROWS = 50, "<max_depth_reached>", 100


def box_text(box: Column) -> Column:
    """content, or text where content is empty; stripped; null where both are empty."""
    chosen = F.when(F.coalesce(box["content"], F.lit("")) != "", box["content"]).otherwise(box["text"])
    return F.when(F.coalesce(chosen, F.lit("")) != "", strip(chosen))


def ordered_boxes(boxes: Column) -> Column:
    """Boxes by their upper edge (missing: 0), equal ones in their given order."""
    keyed = F.transform(F.coalesce(boxes, F.array().cast(f"array<{BOX}>")), lambda b, i: F.struct(F.coalesce(F.get(b["coordinate"], F.lit(1)), F.lit(0.0)).alias("y"), i.alias("i"), b.alias("box")))
    return F.transform(F.array_sort(keyed, lambda a, b: F.when(a["y"] < b["y"], -1).when(a["y"] > b["y"], 1).otherwise(a["i"] - b["i"])), lambda x: x["box"])


def document_text(document: Column) -> Column:
    """All texts of all pages in reading order, one per line."""
    pages = F.transform(document["results"], lambda p: F.filter(F.transform(ordered_boxes(p["layout_det_res"]["boxes"]), box_text), lambda x: x.isNotNull()))
    return F.array_join(F.flatten(pages), "\n")


def colour(label: Column) -> Column:
    table = F.create_map(*(F.lit(x) for name, rgb in COLOURS.items() for x in (name, hex_colour(rgb))))
    return F.coalesce(F.try_element_at(table, F.lower(label)), F.lit(hex_colour(DEFAULT_COLOUR)))


def hex_colour(rgb: tuple[int, int, int]) -> str:
    return "#{:02x}{:02x}{:02x}".format(*rgb)


def caption(index: Column, label: Column, score: Column | None = None) -> Column:
    """1-based index and label, with the score if there is one."""
    name = F.coalesce(label, F.lit("unknown"))
    start = F.concat((index + 1).cast("string"), F.lit(". "), name)
    return start if score is None else F.concat(start, F.lit(" ("), F.format_string("%.2f", F.coalesce(score.try_cast("double"), F.lit(0.0))), F.lit(")"))


def drawable(box: Column) -> Column:
    return F.size(F.coalesce(box["coordinate"], F.array().cast("array<double>"))) >= 4


def page_of(document: Column, index: int) -> Column:
    """The page with this page_index, wherever it stands; null if it is missing."""
    return F.get(F.filter(document["results"], lambda p: p["page_index"] == index), F.lit(0))


def drawn_boxes(documents: DataFrame, key: str, document: str = "document") -> DataFrame:
    """key, page_index, colour, caption and coordinate of every box that can be drawn; boxes keep their numbers."""
    pages = documents.select(key, F.explode(F.col(document)["results"]).alias("p"))
    boxes = pages.select(key, F.col("p")["page_index"].alias("page_index"), F.posexplode(F.col("p")["layout_det_res"]["boxes"]).alias("i", "b")).where(drawable(F.col("b")))
    return boxes.select(key, "page_index", colour(F.coalesce(F.col("b")["label"], F.lit("unknown"))).alias("colour"), caption(F.col("i"), F.col("b")["label"], F.col("b")["score"]).alias("caption"), F.col("b")["coordinate"].alias("coordinate"))


def dpi_of(document: Column, wanted: int | None = None) -> Column:
    return F.lit(wanted) if wanted else F.coalesce(F.get(document["results"], F.lit(0))["dpi"], F.lit(DEFAULT_DPI))


def scrub(value, depth: int = 0):
    """Without image keys, images as lists of lists, and nulls; deeper levels are replaced by a mark."""
    if depth > MAX_DEPTH:
        return DEPTH_MARK
    if isinstance(value, dict):
        found = {k: scrub(v, depth + 1) for k, v in value.items() if k not in IMAGE_KEYS}
        return {k: v for k, v in found.items() if v is not None}
    if isinstance(value, list):
        if len(value) > IMAGE_ROWS and isinstance(value[0], list):
            return None
        return [x for x in (scrub(v, depth + 1) for v in value) if x is not None]
    return value


@F.pandas_udf(T.StringType())
def scrubbed_json(text: pd.Series) -> pd.Series:
    """JSON text without what scrub() drops; text that is not JSON is null.  Documents have no schema, so this is Python."""

    def one(x: str | None) -> str | None:
        try:
            return None if x is None else json.dumps(scrub(json.loads(x)), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            return None

    return text.map(one)


def wrapped(text: str, panel_width: int = 600, font_size: int = 16, max_lines: int = 8) -> list[str]:
    """Lines of a text panel; what does not fit ends in dots."""
    width = max(1, (panel_width - 50) // max(1, font_size // 2))
    lines = textwrap.wrap(text, width) or []
    return lines if len(lines) <= max_lines else [*lines[:max_lines], "..."]
