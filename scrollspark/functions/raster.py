"""Pictures without a drawing library: pages with boxes, histograms, and PNG files.

Letters are not drawn.  A picture's texts go into the PNG as text entries, one for each
box or bar, in the order of the colours that mark them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrollspark.functions import ocr_document

WHITE, INK = (255, 255, 255), (33, 37, 41)
PANEL, ROW, GAP = 120, 16, 10


def canvas(width: int, height: int) -> np.ndarray:
    return np.full((height, width, 3), WHITE, np.uint8)


def filled(picture: np.ndarray, box: Sequence[float], colour: Sequence[int]) -> None:
    """Fills x0, y0, x1, y1; what lies outside is cut off."""
    x0, y0, x1, y1 = (max(0, int(round(v))) for v in (min(box[0], box[2]), min(box[1], box[3]), max(box[0], box[2]), max(box[1], box[3])))
    picture[y0:y1, x0:x1] = colour


def outlined(picture: np.ndarray, box: Sequence[float], colour: Sequence[int], width: int = 3) -> None:
    x0, y0, x1, y1 = box
    for edge in ((x0, y0, x1, y0 + width), (x0, y1 - width, x1, y1), (x0, y0, x0 + width, y1), (x1 - width, y0, x1, y1)):
        filled(picture, edge, colour)


def beside(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Two pictures side by side, the lower one filled up with white."""
    out = canvas(left.shape[1] + right.shape[1], max(left.shape[0], right.shape[0]))
    out[: left.shape[0], : left.shape[1]] = left
    out[: right.shape[0], left.shape[1] :] = right
    return out


def png(picture: np.ndarray, texts: Sequence[str] = ()) -> bytes:
    """An 8-bit RGB file; texts as international text entries with the key Comment."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    height, width = picture.shape[:2]
    rows = np.concatenate([np.zeros((height, 1), np.uint8), picture.reshape(height, -1)], axis=1)
    entries = b"".join(chunk(b"iTXt", b"Comment\0\0\0\0\0" + t.encode()) for t in texts)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + entries + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def rgb(text: str) -> tuple[int, int, int]:
    return tuple(bytes.fromhex(text.removeprefix("#")))  # type: ignore[return-value]


def page_picture(width: int, height: int, boxes: Sequence[tuple[str, str, Sequence[float]]]) -> bytes:
    """A page with the outlines of its boxes (colour, caption, coordinate), and a panel with a mark for each."""
    page, panel = canvas(width, height), canvas(PANEL, max(height, ROW * len(boxes)))
    for k, (colour, _, place) in enumerate(boxes):
        outlined(page, place, rgb(colour))
        filled(panel, (GAP, ROW * k + 2, PANEL - GAP, ROW * (k + 1) - 2), rgb(colour))
    return png(beside(page, panel), [caption for _, caption, _ in boxes])


def histogram(bars: Mapping[object, float], width: int = 640, height: int = 400) -> tuple[np.ndarray, list[str]]:
    """A bar for each entry, in order, and a text for each."""
    picture = canvas(width, height)
    top, step = max(bars.values(), default=1) or 1, (width - 2 * GAP) / max(1, len(bars))
    for k, value in enumerate(bars.values()):
        filled(picture, (GAP + step * k + 1, height - GAP - (height - 2 * GAP) * value / top, GAP + step * (k + 1) - 1, height - GAP), INK)
    return picture, [f"{name}: {value}" for name, value in bars.items()]


def report(years: Mapping[int, int], versions: Mapping[int, int]) -> bytes:
    """The two histograms of a profile, side by side.  Both have as many bars as there are years and kept numbers of versions."""
    (left, a), (right, b) = histogram(years), histogram(versions)
    return png(beside(left, right), [*a, *b])


def page_pictures(documents: DataFrame, key: str, document: str = "document", width: int = 1700, height: int = 2200) -> DataFrame:
    """key, page_index, png of every page that has boxes to draw."""
    boxes = ocr_document.drawn_boxes(documents, key, document)
    pages = boxes.groupBy(key, "page_index").agg(F.sort_array(F.collect_list(F.struct("caption", "colour", "coordinate"))).alias("boxes"))
    kind = documents.schema[key].dataType.simpleString()

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pictures = [page_picture(width, height, [(b["colour"], b["caption"], b["coordinate"]) for b in found]) for found in batch["boxes"]]
            yield pd.DataFrame({key: batch[key], "page_index": batch["page_index"], "png": pictures})

    return pages.mapInPandas(draw, f"`{key}` {kind}, page_index int, png binary")
