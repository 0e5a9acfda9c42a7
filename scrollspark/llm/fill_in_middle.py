"""Fill-in-middle: a text is cut at two code points, and its middle goes to the end.

``<P>`` stands before the prefix, ``<S>`` before the suffix, ``<M>`` before the middle.  What happens to a row
follows from the SHA-256 of ``seed:id``: its first two groups of eight hex digits choose the cuts, the third whether
the row is changed at all, the fourth the order of the parts (prefix first or suffix first).

Where a code point begins is found by a sparse checkpoint index: while the code points of the texts are counted,
in blocks of ``CHECK_BYTES`` bytes of each text, every block leaves a checkpoint (its first byte, and the
code points before it).  A cut is found by a binary search over the text's checkpoints and a second look at one block.

Edge cases: null texts are empty, empty texts stay as they are; so do texts that hold one of the three marks, so that every output can be read
back; ids are drawn by their decimal text, null ids by the empty one; rows that are there several times have the same
result; texts of any length are whole; other columns, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrollspark.llm.bytesops import slices, tidied, utf8

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
CHECK_BYTES = 1024
SLICE = 1 << 20


class Checkpoints:
    """Byte and code-point offsets at every CHECK_BYTES-th byte of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.leads = data & 0xC0 != 0x80
        self.offsets = offsets
        size = -(-np.diff(offsets) // CHECK_BYTES)
        self.first = np.concatenate([[0], np.cumsum(size)])  # of each text its first checkpoint
        own = np.arange(self.first[-1]) - np.repeat(self.first[:-1], size)
        self.bytes = np.repeat(offsets[:-1], size) + own * CHECK_BYTES
        counts = np.add.reduceat(self.leads, self.bytes, dtype=np.int64) if len(self.bytes) else np.zeros(0, np.int64)
        before = np.concatenate([[0], np.cumsum(counts)])
        self.lengths = before[self.first[1:]] - before[self.first[:-1]]  # code points of each text
        self.points = before[:-1] - np.repeat(before[self.first[:-1]], size)

    def byte_of(self, text: int, point: int) -> int:
        """Where in the text its code point begins, in bytes; the text's end for the point after the last."""
        base, end = int(self.offsets[text]), int(self.offsets[text + 1])
        if point >= self.lengths[text]:
            return end - base
        a, b = self.first[text], self.first[text + 1]
        at = a + int(np.searchsorted(self.points[a:b], point, "right")) - 1
        start = int(self.bytes[at])
        block = self.leads[start : min(start + CHECK_BYTES, end)]
        return start + int(np.flatnonzero(block)[point - int(self.points[at])]) - base


def drawn(seed: str, ident: str) -> tuple[int, ...]:
    """The first four groups of eight hex digits of the digest."""
    digest = hashlib.sha256(f"{seed}:{ident}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def arranged(text: bytes, points: int, draw: tuple[int, ...], byte_of, plain_from: int, spm_below: int) -> tuple[str, int | None, int | None, bytes]:
    """Form, prefix and middle characters, and the output."""
    if not text or draw[2] % 100 >= plain_from or any(mark.encode() in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return PLAIN, None, None, text
    low, high = sorted((draw[0] % (points + 1), draw[1] % (points + 1)))
    a, b = byte_of(low), byte_of(high)
    parts = {PREFIX: text[:a], MIDDLE: text[a:b], SUFFIX: text[b:]}
    form, order = (SPM, (SUFFIX, PREFIX, MIDDLE)) if draw[3] % 100 < spm_below else (PSM, (PREFIX, SUFFIX, MIDDLE))
    return form, low, high - low, b"".join(mark.encode() + parts[mark] for mark in order)


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: str = "1", plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """id, n (code points), form, prefix_chars, middle_chars and output of every row.

    Of a hundred rows plain_from are changed, and of a hundred changed rows spm_below have their suffix first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, SLICE):
                part = offsets[a : b + 1]
                body = data[part[0] : part[-1]]
                found, raw = Checkpoints(body, part - part[0]), body.tobytes()
                cuts, rows = (part - part[0]).tolist(), []
                for i, (ident, n) in enumerate(zip(batch.column(2).slice(a, b - a).to_pylist(), found.lengths.tolist(), strict=True)):
                    rows.append((n, *arranged(raw[cuts[i] : cuts[i + 1]], n, drawn(seed, ident), lambda p, i=i: found.byte_of(i, p), plain_from, spm_below)))
                n, form, prefix, middle, output = zip(*rows, strict=True)
                columns = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], ["_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    ident, text = F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(ident.alias("_id"), text.alias("_text"), F.coalesce(ident.cast("string"), F.lit("")).alias("_drawn"))
    kind = docs.schema[id_col].dataType.simpleString()
    made = rows.mapInArrow(tidied(run), f"_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return made.withColumnRenamed("_id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text, read back from an output and its form: no part holds a mark, so the first of each is where its part begins."""
    between = lambda a, b: F.substring_index(F.substring_index(F.substring(output, len(PREFIX) + 1, 1 << 30), a, b), MIDDLE, 1)
    second = lambda mark: F.substring_index(F.substring_index(output, mark, -1), MIDDLE, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(SUFFIX, 1), middle, second(SUFFIX))
    spm = F.concat(second(PREFIX), middle, between(PREFIX, 1))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
