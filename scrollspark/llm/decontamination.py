"""Benchmark decontamination: an FM-index per shard of documents, searched for all windows of the test items.

Words are runs of digits, ASCII letters and characters beyond ASCII, with A-Z lower-cased.
A window is ``window`` consecutive words of an item; an item of fewer words, but not
none, is one window.  The steps:

1.  A block of items (about ``block_bytes`` of text) goes to the driver and, as arrays of
    numbered words and distinct windows, to the tasks of one pass.
2.  A task cuts its rows into shards of about ``shard_bytes`` of text.  A shard's words become
    symbols; a word that no item of the block has ends every match and is a
    separator, and so is a run of known words shorter than the shortest window.
3.  The shard's FM-index takes all windows at once: backward search through the ranks of the wavelet
    matrix, then occurrences are located by sampled suffix positions.  A place begins at most one window
    of each length, so what is located is linear in the shard.
4.  Occurrences are merged to removal spans, of words and of characters.

Documents are neither shuffled nor gathered.  With several blocks, every block is a pass, and the
passes' spans and items of a row are merged by its id and a 64-bit hash of its text.

Edge cases: null and empty texts have no words and no spans; items that are null, empty
or without words have no windows; texts of any length are whole; an item that is there several times
is named once, items without id have windows but are not named; rows that
are there several times come back as often; an empty table gives no rows, and without items no
document has spans; other columns, whatever their names, are ignored.  Words are told apart by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrollspark.llm.bytesops import IS_TERM, HashTable, groups, ranges, slices, tidied, utf8, word_hashes, word_spans
from scrollspark.llm.fm_index import FMIndex
from scrollspark.llm.item_blocks import BLOCK_BYTES, Terms, blocks

SHARD_BYTES = 4 << 20
SPAN = "struct<start: int, end: int, from_char: int, to_char: int>"
_FIELDS = ("start", "end", "from_char", "to_char")


class Windows:
    """Distinct windows of a block of items, by length, and the items that have each."""

    def __init__(self, block: pa.Table, window: int):
        words = Terms(block)
        self.hashes, self.items = words.hashes, words.items
        size = np.diff(words.first)
        self.patterns: list[np.ndarray] = []
        self.owners: list[tuple[np.ndarray, np.ndarray]] = []  # of the items of pattern k, numbers cut[k] to cut[k + 1]
        named = np.asarray(self.items.is_valid())
        for length in np.unique(np.minimum(size[size > 0], window)).tolist():
            rows = np.flatnonzero(size >= window) if length == window else np.flatnonzero(size == length)
            at, which = ranges(words.first[rows], words.first[rows + 1] - length + 1)
            found, inverse = np.unique(words.codes[at[:, None] + np.arange(length)], axis=0, return_inverse=True)
            pairs = np.unique(np.stack([inverse.reshape(-1), rows[which]], axis=1)[named[rows[which]]], axis=0)
            self.patterns.append(found)
            self.owners.append((np.searchsorted(pairs[:, 0], np.arange(len(found) + 1)), pairs[:, 1]))
        self.shortest = min((p.shape[1] for p in self.patterns), default=0)


def _sequence(codes: np.ndarray, first: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of a shard, a 0 after every run of known words of one document, and the word each is of; short runs are left out."""
    known = codes > 0
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    text_starts = first[:-1][first[:-1] < first[1:]]
    begins[text_starts] = known[text_starts]
    ends = known.copy()
    ends[:-1] &= ~known[1:]
    ends[text_starts[1:] - 1] = known[text_starts[1:] - 1]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = b - a >= shortest
    at, _ = ranges(a[long], b[long] + 1)  # one place more each, for the zero
    symbols = np.zeros(len(at), np.int64)
    inside = np.ones(len(at), bool)
    inside[np.cumsum(b[long] - a[long] + 1) - 1] = False
    symbols[inside] = codes[at[inside]]
    return symbols, at


class Shard:
    """The matches of a shard's texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, windows: Windows, table: HashTable):
        starts, ends, self.first = word_spans(data, offsets, IS_TERM)
        n = len(starts)
        self.spans = [np.zeros(0, np.int32)] * 4
        self.span_cut = np.zeros(len(offsets), np.int32)
        self.items: list[np.ndarray] = [np.zeros(0, np.int64)] * (len(offsets) - 1)
        if not windows.patterns or not n:
            return
        symbols, word_of = _sequence(table.lookup(word_hashes(data, starts, ends)) + 1, self.first, windows.shortest)
        if not len(symbols):
            return
        index = FMIndex(symbols, len(windows.hashes))
        edges, pairs = np.zeros(n + 1, np.int64), []
        for patterns, (cut, owners) in zip(windows.patterns, windows.owners, strict=True):
            low, high = index.search(patterns)
            hit = np.flatnonzero(high > low)
            rows, which = ranges(low[hit], high[hit])
            at = word_of[index.locate(rows)]
            np.add.at(edges, at, 1)
            np.add.at(edges, at + patterns.shape[1], -1)
            text = np.searchsorted(self.first, at, "right") - 1
            found = np.unique(text * len(patterns) + hit[which])
            pairs.append((found // len(patterns), found % len(patterns), cut, owners))
        self._spans(data, offsets, starts, ends, np.cumsum(edges[:-1]) > 0)
        for text, pattern, cut, owners in pairs:
            for a, b in zip(*groups(text), strict=True):
                named, _ = ranges(cut[pattern[a:b]], cut[pattern[a:b] + 1])
                self.items[text[a]] = np.union1d(self.items[text[a]], owners[named])

    def _spans(self, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray) -> None:
        """Runs of hit words of each text, as places among its words and among its characters."""
        if not hit.any():
            return
        text_starts = self.first[:-1][self.first[:-1] < self.first[1:]]
        begins = hit.copy()
        begins[1:] &= ~hit[:-1]
        begins[text_starts] = hit[text_starts]
        stops = hit.copy()
        stops[:-1] &= ~hit[1:]
        stops[text_starts[1:] - 1] = hit[text_starts[1:] - 1]
        a, b = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        text = np.searchsorted(self.first, a, "right") - 1
        characters = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data & 0xC0 != 0x80, out=characters[1:])
        base = characters[offsets[text]]
        self.spans = [x.astype(np.int32) for x in (a - self.first[text], b - self.first[text], characters[starts[a]] - base, characters[ends[b - 1]] - base)]
        self.span_cut = np.searchsorted(text, np.arange(len(offsets))).astype(np.int32)


def _pass(rows: DataFrame, kept: list[str], windows: Windows, item_type: str, shard_bytes: int) -> DataFrame:
    """The kept columns, n_words, spans and items of every row, for one block of items."""
    kept_types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
    span_type = pa.struct([(name, pa.int32()) for name in _FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashTable(windows.hashes)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in slices(offsets, shard_bytes):
                part = offsets[a : b + 1]
                shard = Shard(data[part[0] : part[-1]], part - part[0], windows, table)
                spans = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in shard.spans], fields=list(span_type))
                cut = np.cumsum([0, *map(len, shard.items)]).astype(np.int32)
                items = windows.items.take(pa.array(np.concatenate([*shard.items, np.zeros(0, np.int64)]).astype(np.int64)))
                items = pa.ListArray.from_arrays(pa.array(cut), items)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k + 1).slice(a, b - a) for k in range(len(kept))), pa.array(np.diff(shard.first)), pa.ListArray.from_arrays(pa.array(shard.span_cut), spans), items],
                    [*kept, "n_words", "spans", "items"],
                )

    # The text is the first column, whether it is kept or not.
    return rows.select(F.col("_text").alias("_searched"), *kept).mapInArrow(tidied(run), ", ".join([*kept_types, "n_words bigint", f"spans array<{SPAN}>", f"items array<{item_type}>"]))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_mark"))


def merged(spans: Column) -> Column:
    """Spans in order, those that meet as one."""

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"), last["from_char"].alias("from_char"), F.greatest(last["to_char"], span["to_char"]).alias("to_char"))
        meets = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"])
        return F.when(meets, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast(f"array<{SPAN}>"), add)


def _merged_passes(passes: list[DataFrame]) -> DataFrame:
    """_id, _mark, n_words, spans, items and _copies: rows equal in id and text have equal results, so one of them and their number are merged."""
    first = lambda c: F.first(c).alias(c)
    once = [p.groupBy("_id", "_mark").agg(first("n_words"), first("spans"), first("items"), F.count(F.lit(1)).alias("_copies")) for p in passes]
    gathered = reduce(DataFrame.union, once).groupBy("_id", "_mark")
    return gathered.agg(first("n_words"), merged(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), first("_copies"))


def matches(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *,
    window: int = 10, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """id, n_words, spans (start and end among the text's words, from_char and to_char among its characters) and the distinct items of every row."""
    item_type, rows = items.schema[item_col].dataType.simpleString(), _rows(docs, id_col, text_col)
    asked = [Windows(block, window) for block in blocks(items, item_col, item_text_col, block_bytes)]
    passes = [_pass(rows, ["_id", "_mark"], windows, item_type, shard_bytes) for windows in asked]
    found = passes[0] if len(passes) == 1 else _merged_passes(passes).withColumn("_one", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))))
    return found.select(F.col("_id").alias(id_col), "n_words", "spans", "items")


def cleaned(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *,
    window: int = 10, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """id and text of every row, the text without its spans.  With one block no text is shuffled."""
    item_type, rows = items.schema[item_col].dataType.simpleString(), _rows(docs, id_col, text_col)
    asked = [Windows(block, window) for block in blocks(items, item_col, item_text_col, block_bytes)]
    if len(asked) == 1:
        found = _pass(rows, ["_id", "_text"], asked[0], item_type, shard_bytes)
    else:
        spans = _merged_passes([_pass(rows, ["_id", "_mark"], windows, item_type, shard_bytes) for windows in asked]).select(F.col("_id").alias("_same"), F.col("_mark").alias("_as"), "spans")
        found = rows.join(spans.hint("merge"), F.col("_id").eqNullSafe(F.col("_same")) & (F.col("_mark") == F.col("_as")))
    return found.select(F.col("_id").alias(id_col), without(F.col("_text"), F.col("spans")).alias(text_col))


def hit_words(spans: Column) -> Column:
    """How many words the spans cover."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda total, x: total + x["end"] - x["start"])


def without(text: Column, spans: Column) -> Column:
    """The text without the characters of its spans."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.try_element_at(spans, i)["to_char"])
    end = lambda i: F.when(i == F.size(spans), F.char_length(text)).otherwise(F.try_element_at(spans, i + 1)["from_char"])
    parts = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.substring(text, begin(i) + 1, end(i) - begin(i)))
    return F.when(F.size(spans) == 0, text).otherwise(F.array_join(parts, ""))
