"""Ranked lexical search for a query set: sort-based accumulation of integer impacts.

Terms are runs of digits, ASCII letters and characters beyond ASCII, with A-Z lower-cased.
N counts the documents with a term, L all their terms, df the documents that hold a term.
A term's weight is floor(1000 ln((2N + 2) / (2df + 1))); a document of n terms has m = 10 + 90nN div L,
and a term that occurs tf times in it has the impact weight * (10**9 tf div (1000 tf + 8m)).
The steps, for each block of items (about ``block_bytes`` of text):

1.  One pass over the documents counts N, L and, for the terms of the block, df; a task
    sends one row a term.
2.  A second pass accumulates.  The key space (item, document) is partitioned by ranges of
    documents: a task cuts its rows into slices, and all impacts of a slice's documents meet there, so that
    no posting is shuffled.  The slice's distinct (document, term) pairs are
    joined with the items of each term; (item, document, impact) arrays are concatenated,
    their packed keys radix-sorted, and the impacts summed by reduceat.
3.  Of each item a task keeps its best ``k`` documents in a heap, over all slices, and sends
    only these.  They are written to the shared folder; the best of all tasks are
    chosen by a ranked window, which cuts to k in the map tasks first.

Edge cases: null and empty texts have no terms and are never found; items without terms
have no results; texts of an item that is there several times count as one; documents that are there
several times each have their own rank; equal scores go by ascending id, rows without id last; all
counts are over all rows; other columns, whatever their names, are ignored; an empty table gives no rows.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scrollspark.llm.bytesops import IS_TERM, HashTable, groups, ranges, slices, tidied, utf8, word_hashes, word_spans
from scrollspark.llm.item_blocks import BLOCK_BYTES, Terms, blocks
from scrollspark.llm.tables import written

SLICE = 2 << 20
DOCS, TERMS = -1, -2  # instead of a term's number, in the counts


class Block:
    """The distinct terms of a block of items; of term t the items, by number, are owners[cut[t]] to owners[cut[t + 1]]."""

    def __init__(self, table: pa.Table):
        words = Terms(table)
        self.hashes = words.hashes
        named = words.items.dictionary_encode()
        self.items = named.dictionary if not named.null_count else pa.concat_arrays([named.dictionary, pa.nulls(1, named.dictionary.type)])
        item = pc.fill_null(named.indices, len(named.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = np.unique((words.codes.astype(np.int64) - 1) * max(1, len(self.items)) + np.repeat(item, np.diff(words.first)))
        term, self.owners = pairs // max(1, len(self.items)), pairs % max(1, len(self.items))
        self.cut = np.searchsorted(term, np.arange(len(self.hashes) + 1))


def _occurrences(data: np.ndarray, offsets: np.ndarray, table: HashTable) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many terms each text has; and text, term and number of occurrences of its distinct terms that the table has."""
    starts, ends, first = word_spans(data, offsets, IS_TERM)
    found = table.lookup(word_hashes(data, starts, ends))
    known = np.flatnonzero(found >= 0)
    text = np.searchsorted(first, known, "right") - 1
    pairs, tf = np.unique(text << 32 | found[known], return_counts=True)
    return np.diff(first), pairs >> 32, pairs & 0xFFFFFFFF, tf


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    data, offsets = utf8(batch.column(0))
    for a, b in slices(offsets, SLICE):
        part = offsets[a : b + 1]
        yield data[part[0] : part[-1]], part - part[0], a, b


def _counted(hashes: np.ndarray):
    """Rows (term, n) of a task: documents that hold each term, documents with terms, and all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, df, docs, terms = HashTable(hashes), np.zeros(len(hashes), np.int64), 0, 0
        for batch in batches:
            for data, offsets, _, _ in _parts(batch):
                n, _, term, _ = _occurrences(data, offsets, table)
                df += np.bincount(term, minlength=len(hashes))
                docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [DOCS, TERMS]).astype(np.int64)), pa.array(np.append(df[some], [docs, terms]))], ["term", "n"])

    return run


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


def lengths(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """m of documents of n terms; products beyond 63 bits are taken in Python's integers."""
    if 90 * int(n.max(initial=0)) * docs >> 63:
        return np.array([10 + 90 * x * docs // max(terms, 1) for x in n.tolist()], np.int64)
    return 10 + 90 * n * docs // max(terms, 1)


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of keys that are not negative: passes over 16 bits each, of which numpy's stable sort is a radix sort."""
    order = None
    for shift in range(0, max(1, int(keys.max(initial=0)).bit_length()), 16):
        digit = (keys >> shift & 0xFFFF).astype(np.uint16)
        by = np.argsort(digit if order is None else digit[order], kind="stable")
        order = by if order is None else order[by]
    return order


def accumulated(item: np.ndarray, text: np.ndarray, impact: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """item, text and the sum of impacts of every pair there is, by item and text."""
    keys = item * texts + text
    order = radix_order(keys)
    keys = keys[order]
    begins = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[begins] // texts, keys[begins] % texts, np.add.reduceat(impact[order], begins) if len(begins) else impact[:0]


class Best:
    """Of each item the k best documents so far, as a heap's choice; keys: less score, then rows without id, then id."""

    def __init__(self, k: int, items: int):
        self.k, self.found, self.least = k, [[] for _ in range(items)], np.ones(items, np.int64)

    def add(self, item: np.ndarray, text: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        rank = np.empty(len(ids), np.int64)
        rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        good = np.flatnonzero(score >= self.least[item])
        item, text, score = item[good], text[good], score[good]
        for a, b in zip(*groups(item), strict=True):
            own, at = score[a:b], np.arange(a, b)
            if len(own) > self.k:
                at = at[own >= np.partition(own, -self.k)[-self.k]]
                at = at[np.lexsort((rank[text[at]], -score[at]))[: self.k]]
            which, new = int(item[a]), [(-int(score[i]), not ids[int(text[i])].is_valid, ids[int(text[i])].as_py()) for i in at.tolist()]
            best = heapq.nsmallest(self.k, self.found[which] + new, key=lambda x: x[:2] if x[1] else x)
            self.found[which] = best
            if len(best) == self.k:
                self.least[which] = -best[-1][0]


def _scored(block: Block, weight: np.ndarray, docs: int, terms: int, k: int):
    """Rows (item, doc, score) of a task: the k best of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, best, kind = HashTable(block.hashes), Best(k, len(block.items)), None
        for batch in batches:
            kind = batch.column(1).type
            for data, offsets, a, b in _parts(batch):
                n, text, term, tf = _occurrences(data, offsets, table)
                impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * lengths(n, docs, terms)[text]))
                some = np.flatnonzero(impact > 0)
                place, which = ranges(block.cut[term[some]], block.cut[term[some] + 1])
                best.add(*accumulated(block.owners[place], text[some][which], impact[some][which], b - a), batch.column(1).slice(a, b - a))
        if kind is not None:
            rows = [(i, x[2], -x[0]) for i, found in enumerate(best.found) for x in found]
            item, doc, score = zip(*rows, strict=True) if rows else ((),) * 3
            yield pa.RecordBatch.from_arrays([block.items.take(pa.array(item, pa.int64())), pa.array(doc, kind), pa.array(score, pa.int64())], ["item", "doc", "score"])

    return run


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """item, rank from 1, id and score of each item's k best documents whose score is above 0."""
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"), F.col(id_col).alias("_id"))
    types = f"item {items.schema[item_col].dataType.simpleString()}, doc {docs.schema[id_col].dataType.simpleString()}, score bigint"
    found = []
    for table in blocks(items, item_col, item_text_col, block_bytes):
        block = Block(table)
        counts = rows.mapInArrow(tidied(_counted(block.hashes)), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row for each term of the block, at most
        term, n = counts["term"].to_numpy(), counts["n"].to_numpy()
        df = np.zeros(len(block.hashes), np.int64)
        df[term[term >= 0]] = n[term >= 0]
        all_docs, all_terms = int(n[term == DOCS].sum()), int(n[term == TERMS].sum())
        found.append(written(rows.mapInArrow(tidied(_scored(block, weights(df, all_docs), all_docs, all_terms, k)), types), "search-candidates"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    best = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
