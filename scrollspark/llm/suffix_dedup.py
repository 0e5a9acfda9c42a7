"""Sparse suffix arrays: word passages that repeat across documents.

Suffixes are kept at content-selected positions only: the minimisers of runs of
``gram`` words over windows of ``least - gram + 1`` runs, so that every passage of
``least`` words holds one, at the same place wherever it stands.  The steps:

1.  All minimisers leave their hash, document and position.  Of texts with equal
    words one goes on, the others are repeated as a whole.  Hashes that only one
    document has are gone after one aggregation.
2.  The positions left are joined to the texts, and each becomes a suffix: its
    run's hash, the words right of the run, and the words left of it, read
    backwards; ``least - gram`` words either way are all that can matter.
3.  Suffixes are dealt by hash of the run and sorted by their words.  Neighbours in
    this order, and in the order of the left sides, are compared and matches
    extended right and left.
4.  Suffixes whose neighbours do not settle both sides are also compared by all
    ways to split ``least - gram`` words between left and right, so that a third
    document with a longer match on one side cannot hide a repeat.
5.  Runs at more than ``hot_rows`` positions are sorted in several places, dealt by document and place,
    so that no task grows with a run.  What neighbours leave open there is settled by the same
    splits across places: the texts leave the hashes of the windows whose minimiser is such a run,
    those that matches cover already once for many documents, and of the windows that no
    match so far covers the repeated ones are joined back.  Equal windows have equal
    minimisers, so all others are settled where theirs is sorted.

A document's spans are the union of its matches, so they cover exactly the words of all
its windows of ``least`` words that another document has too.  Words are compared with
A-Z lower-cased, by 64-bit hashes in runs and windows and by 32-bit hashes of single
words elsewhere.

Which step decides: texts with equal words, the hash of all their words (1); matches of
neighbours in the sorted arrays, the arrays (3); the rest, the splits (4, 5), because neighbours
in the order of one side need not be the best on the other.

Edge cases: ids that are not integers are told apart by 64-bit hashes; null and empty texts, texts of fewer words and rows without id have no
spans; repeats inside one document do not count; rows that share an id are one
document, whose spans are those of all its texts; one row comes back for every row; texts of any length are whole; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from scrollspark.llm.bytesops import mix, powers_of, shingle_hashes, slices, tidied, utf8, word_hashes, word_spans
from scrollspark.llm.tables import arrow_rows, written

CHUNK = 6_000  # suffixes, or windows of one text, that are compared at a time
HELD = 65_536  # different windows that a task combines
STEP = 0xD1342543DE82EF95


def _lowest(grams: np.ndarray, window: int, starts: np.ndarray) -> np.ndarray:
    """Positions of the first smallest hash of the windows at starts."""
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    # argmin copies the windows that it looks at, so a long text is done in pieces.
    pieces = (starts[a : a + CHUNK] for a in range(0, len(starts), CHUNK))
    return np.concatenate([np.zeros(0, np.int64), *(views[x].argmin(axis=1) + x for x in pieces)])


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the first smallest hash of every window."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    return np.unique(_lowest(grams, window, np.arange(len(grams) - window + 1)))


def _selected(gram: int, least: int):
    """Rows of two kinds: minimisers (run, doc, at), and texts (sequence, doc, at: their words, sent).

    A task sends the minimisers of equal texts once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                part = offsets[a : b + 1]
                body = data[part[0] : part[-1]]
                starts, ends, first = word_spans(body, part - part[0])
                words = word_hashes(body, starts, ends)
                grams, owners, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                texts: list[tuple] = []
                for i in range(b - a):
                    own = words[first[i] : first[i + 1]]
                    if len(own) < least:
                        continue
                    key = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    texts.append((int(ids[a + i]), len(own), key, key not in known))
                    if key not in known:
                        known.add(key)
                        h = shingle_hashes(own, gram)
                        at = minimisers(h, least - gram + 1)
                        grams.append(h[at])
                        places.append(at)
                        owners.append(np.full(len(at), ids[a + i], np.int64))
                flat = np.concatenate(grams).view(np.int64)
                n, m = len(flat), len(texts)
                doc, size, key, sent = zip(*texts, strict=True) if texts else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(flat, np.zeros(m, np.int64)), pa.int64(), mask=np.arange(n + m) >= n),
                        pa.array(np.append(np.concatenate(owners), np.array(doc, np.int64))), pa.array(np.append(np.concatenate(places), np.array(size, np.int64)).astype(np.int32)),
                        pa.array([None] * n + list(key), pa.binary()), pa.array([None] * n + list(sent), pa.bool_()),
                    ],
                    ["run", "doc", "at", "sequence", "sent"],
                )

    return run


def _sides(words: np.ndarray, at: int, gram: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to width words left of a run, backwards, and right of it."""
    return words[max(0, at - width) : at][::-1], words[at + gram : at + gram + width]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Of (doc, text, ..) batches, slice by slice, each document's id, word hashes, and other columns."""
    for batch in batches:
        ids, others = batch.column(0).to_numpy(), batch.columns[2:]
        data, offsets = utf8(batch.column(1))
        for a, b in slices(offsets, 1 << 20):
            part = offsets[a : b + 1]
            body = data[part[0] : part[-1]]
            starts, ends, first = word_spans(body, part - part[0])
            words = word_hashes(body, starts, ends)
            yield [(int(ids[a + i]), words[first[i] : first[i + 1]], *(x[a + i].as_py() for x in others)) for i in range(b - a)]


def _of_texts(make):
    """A function of (doc, text, places, ..) batches: make gets what _texts() has of a document, and gives columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _texts(batches):
            rows = [r for doc in docs for r in make(*doc)]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, make.types, strict=True)], list(make.names))

    return run


class Suffixes:
    """Rows of runs with the words on both sides; part: where the suffix is sorted, of so many parts of its run."""

    names = ("run", "part", "parts", "doc", "at", "before", "after")
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())

    def __init__(self, gram: int, least: int):
        self.gram, self.width = gram, least - gram

    def __call__(self, doc: int, words: np.ndarray, places: list[dict]) -> Iterator[tuple]:
        short, h = (words >> np.uint64(32)).astype(">u4"), shingle_hashes(words, self.gram)
        drawn = mix(np.array([p["at"] for p in places], np.uint64) * np.uint64(STEP) + np.uint64(doc & (1 << 64) - 1)) >> np.uint64(33)
        for place, spread in zip(places, drawn.tolist(), strict=True):
            at, parts = place["at"], place["parts"]
            if at + self.gram > len(words):  # a place of another text with this id
                continue
            left, right = _sides(short, at, self.gram, self.width)
            yield int(h[at].view(np.int64)), spread % parts, parts, doc, at, left.tobytes(), right.tobytes()


def _hot_windows(words: np.ndarray, places: list[dict], found: list[dict] | None, gram: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and hashes of the windows whose minimiser is at one of the places, and whether matches found so far cover them."""
    if len(words) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    at, width = np.array([p["at"] for p in places], np.int64), least - gram
    near = np.zeros(len(words) - least + 2, np.int64)
    np.add.at(near, np.minimum(np.maximum(at - width, 0), len(near) - 1), 1)
    np.add.at(near, np.minimum(at + 1, len(near) - 1), -1)
    starts = np.flatnonzero(np.cumsum(near[:-1]) > 0)
    starts = starts[np.isin(_lowest(shingle_hashes(words, gram), width + 1, starts), at)]
    covered = np.zeros(len(starts), bool)
    if found:
        begin, end = _merged(np.array([x["start"] for x in found], np.int64), np.array([x["end"] for x in found], np.int64))
        i = np.searchsorted(begin, starts, "right") - 1
        covered = (i >= 0) & (starts + least <= end[i])
    return starts, shingle_hashes(words, least).view(np.int64)[starts], covered


def _combined(window: np.ndarray, doc: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each window once, with its smallest and largest document."""
    if not len(window):
        return window, doc, last
    order = np.argsort(window, kind="stable")
    window, doc, last = window[order], doc[order], last[order]
    edge = np.flatnonzero(np.append(True, window[1:] != window[:-1]))
    return window[edge], np.minimum.reduceat(doc, edge), np.maximum.reduceat(last, edge)


def _windows(gram: int, least: int):
    """Rows of windows (window, doc, last, start): one for each place that no match covers, and for the covered ones, without a start,
    their smallest and largest document, of many documents at once."""

    def rows(window: np.ndarray, doc: np.ndarray, last: np.ndarray, start: np.ndarray | None = None) -> pa.RecordBatch:
        place = pa.nulls(len(window), pa.int32()) if start is None else pa.array(start.astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(window), pa.array(doc), pa.array(last), place], ["window", "doc", "last", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        held = none, none, none
        for docs in _texts(batches):
            parts = [(doc, *_hot_windows(words, places, found, gram, least)) for doc, words, places, found in docs]
            owner = np.repeat(np.array([p[0] for p in parts], np.int64), [len(p[1]) for p in parts])
            start, window = (np.concatenate([none, *(p[i] for p in parts)]) for i in (1, 2))
            covered = np.concatenate([np.zeros(0, bool), *(p[3] for p in parts)])
            yield rows(window[~covered], owner[~covered], owner[~covered], start[~covered])
            held = _combined(*(np.concatenate([x, y[covered]]) for x, y in zip(held, (window, owner, owner), strict=True)))
            if len(held[0]) > HELD:
                yield rows(*held)
                held = none, none, none
        yield rows(*held)

    return run


def _matrix(cells: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of a matrix, padded with zeros, and how many each row has."""
    sizes = np.array([len(x) // 4 for x in cells], np.int64)
    out = np.zeros((len(cells), width), np.uint32)
    flat = np.frombuffer(b"".join(cells), ">u4").astype(np.uint32)
    rows = np.repeat(np.arange(len(cells)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out, sizes


def _common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common front of each two rows, at most most."""
    differ = a != b
    return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1]), most)


def _fronts(words: np.ndarray, step: int) -> np.ndarray:
    """Hashes of the first 0, 1, .. width words of each row."""
    out = np.zeros((len(words), words.shape[1] + 1), np.uint64)
    np.cumsum(mix(words.astype(np.uint64) + np.uint64(step)) * powers_of(STEP, words.shape[1] + 1)[1:], axis=1, out=out[:, 1:])
    return out


def compared(run: np.ndarray, whole: np.ndarray, doc: np.ndarray, before: list[bytes], after: list[bytes], gram: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches of suffixes as (row, words left, words right of the run) with other documents.

    whole: rows of runs all of whose suffixes are here; only for these can splits settle what is open.
    """
    width = least - gram
    left, n_left = _matrix(before, width)
    right, n_right = _matrix(after, width)
    rows, lefts, rights = [], [], []
    settled = np.zeros(len(run), bool)
    for side in (right, left):
        text = np.ascontiguousarray(np.concatenate([(run.view(np.uint64) >> np.uint64(32)).astype(">u4")[:, None], (run.view(np.uint64) & np.uint64(0xFFFFFFFF)).astype(">u4")[:, None], side.astype(">u4")], axis=1))
        order = np.argsort(text.view(f"S{text.shape[1] * 4}").ravel(), kind="stable")
        a, b = order[:-1], order[1:]
        pair = (run[a] == run[b]) & (doc[a] != doc[b])
        a, b = a[pair], b[pair]
        l = _common(left[a], left[b], np.minimum(n_left[a], n_left[b]))
        r = _common(right[a], right[b], np.minimum(n_right[a], n_right[b]))
        good = l + r >= width
        for x in (a, b):
            rows.append(x[good])
            lefts.append(l[good])
            rights.append(r[good])
            # Nothing is left to find where a match reaches as far as the suffix does on both sides.
            full = good & (l == n_left[x]) & (r == n_right[x])
            settled[x[full]] = True
    open_runs = np.unique(run[whole & ~settled])
    rest = np.flatnonzero(np.isin(run, open_runs))
    if len(rest):
        front_l, front_r = _fronts(left[rest], 1), _fronts(right[rest], 2)
        base = mix(run[rest].view(np.uint64) + np.uint64(7))
        for d in range(width + 1):
            has = np.flatnonzero((n_left[rest] >= d) & (n_right[rest] >= width - d))
            key = mix(base[has] + front_l[has, d] * np.uint64(3) + front_r[has, width - d] * np.uint64(5))
            order = np.argsort(key, kind="stable")
            key, who = key[order], doc[rest[has[order]]]
            edge = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            if not len(edge):
                continue
            size = np.diff(np.append(edge, len(key)))
            many = np.repeat(np.minimum.reduceat(who, edge) != np.maximum.reduceat(who, edge), size)
            hit = rest[has[order[many]]]
            rows.append(hit)
            lefts.append(np.full(len(hit), d))
            rights.append(np.full(len(hit), width - d))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, lefts, rights))


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def _matches(gram: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(table: pa.Table) -> pa.RecordBatch:
            doc, at = table["doc"].to_numpy(), table["at"].to_numpy().astype(np.int64)
            row, l, r = compared(table["run"].to_numpy(), table["parts"].to_numpy() == 1, doc, table["before"].to_pylist(), table["after"].to_pylist(), gram, least)
            # Matches of one suffix all cover its run: their union is one span.
            start, end = np.full(len(doc), np.iinfo(np.int64).max), np.full(len(doc), -1)
            np.minimum.at(start, row, at[row] - l)
            np.maximum.at(end, row, at[row] + gram + r)
            hit = np.flatnonzero(end >= 0)
            return pa.RecordBatch.from_arrays([pa.array(doc[hit]), pa.array(start[hit].astype(np.int32)), pa.array(end[hit].astype(np.int32))], ["doc", "start", "end"])

        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            # The last part of a run may go on; while all rows held are of one there is nothing to cut.
            if rows >= CHUNK and any(held[0].column(c)[0] != batch.column(c)[batch.num_rows - 1] for c in ("run", "part")):
                table = pa.Table.from_batches(held)
                runs, parts = table["run"].to_numpy(), table["part"].to_numpy()
                cut = int(np.flatnonzero((runs != runs[-1]) | (parts != parts[-1]))[-1]) + 1
                yield out(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                rows -= cut
        if held:
            yield out(pa.Table.from_batches(held))

    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for cell in batch.column("found"):
            flat = cell.values.flatten()
            start, end = _merged(flat[0].to_numpy().astype(np.int64), flat[1].to_numpy().astype(np.int64))
            rows.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["doc", "spans"])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, gram: int = 8, least: int = 50, hot_rows: int = 1000) -> DataFrame:
    """id and spans (array of start, end: words, end exclusive) of every row; spans is empty without repeats.

    hot_rows: runs at more positions than this are sorted in several places of about so many.
    """
    spark = docs.sparkSession
    whole_number = isinstance(docs.select(id_col).schema[0].dataType, IntegralType)
    number = lambda c: c.cast("bigint") if whole_number else F.when(c.isNotNull(), F.xxhash64(c))
    ident = number(F.col(id_col))
    source = docs.select(ident.alias("doc"), F.col(text_col).cast("string").alias("text")).where("doc IS NOT NULL")
    with arrow_rows(spark, 2000):
        rows = written(source.mapInArrow(tidied(_selected(gram, least)), "run bigint, doc bigint, at int, sequence binary, sent boolean"), "suffix-minimisers")
    # Of equal texts one goes on; the words of all of them are repeated.
    texts = rows.where("sequence IS NOT NULL")
    alike = written(texts.groupBy("sequence").agg(F.min(F.when(F.col("sent"), F.col("doc"))).alias("lead"), (F.min("doc") != F.max("doc")).alias("copied")), "suffix-texts")
    whole = texts.join(alike.where("copied").select("sequence"), "sequence").select("doc", F.lit(0).alias("start"), F.col("at").alias("end"))
    chosen = rows.where("run IS NOT NULL").select("run", "doc", "at").join(alike.select(F.col("lead").alias("doc")).distinct(), "doc", "left_semi")
    # Written first, so that both sides of the next join are plain shuffles and a run with very many rows is split.
    shared = chosen.groupBy("run").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count(F.lit(1)).alias("k")).where("a <> b").select("run", F.ceil(F.col("k") / hot_rows).cast("int").alias("parts"))
    places = written(chosen.join(written(shared, "suffix-runs"), "run"), "suffix-shared")
    of_docs = lambda part: part.groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("at", "parts"))).alias("places"))

    with arrow_rows(spark, 2000):
        suffixes = source.join(of_docs(places), "doc").mapInArrow(tidied(_of_texts(Suffixes(gram, least))), "run bigint, part int, parts int, doc bigint, at int, before binary, after binary")
        dealt = suffixes.repartition("run", "part").sortWithinPartitions("run", "part")
        found = written(dealt.mapInArrow(tidied(_matches(gram, least)), "doc bigint, start int, end int"), "suffix-matches")
        hot = places.where("parts > 1")
        if not hot.isEmpty():
            so_far = found.union(whole).groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("found"))
            asked = source.join(of_docs(hot).join(so_far, "doc", "left"), "doc").select("doc", "text", "places", "found")
            windows = written(asked.mapInArrow(tidied(_windows(gram, least)), "window bigint, doc bigint, last bigint, start int"), "suffix-windows")
            again = windows.groupBy("window").agg((F.min("doc") != F.max("last")).alias("again"), F.count("start").alias("open")).where("again AND open > 0")
            again = written(again.select("window"), "suffix-again")
            found = found.union(windows.where("start IS NOT NULL").join(again, "window").select("doc", "start", (F.col("start") + least).alias("end")))
    found = found.union(whole)
    spans = found.groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("found")).mapInArrow(_spans, "doc bigint, spans array<struct<start: int, end: int>>")
    rows = docs.select(F.col(id_col).alias("_id"))
    empty = F.array().cast("array<struct<start: int, end: int>>")
    return rows.join(spans, number(rows["_id"]) == spans["doc"], "left").select(F.col("_id").alias(id_col), F.coalesce("spans", empty).alias("spans"))
