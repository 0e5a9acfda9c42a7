"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its characters (A-Z lower-cased,
white space as a space).  Over the training texts each n-gram has a log-count
ratio r between the classes; the n-grams whose ratio carries most are kept, the
feature's value is r where the n-gram occurs and 0 elsewhere, and a logistic
regression with an L2 penalty is fitted on these values.

Training reads a sample of the labelled rows: in the order of a hash of the id, at
most ``train_rows`` ids with one text each, and at most ``train_bytes`` of text; whole
texts, one task.  The model is a few thousand numbers: at most ``FEATURES`` n-grams,
each in at least ``LEAST_TEXTS`` texts of the sample.  Scoring is one pass over
all texts, without a shuffle; only texts go to Python and only scores come back.

Toxic texts are rare, and a fit on few texts keeps its scores low.  So a quarter of
the sample is scored by a fit on the rest, and the shift of the intercept, between
none and equal odds of the labels, that gives the best F1 at ``cut`` there is added
to the fit on all.  Held-out rows play no part in it.

Edge cases: null and empty texts have no features, and score what the intercept
says; labelled texts that do not fit into ``train_bytes`` are passed over, with a warning if none is left; rows without a label (null) do not train, an id labelled more than once
counts with its largest label, an id with several texts with the smallest; without both
labels in the sample, every score is the share of the label, smoothed; rows with equal
ids are scored each; texts of any length are scored whole; extra columns, whatever their
names, are ignored by ``scored`` and pass through ``accepted``; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrollspark.llm.bytesops import IS_WORD, LOWER, HashTable, prefix_codes, slices, span_hashes, tidy, utf8
from scrollspark.llm.tables import written

TRAIN_ROWS = 10_000
TRAIN_BYTES = 48 << 20
CUT = 0.7
SIZES = (3, 4, 5)
FEATURES = 1024
LEAST_TEXTS = 4
PENALTY = 0.002
STEPS = 1000
SLICE = 1 << 20

FOLD = np.where(IS_WORD, LOWER, 0x20).astype(np.uint8)


@dataclass
class Model:
    hashes: np.ndarray  # of the n-grams
    weights: np.ndarray  # with the ratios multiplied in
    bias: float
    sizes: tuple[int, ...] = SIZES

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, feature = occurrences(data, offsets, self.sizes, HashTable(self.hashes))
        total = np.bincount(text, weights=self.weights[feature], minlength=len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def ngrams(data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: hashes of all n-grams inside rows, and the byte where each starts."""
    folded = FOLD[data]
    sums = prefix_codes(folded)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    edge = np.append(starts, len(data))
    row_end = np.repeat(offsets[1:], np.diff(np.searchsorted(starts, offsets)))
    for n in sizes:
        if len(starts) >= n:
            a, b = starts[: len(edge) - n], edge[n:]
            inside = b <= row_end[: len(a)]
            a, b = a[inside], b[inside]
            yield span_hashes(sums, a, b), a


def occurrences(data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...], features: HashTable) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, in order."""
    pairs = [np.zeros(0, np.int64)]
    width = int(features.values.max()) + 1
    for hashes, at in ngrams(data, offsets, sizes):
        found = features.lookup(hashes)
        hit = np.flatnonzero(found >= 0)
        pairs.append((np.searchsorted(offsets, at[hit], "right") - 1) * max(width, 1) + found[hit])
    both = np.unique(np.concatenate(pairs))
    return both // max(width, 1), both % max(width, 1)


def _counted(texts: list[tuple[np.ndarray, np.ndarray]], kinds: list[np.ndarray], sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of at least LEAST_TEXTS texts, with the number of texts of each of four kinds they occur in.

    A first pass counts occurrences in a table by part of the hash, whose counts are
    never too small, so that the many rare n-grams are not held in the second.
    """
    slots = np.zeros(1 << 22, np.uint32)
    for text in texts:
        for found, _ in ngrams(*text, sizes):
            np.add.at(slots, (found >> np.uint64(42)).astype(np.int64), 1)
    hashes, counts = np.zeros(0, np.uint64), np.zeros((0, 4), np.int32)
    for (data, offsets), kind in zip(texts, kinds, strict=True):
        part, marks = [hashes], [np.zeros(0, np.int8)]
        for found, at in ngrams(data, offsets, sizes):
            some = slots[(found >> np.uint64(42)).astype(np.int64)] >= LEAST_TEXTS
            found, cut = found[some], np.searchsorted(at[some], offsets)
            for i in np.flatnonzero(np.diff(cut)).tolist():
                part.append(np.unique(found[cut[i] : cut[i + 1]]))
                marks.append(np.full(len(part[-1]), kind[i], np.int8))
        new, index, which = np.unique(np.concatenate(part), return_index=True, return_inverse=True)
        old = index < len(hashes)
        merged = np.bincount(which[len(hashes) :] * 4 + np.concatenate(marks), minlength=4 * len(new)).reshape(-1, 4).astype(np.int32)
        merged[old] += counts[index[old]]
        hashes, counts = new, merged
    often = counts.sum(axis=1) >= LEAST_TEXTS
    return hashes[often], counts[often]


def ratios(p: np.ndarray, q: np.ndarray, positive: int, negative: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Of n-grams that p of the positive and q of the negative texts have: which to keep, and their log-count ratios."""
    often = np.flatnonzero(p + q >= LEAST_TEXTS)
    rate_p, rate_q = (p[often] + 1) / (positive + 2), (q[often] + 1) / (negative + 2)
    ratio = np.log(rate_p / rate_q)
    top = np.argsort(-np.abs(ratio * (rate_p - rate_q)), kind="stable")[:features]
    return often[top], ratio[top]


def _regression(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, features: int, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and intercept: Nesterov's method on the mean logistic loss; the step follows from the largest row."""
    square = np.bincount(row, weights=value * value, minlength=len(y)).max() + 1
    rate = 1 / (0.25 * square + penalty)
    weights, bias, look_w, look_b, t = np.zeros(features), 0.0, np.zeros(features), 0.0, 1.0
    for _ in range(steps):
        margin = np.bincount(row, weights=value * look_w[column], minlength=len(y)) + look_b
        error = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y) / len(y)
        new_w = look_w - rate * (np.bincount(column, weights=value * error[row], minlength=features) + penalty / len(y) * look_w)
        new_b = look_b - rate * error.sum()
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look_w, look_b = new_w + (t - 1) / after * (new_w - weights), new_b + (t - 1) / after * (new_b - bias)
        weights, bias, t = new_w, new_b, after
    return weights, float(bias)


def _fit(texts: list, y: np.ndarray, use: np.ndarray, hashes: np.ndarray, p: np.ndarray, q: np.ndarray, sizes: tuple[int, ...], features: int, penalty: float, steps: int) -> Model:
    """The model of the texts in use, whose n-grams have the counts p and q."""
    positive, negative = int((y[use] == 1).sum()), int((y[use] == 0).sum())
    top, ratio = ratios(p, q, positive, negative, features)
    table, rows, columns, first = HashTable(hashes[top]), [], [], 0
    for data, offsets in texts:
        text, feature = occurrences(data, offsets, sizes, table)
        rows.append(text + first)
        columns.append(feature)
        first += len(offsets) - 1
    row, column = np.concatenate(rows), np.concatenate(columns)
    mine = use[row]
    place = np.cumsum(use) - 1
    weights, bias = _regression(place[row[mine]], column[mine], ratio[column[mine]], y[use], len(top), penalty, steps)
    return Model(hashes[top], weights * ratio, bias, sizes)


def best_shift(margin: np.ndarray, y: np.ndarray, most: float, cut: float) -> float:
    """Of the shifts 0, 1/4, .. up to most, the first with the best F1 of margins that reach the cut."""
    edge = np.log(cut / (1 - cut))
    shifts = np.arange(0, max(most, 0) + 1e-9, 0.25)
    hits = np.array([((margin + s >= edge) & (y == 1)).sum() for s in shifts])
    chosen = np.array([(margin + s >= edge).sum() for s in shifts])
    return float(shifts[np.argmax(2 * hits / np.maximum(chosen + (y == 1).sum(), 1))])


def fitted(
    texts: list[tuple[np.ndarray, np.ndarray]], labels: list[np.ndarray], *, sizes: tuple[int, ...] = SIZES, features: int = FEATURES, penalty: float = PENALTY, steps: int = STEPS, cut: float = CUT
) -> Model:
    y = np.concatenate([np.zeros(0, np.int64), *labels])
    positive, negative = int((y == 1).sum()), int((y == 0).sum())
    if not positive or not negative:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log((positive + 1) / (negative + 1))), sizes)
    tried = np.arange(len(y)) % 4 == 0
    edges = np.cumsum([0, *(len(x) for x in labels)])
    kinds = [label + 2 * tried[a : a + len(label)] for label, a in zip(labels, edges[:-1], strict=True)]
    hashes, counts = _counted(texts, kinds, sizes)
    shift = 0.0
    if 0 < y[tried].sum() < tried.sum() and 0 < y[~tried].sum() < (~tried).sum():
        trial = _fit(texts, y, ~tried, hashes, counts[:, 1], counts[:, 0], sizes, features, penalty, steps)
        score = np.concatenate([trial.scores(*text) for text in texts])[tried].clip(1e-12, 1 - 1e-12)
        shift = best_shift(np.log(score / (1 - score)), y[tried], float(np.log(negative / positive)), cut)
    model = _fit(texts, y, np.ones(len(y), bool), hashes, counts[:, 1] + counts[:, 3], counts[:, 0] + counts[:, 2], sizes, features, penalty, steps)
    return Model(model.hashes, model.weights, model.bias + shift, sizes)


def held_out(ident: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(ident.cast("string").cast("binary")) % 3 == 1


def sampled(docs: DataFrame, labels: DataFrame, train_rows: int, train_bytes: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """_id, _text, _label of the training rows: one text an id, no more ids and bytes than given.

    In the order of a hash of the ids, a text that is longer than what is left of the bytes is passed over; those after it are not.
    """
    ident = F.col(id_col)
    known = labels.where(F.col(label_col).isNotNull() & ident.isNotNull() & ~held_out(ident)).groupBy(ident.alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    texts = docs.select(ident.alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    # The sample has at most train_rows rows of two numbers.
    found = written(texts.join(F.broadcast(sample), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text")), "toxicity-sample")
    sizes = found.select("_id", F.octet_length("_text").alias("_bytes")).orderBy(F.xxhash64("_id"), "_id").collect()  # at most train_rows rows of two numbers
    chosen, left = [], train_bytes
    for row in sizes:
        if row["_bytes"] <= left:
            chosen.append((row["_id"],))
            left -= row["_bytes"]
    if len(chosen) == len(sizes):
        return found
    if not chosen:
        warnings.warn(f"none of {len(sizes)} labelled texts has {train_bytes} bytes or less: nothing is learnt", stacklevel=3)
    within = docs.sparkSession.createDataFrame(chosen, found.select("_id").schema)
    return found.join(F.broadcast(within), "_id")


def trained(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", cut: float = CUT
) -> Model:
    """The model of the labelled rows that are not held out; cut: the score from which on texts are to be rejected."""
    rows = sampled(docs, labels, train_rows, train_bytes, id_col, text_col, label_col)

    def fit(keys: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")
        (data, offsets), label = utf8(table["_text"]), (table["_label"].to_numpy() > 0).astype(np.int64)
        cuts = list(slices(offsets, SLICE))
        model = fitted([(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in cuts], [label[a:b] for a, b in cuts], cut=cut)
        tidy()
        return pa.table({"hashes": pa.array([model.hashes.tobytes()], pa.binary()), "weights": pa.array([model.weights.tobytes()], pa.binary()), "bias": pa.array([model.bias], pa.float64())})

    one = rows.groupBy(F.lit(1).alias("_all")).applyInArrow(fit, "hashes binary, weights binary, bias double").first()
    if one is None:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    return Model(np.frombuffer(one["hashes"], np.uint64), np.frombuffer(one["weights"], np.float64), one["bias"])


def score_of(model: Model, text: Column) -> Column:
    """The score of a text: other columns never leave the JVM."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data, offsets = utf8(batch)
            found = np.zeros(len(batch))
            for a, b in slices(offsets, SLICE):
                part = offsets[a : b + 1]
                found[a:b] = model.scores(data[part[0] : part[-1]], part - part[0])
            del batch, data, offsets
            yield pa.array(found)
            tidy()

    return score(F.coalesce(text.cast("string"), F.lit("")))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    return docs.select(id_col, score_of(model, F.col(text_col)).alias("score"))


def accepted(docs: DataFrame, model: Model, cut: float = CUT, text_col: str = "text") -> DataFrame:
    """The rows that score less than cut, with all their columns."""
    return docs.where(score_of(model, F.col(text_col)) < cut)
