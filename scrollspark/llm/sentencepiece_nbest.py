"""N-best SentencePiece segmentation: forward Viterbi, then backward A*.

The pieces of a vocabulary span a lattice over a text.  Forward Viterbi gives the
best score of every lattice position; used as the heuristic of an A* search from
the end of the text backwards it is exact, so every path that the search completes
is the next best one.

No piece of the vocabulary holds a space behind another character, so the lattice
falls apart at the starts of runs of spaces into independent segments.  Forward and
backward Viterbi scores of all distinct segments of a slice are computed together
in numpy; they give each segment's best path and the loss of its runner-up.  The
N best paths of a text can only leave the best one in the N - 1 segments
with the smallest losses, so A* is run for these, and the N best
combinations are drawn from their lists.

Scores are the vocabulary file's own.  Spaces stand for the mark of word starts, and
a space is put before every text that is not empty.  A character without a piece of
its own is spelt with the byte pieces, at the lowest score less 10.  A literal
word-start mark (U+2581) is spelt in bytes too, so that decoding gives back exactly
the text.  Of the best paths with equal scores the one with the longest last piece is first, then
that with the longest piece before it, and so on; of others, the one that leaves a better path last.

Edge cases: null and empty texts have no tokens and one segmentation; texts of
one segmentation have fewer than N; segments of any length, such as texts without spaces, are
searched whole, in time and memory linear in their length;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrollspark.llm import bytesops
from scrollspark.llm.bytesops import byte_hashes, powers_of, prefix_codes, slices, span_hashes, tidied, utf8

SLICE = 1 << 19
SHORT = 64  # bytes of segments that are searched in numpy
MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 250_000  # segments that a worker remembers between slices
NO_SCORE = -1e8  # scores below stand for "none" in the file; such pieces count as unknown


@dataclass
class Vocabulary:
    """Pieces as bytes (a space for the mark), their ids and scores, and the ids of the 256 byte pieces."""

    pieces: list[bytes]
    ids: list[int]
    scores: list[float]
    byte_ids: list[int]
    unknown: float = 0.0
    index: dict[bytes, tuple[int, float]] = field(default_factory=dict, repr=False)

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        every = range(model.get_piece_size())
        ids = [i for i in every if not special(i)]
        named = [model.id_to_piece(i) for i in ids]
        if any(MARK in x.lstrip(MARK) for x in named):
            raise ValueError("a piece holds a word start inside")
        byte_ids = [i for i in every if model.is_byte(i)]
        if len(byte_ids) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        return cls([x.replace(MARK, " ").encode() for x in named], ids, [model.get_score(i) for i in ids], byte_ids)

    def __post_init__(self) -> None:
        usual = [s for s in self.scores if s > NO_SCORE]
        self.unknown = min(usual) - UNKNOWN_PENALTY
        self.scores = [max(s, self.unknown) for s in self.scores]
        self.index = dict(zip(self.pieces, zip(self.ids, self.scores, strict=True), strict=True))
        self.longest = max(map(len, self.pieces))


class Lattice:
    """The vocabulary compiled for numpy: a hash table of all prefixes of pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = v = vocabulary
        prefixes: dict[bytes, int] = {}
        for k, piece in enumerate(v.pieces):
            for n in range(1, len(piece)):
                prefixes.setdefault(piece[:n], -1)
            prefixes[piece] = k
        keys = list(prefixes)
        data = np.frombuffer(b"".join(keys), np.uint8)
        ends = np.cumsum([len(x) for x in keys])
        hashes = span_hashes(prefix_codes(data), ends - [len(x) for x in keys], ends)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two prefixes have one hash")
        self.bits = max(12, int(len(keys) * 8).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -2, np.int32)
        todo, values, slot = hashes, np.array([prefixes[x] for x in keys], np.int32), self._slot(hashes)
        while len(todo):
            free = self.values[slot] == -2
            first = np.unique(slot[free], return_index=True)[1]
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]], self.values[slot[put]] = todo[put], values[put]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, values, slot = todo[rest], values[rest], (slot[rest] + 1) & (len(self.keys) - 1)
        self.ids = np.array(v.ids, np.int32)
        self.scores = np.array(v.scores, np.float64)
        self.byte_ids = np.array(v.byte_ids, np.int32)
        self.size_of = np.zeros(max(*v.ids, *v.byte_ids) + 1, np.int64)
        self.size_of[self.ids] = [len(x) for x in v.pieces]
        self.size_of[self.byte_ids] = 1
        text = [b""] * len(self.size_of)
        for i, x in zip(v.ids, v.pieces, strict=True):
            text[i] = x
        for byte, i in enumerate(v.byte_ids):
            text[i] = bytes([byte])
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.text_at = np.append(0, np.cumsum(self.size_of))[:-1]
        self.found: dict[bytes, list[tuple[float, list[int]]]] = {}
        self.forget()

    def forget(self) -> None:
        """Empties the memory of segments: sorted hashes, and for each score, loss, and where its ids are in the pool."""
        self.known = np.zeros(0, np.uint64)
        self.facts = np.zeros((0, 2))
        self.places = np.zeros((0, 2), np.int64)
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0

    def learn(self, hashes: np.ndarray, facts: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Adds segments (ascending new hashes) with the ids of all of them one after the other."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool[: self.used], np.zeros(self.used + len(ids), np.int32))
        self.pool[self.used : self.used + len(ids)] = ids
        places = np.stack([self.used + np.cumsum(counts) - counts, counts], axis=1)
        self.used += len(ids)
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.facts = np.insert(self.facts, at, facts, axis=0)
        self.places = np.insert(self.places, at, places, axis=0)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Piece number, -1 for a proper prefix, -2 for neither."""
        slot = self._slot(hashes)
        out = self.values[slot]
        miss = np.flatnonzero((self.keys[slot] != hashes) & (out != -2))
        slot = slot[miss]
        while len(miss):
            slot = (slot + 1) & (len(self.keys) - 1)
            got = self.values[slot]
            out[miss] = got
            on = (self.keys[slot] != hashes[miss]) & (got != -2)
            miss, slot = miss[on], slot[on]
        return out

    # One segment, in plain Python: the A* search, and long segments.

    def bare_ends(self, segment: bytes) -> bytearray:
        """For each position the bytes of the character that ends there, if it has no piece of its own."""
        out, at = bytearray(len(segment) + 1), 0
        while at < len(segment):
            character = segment[at : at + char_size(segment[at])]
            at += len(character)
            if character not in self.vocabulary.index:
                out[at] = len(character)
        return out

    def edges_to(self, segment: bytes, end: int, bare: int) -> list[tuple[int, int, float]]:
        """The edges that end at a position as (start, id or -1, score), longest first; bare: see bare_ends."""
        index = self.vocabulary.index
        out = [(start, *hit) for start in range(max(0, end - self.vocabulary.longest), end) if (hit := index.get(segment[start:end]))]
        return sorted([*out, (end - bare, -1, self.vocabulary.unknown)]) if bare else out

    def nbest(self, segment: bytes, n: int) -> list[tuple[float, list[int]]]:
        """The n best (score, ids) of a segment, best first.

        The search goes by what a path has lost against the best one.  As the forward scores are
        exact, each open path has a completion that loses nothing more; so no more open paths need
        to be kept than are still wanted, the steps are at most n for each position, and memory is linear.
        """
        have = self.found.get(segment)
        if have is not None and len(have) >= min(n, len(have)) and (len(have) >= n or have[-1][0] == -np.inf):
            return [x for x in have[:n] if x[0] > -np.inf]
        bare = self.bare_ends(segment)
        forward = array("d", [-np.inf]) * len(bare)
        forward[0] = 0.0
        for end in range(1, len(forward)):
            forward[end] = max((forward[start] + score for start, _, score in self.edges_to(segment, end, bare[end])), default=-np.inf)
        out: list[tuple[float, list[int]]] = []
        # (loss, later ones first, position, path), in order
        turn, paths = 0, [(0.0, 0, len(segment), None)]
        while paths and len(out) < n:
            loss, _, at, path = paths.pop(0)
            if at == 0:
                ids: list[int] = []
                place = 0
                while path is not None:
                    piece, size, path = path
                    ids += [piece] if piece >= 0 else [self.vocabulary.byte_ids[b] for b in segment[place : place + size]]
                    place += size
                out.append((forward[-1] - loss, ids))
                continue
            for start, piece, score in reversed(self.edges_to(segment, at, bare[at])):
                if forward[start] > -np.inf:
                    turn += 1
                    bisect.insort(paths, (loss + (forward[at] - (forward[start] + score)), -turn, start, (piece, at - start, path)))
            del paths[n - len(out) :]
        if len(segment) <= SHORT:
            if len(self.found) > 50_000:
                self.found.clear()
            self.found[segment] = out if len(out) == n else [*out, (-np.inf, [])]
        return out

    # All distinct segments of a slice together.

    def best(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of short segments: best score, loss of the runner-up (inf: none), and all ids with their offsets."""
        lanes = len(starts)
        length = ends - starts
        sums = prefix_codes(data)
        inverse = powers_of(bytesops._INVERSE, len(sums))
        lane_of = np.repeat(np.arange(lanes), length)
        base = np.repeat(starts - (np.cumsum(length) - length), length)
        place = np.arange(int(length.sum())) + base
        stop = ends[lane_of]
        head = (data[place] & 0xC0) != 0x80
        alive, lane = place[head], lane_of[head]
        e_start, e_end, e_lane, e_piece, single = [], [], [], [], np.zeros(len(data) + 1, bool)
        last = stop[head]
        for size in range(1, self.vocabulary.longest + 1):
            fits = alive + size <= last
            alive, lane, last = alive[fits], lane[fits], last[fits]
            if not len(alive):
                break
            raw = (sums[alive + size] - sums[alive]) * inverse[alive]
            got = self.lookup(bytesops.mix(raw + np.uint64(size * 0xD6E8FEB86659FD93 & (1 << 64) - 1)))
            hit = got >= 0
            e_start.append(alive[hit])
            e_end.append(alive[hit] + size)
            e_lane.append(lane[hit])
            e_piece.append(got[hit])
            single[alive[hit & (CHAR_SIZE[data[alive]] == size)]] = True
            on = got != -2
            alive, lane, last = alive[on], lane[on], last[on]
        bare = head & ~single[place]
        e_start.append(place[bare])
        e_end.append(np.minimum(place[bare] + CHAR_SIZE[data[place[bare]]], stop[bare]))
        e_lane.append(lane_of[bare])
        e_piece.append(np.full(int(bare.sum()), -1, np.int32))
        start, end, lane, piece = (np.concatenate(x) for x in (e_start, e_end, e_lane, e_piece))
        start, end = start - starts[lane], end - starts[lane]
        score = np.where(piece >= 0, self.scores[piece], self.vocabulary.unknown)
        deep = int(length.max()) if lanes else 0
        node = np.cumsum(length + 1) - (length + 1)  # of each lane's position 0
        from_node, to_node = node[lane] + start, node[lane] + end
        nodes = int(length.sum()) + lanes
        forward, backward = np.full(nodes, -np.inf), np.full(nodes, -np.inf)
        choice = np.full(nodes, -1, np.int64)
        forward[node] = 0.0
        backward[node + length] = 0.0
        # By end, then node, then start: of equal scores the first, so the longest, is chosen.
        order = np.argsort((end * nodes + to_node) * (SHORT + 1) + start)
        at = np.searchsorted(end[order], np.arange(deep + 2))
        f_node, t_node, gain = from_node[order], to_node[order], score[order]
        for e in range(1, deep + 1):
            i, j = at[e], at[e + 1]
            if i < j:
                value, who = forward[f_node[i:j]] + gain[i:j], t_node[i:j]
                edge = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
                top = np.maximum.reduceat(value, edge)
                forward[who[edge]] = top
                is_top = np.flatnonzero(value == np.repeat(top, np.diff(np.append(edge, j - i))))[::-1]
                choice[who[is_top]] = order[i:j][is_top]  # the last write of a node is its first edge
        order = np.argsort(start * nodes + from_node)
        at = np.searchsorted(start[order], np.arange(deep + 2))
        f_node, t_node, gain = from_node[order], to_node[order], score[order]
        for s in range(deep - 1, -1, -1):
            i, j = at[s], at[s + 1]
            if i < j:
                who = f_node[i:j]
                edge = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
                backward[who[edge]] = np.maximum.reduceat(backward[t_node[i:j]] + gain[i:j], edge)
        total = forward[node + length]
        on_path = np.zeros(len(start), bool)
        walking, taken = node + length, []
        base_of = node
        while len(walking):
            live = walking > base_of
            walking, base_of = walking[live], base_of[live]
            edges = choice[walking]
            taken.append(edges)
            on_path[edges] = True
            walking = from_node[edges]
        rest = np.where(on_path, -np.inf, forward[from_node] + score + backward[to_node])
        second = np.full(lanes, -np.inf)
        order = np.argsort(lane, kind="stable")
        if len(order):
            edge = np.flatnonzero(np.append(True, lane[order][1:] != lane[order][:-1]))
            second[lane[order][edge]] = np.maximum.reduceat(rest[order], edge)
        path = np.concatenate(taken) if taken else np.zeros(0, np.int64)
        path = path[np.argsort(from_node[path])]
        spelt = piece[path] < 0
        repeat = np.where(spelt, end[path] - start[path], 1)
        ids = np.repeat(np.where(spelt, 0, self.ids[piece[path]]), repeat)
        where = np.repeat(starts[lane[path]] + start[path], repeat) + np.arange(len(ids)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        bytewise = np.repeat(spelt, repeat)
        ids[bytewise] = self.byte_ids[data[where[bytewise]]]
        offsets = np.append(0, np.cumsum(np.bincount(lane[path], weights=repeat, minlength=lanes).astype(np.int64)))
        with np.errstate(invalid="ignore"):
            loss = np.where(np.isneginf(second), np.inf, total - second)
        return total, loss, ids.astype(np.int32), offsets

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of texts given by all their ids one after the other; the leading space is gone."""
        size = self.size_of[ids]
        at = np.repeat(self.text_at[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        data = self.text[at]
        edge = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(counts))]
        some = np.diff(edge) > 0
        keep = np.ones(len(data), bool)
        keep[edge[:-1][some]] = False
        return data[keep], edge - np.append(0, np.cumsum(some))


def char_size(byte: int) -> int:
    return 1 if byte < 0xC0 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4


CHAR_SIZE = np.array([char_size(b) for b in range(256)], np.int64)


def combined(lists: list[list[tuple[float, list[int]]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best ways to take one entry of each list: loss against all first entries, and the entries taken."""
    first = (0,) * len(lists)
    heap, seen, out = [(0.0, first)], {first}, []
    while heap and len(out) < n:
        loss, pick = heapq.heappop(heap)
        out.append((loss, pick))
        for i, k in enumerate(pick):
            if k + 1 < len(lists[i]):
                nxt = (*pick[:i], k + 1, *pick[i + 1 :])
                if nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (sum(lists[j][0][0] - lists[j][x][0] for j, x in enumerate(nxt)), nxt))
    return out


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with a space before each that is not empty, the segments' starts (one more at the end), and each text's first segment."""
    size = np.diff(offsets)
    some = size > 0
    spaced = np.full(len(data) + int(some.sum()), 0x20, np.uint8)
    at = offsets + np.append(0, np.cumsum(some))
    keep = np.ones(len(spaced), bool)
    keep[at[:-1][some]] = False
    spaced[keep] = data
    space = spaced == 0x20
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin[at[:-1][some]] = True
    starts = np.append(np.flatnonzero(begin), len(spaced))
    return spaced, starts, np.searchsorted(starts, at)


@dataclass
class Encoded:
    ids: np.ndarray
    counts: np.ndarray
    scores: list[list[float]]  # of each text's best segmentations, best first
    changes: list[list[list[tuple[int, int, list[int]]]]]  # of each but the first: (token offset, tokens replaced, ids instead)


def encode(lattice: Lattice, data: np.ndarray, offsets: np.ndarray, n: int) -> Encoded:
    """The segmentations of all texts.

    Segments are told apart by hash; the best ids of all texts are decoded again, and
    where that does not give back the bytes, the slice is done again with numbers
    that are given to the segments' bytes.
    """
    spaced, starts, first = segments(data, offsets)
    got = _encoded(lattice, spaced, starts, first, byte_hashes(spaced, starts[:-1], starts[1:]), n)
    back, at = lattice.decode(got.ids, got.counts)
    if np.array_equal(at, offsets) and np.array_equal(back, data):
        return got
    raw, numbers = spaced.tobytes(), {}
    exact = np.array([numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)], np.uint64)
    lattice.forget()
    try:
        return _encoded(lattice, spaced, starts, first, exact, n)
    finally:
        lattice.forget()


def _encoded(lattice: Lattice, spaced: np.ndarray, starts: np.ndarray, first: np.ndarray, hashes: np.ndarray, n: int) -> Encoded:
    texts = len(first) - 1
    a, b = starts[:-1], starts[1:]
    distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
    raw = spaced.tobytes()
    if len(lattice.known) > REMEMBERED:
        lattice.forget()
    at = np.minimum(np.searchsorted(lattice.known, distinct), max(0, len(lattice.known) - 1))
    new = np.flatnonzero(lattice.known[at] != distinct) if len(lattice.known) else np.arange(len(distinct))
    is_short = (b - a)[example[new]] <= SHORT
    short = new[is_short]
    score, loss, ids, cut = lattice.best(spaced, a[example[short]], b[example[short]])
    lattice.learn(distinct[short], np.stack([score, loss], axis=1), np.diff(cut), ids)
    for k in new[~is_short].tolist():
        found = lattice.nbest(raw[a[example[k]] : b[example[k]]], 2 if n > 1 else 1)
        gap = found[0][0] - found[1][0] if len(found) > 1 else np.inf
        lattice.learn(distinct[k : k + 1], np.array([[found[0][0], gap]]), np.array([len(found[0][1])]), np.array(found[0][1], np.int32))
    at = np.searchsorted(lattice.known, distinct)
    (score, loss), (begin, count), every = lattice.facts[at].T, lattice.places[at].T, lattice.pool
    sizes = count[which]
    token_at = np.append(0, np.cumsum(sizes))
    out = every[np.repeat(begin[which] - token_at[:-1], sizes) + np.arange(int(token_at[-1]))]
    edges = token_at[first]
    total = np.append(0, np.cumsum(score[which]))
    total = total[first[1:]] - total[first[:-1]]
    scores: list[list[float]] = []
    changes: list[list] = []
    losses = loss[which]
    for t in range(texts):
        lo, hi = int(first[t]), int(first[t + 1])
        here = losses[lo:hi]
        if n > 2 and hi - lo > n - 1:
            near = np.flatnonzero(here <= np.partition(here, n - 2)[n - 2])
            near = near[np.argsort(here[near], kind="stable")][: n - 1]
        elif n == 2 and hi > lo:
            near = np.array([int(here.argmin())])
        else:
            near = np.arange(hi - lo) if n > 1 else np.zeros(0, np.int64)
        near = sorted(int(x) + lo for x in near if here[x] < np.inf)
        lists = [lattice.nbest(raw[a[s] : b[s]], n) for s in near]
        best = combined(lists, n)
        scores.append([float(total[t] - x) for x, _ in best])
        changes.append([[(int(token_at[s] - edges[t]), int(sizes[s]), lists[j][k][1]) for j, (s, k) in enumerate(zip(near, pick, strict=True)) if k] for _, pick in best[1:]])
    return Encoded(out, np.diff(edges), scores, changes)


def segmentations(ids: list[int], changes: list[list[tuple[int, int, list[int]]]]) -> list[list[int]]:
    """All n best id lists from the best one and what the others change in it."""
    out = [list(ids)]
    for change in changes:
        new = list(ids)
        for at, size, instead in sorted(change, reverse=True):
            new[at : at + size] = instead
        out.append(new)
    return out


CHANGE = pa.list_(pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32()), ("ids", pa.list_(pa.int32()))])))
ENCODED_DDL = "ids array<int>, scores array<double>, changes array<array<struct<at: int, size: int, ids: array<int>>>>"


def encoded(docs: DataFrame, vocabulary: Vocabulary, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (best segmentation), scores (of the n best), changes (of the others against the best)."""
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = compiled(vocabulary)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, SLICE):
                part = offsets[a : b + 1]
                got = encode(lattice, data[part[0] : part[-1]], part - part[0], n)
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(got.counts)).astype(np.int32)), pa.array(got.ids, pa.int32()))
                changes = [[[{"at": x, "size": y, "ids": z} for x, y, z in one] for one in text] for text in got.changes]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids, pa.array(got.scores, pa.list_(pa.float64())), pa.array(changes, CHANGE)], [id_col, "ids", "scores", "changes"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(tidied(run), f"`{id_col}` {id_type}, {ENCODED_DDL}")


def summarised(docs: DataFrame, vocabulary: Vocabulary, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each text, encoded and decoded again: counts, scores, and digests of the best ids and of the text decoded from them.

    alternatives_decode: every other segmentation decodes to the same text.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    types = [pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.bool_()]

    def rows(lattice: Lattice, got: Encoded) -> Iterator[tuple]:
        data, offsets = lattice.decode(got.ids, got.counts)
        text, ids = data.tobytes(), got.ids.astype("<i4").tobytes()
        at, cut = offsets.tolist(), np.append(0, np.cumsum(got.counts)).tolist()
        for i, (scores, changes) in enumerate(zip(got.scores, got.changes, strict=True)):
            back = text[at[i] : at[i + 1]]
            alike = all(decoded_bytes(lattice, got.ids[cut[i] + x : cut[i] + x + size]) == decoded_bytes(lattice, instead) for change in changes for x, size, instead in change)
            yield cut[i + 1] - cut[i], scores[0], scores[1] if len(scores) > 1 else None, len(scores), hashlib.sha256(ids[4 * cut[i] : 4 * cut[i + 1]]).hexdigest(), len(back), hashlib.sha256(back).hexdigest(), alike

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = compiled(vocabulary)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, SLICE):
                part = offsets[a : b + 1]
                columns = zip(*rows(lattice, encode(lattice, data[part[0] : part[-1]], part - part[0], n)), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], [id_col, *SUMMARY])

    ddl = f"`{id_col}` {id_type}, n_tokens bigint, score double, second_score double, n_best int, ids_sha256 string, decoded_bytes bigint, decoded_sha256 string, alternatives_decode boolean"
    return docs.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(tidied(run), ddl)


SUMMARY = ["n_tokens", "score", "second_score", "n_best", "ids_sha256", "decoded_bytes", "decoded_sha256", "alternatives_decode"]
_compiled: dict[str, Lattice] = {}


def compiled(vocabulary: Vocabulary) -> Lattice:
    """The lattice of a vocabulary, kept by a Python worker from task to task."""
    key = hashlib.sha256(repr((vocabulary.pieces, vocabulary.ids, vocabulary.scores, vocabulary.byte_ids)).encode()).hexdigest()
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Lattice(vocabulary)
    return _compiled[key]


def decoded_bytes(lattice: Lattice, ids) -> bytes:
    return b"".join(lattice.text[lattice.text_at[i] : lattice.text_at[i] + lattice.size_of[i]].tobytes() for i in ids)
