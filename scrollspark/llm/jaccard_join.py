"""N-gram Jaccard self-join by prefix filters under several global token orders.

A document's set holds the hashes of its distinct word shingles.  Two sets of at
least similarity t must share a token among the first |x| - ceil(t |x|) + 1
tokens of each under ANY global order of the tokens.  Three orders are used:

    A  by the number of sets a token occurs in, rare first, ties by hash
    B  by hash
    C  by another hash

Candidates come from order A, where tokens of one set only lead the prefix, so
that a document whose prefix consists of them is done at once, and common
passages stand last.  Of these candidates only pairs that also share a prefix
token under B and under C are verified by the exact sizes of intersection
and union.

Movement of data.  Map tasks hash the shingles with numpy, pack the tokens of
about ``flush_tokens`` into one binary cell for each token bucket (7 bytes a token: six of
the hash, one for the step to the set that owns it) and send it to the bucket's task,
which counts tokens and answers each sender with its shared tokens.  A cell's
size follows its tokens alone, and cells without tokens are not sent.  Flushes and buckets
hold 2**20 tokens, and for large corpora the square root of 64 times all tokens, so
that cells keep about 64 tokens: 2**25 tokens for 10**13 words.  A token has
48 + log2(buckets) bits, at most 64.  Tokens that many sets of one sender have are
common for certain: their postings are not sent, only their names, so that
no bucket receives more than a bounded number of postings a sender.
Equal sets are merged by digest before pairs are formed.  A flush also ends after a quarter as many rows as tokens,
so that a task full of copies or empty texts holds a bounded number of ids.

Links.  Every shared prefix token names one pivot, the set with the fewest tokens
of its own; all other sets of the token are compared with the pivot only.  When
the links found so far are joined to components, only pairs of one token in
different components can still change the result.  They get a second pivot.  Of what
is left then, sets go whose own tokens rule out every partner in the token's group.
Pairs of small token groups are compared one by one, large groups in blocks of some hundred sets in
the order of their sizes, only blocks of which some pair is possible, and from them only links
come out, never pairs.  In a block the filters by sizes, A, B and C are intersected first and the
pairs that pass, and are not joined yet, are verified.  So a group of near copies that are
similar to its pivots costs comparisons in proportion to its size, texts that share a
template but not 80 % cost none, and no link between components is lost.

Edge cases: null and empty texts, and texts without words, have an empty set and
are linked with nothing; fewer words than a shingle make one shingle of all
words; ids are of any ordered type; rows with equal ids each get their row; null ids get the smallest id of
their component, if any; very long texts are whole; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

from scrollspark.llm.bytesops import shingle_hashes, slices, tidied, tidy, utf8, word_hashes, word_spans
from scrollspark.llm.graph import components
from scrollspark.llm.tables import arrow_rows, path_of, removed, written

CELL = 64  # tokens that a cell holds on average, at least
ROW_TOKENS = 4  # what a row counts for at least in a flush: copies and empty texts bring no tokens, but ids
ORDER_C = np.uint64(0xA24BAED4963EE407)
HOT = 255  # rank of tokens that one sender found in more than hot_sets sets
NO_SET = b""
PIVOT_TURNS = 2
MANY_PAIRS = 10_000  # candidates of a block that are verified together
SHARE = 2048  # tokens: a larger set takes the place of several in a block


def prefix_length(n: int | np.ndarray, percent: int):
    """Tokens of a set of n that a partner of at least percent similarity cannot all avoid."""
    return n - (percent * n + 99) // 100 + 1


def ranks(df: np.ndarray) -> np.ndarray:
    """Document frequencies as one byte, in order: exact up to 127, then eight steps for each doubling."""
    coarse = 127 + np.floor(8 * np.log2(np.maximum(df, 127) / 127)).astype(np.int64)
    return np.where(df <= 127, df, np.minimum(coarse, HOT - 1)).astype(np.uint8)


def shape_of(text_bytes: int, partitions: int, bucket_tokens: int | None, flush_tokens: int | None) -> tuple[int, int]:
    """Buckets, and tokens of a flush."""
    tokens = text_bytes // 6
    spread = max(1 << 20, math.isqrt(CELL * tokens))
    return max(2 * partitions, -(-tokens // (bucket_tokens or spread))), flush_tokens or spread


def _lost_bits(buckets: int) -> int:
    """Low bits that tokens go without, so that six bytes hold their place in a bucket."""
    return max(0, 17 - buckets.bit_length())


def buckets_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the token."""
    return (tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _first_of(bucket: int, buckets: int) -> np.uint64:
    return np.uint64(-(-(bucket << 32) // buckets) << 32)


def _put48(values: np.ndarray) -> bytes:
    return (values & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (values >> np.uint64(32)).astype("<u2").tobytes()


def _get48(cell: memoryview, n: int, at: int) -> np.ndarray:
    return np.frombuffer(cell, "<u4", n, at).astype(np.uint64) | np.frombuffer(cell, "<u2", n, at + 4 * n).astype(np.uint64) << np.uint64(32)


def packed(owner: np.ndarray, tokens: np.ndarray, bucket: int, buckets: int, rest: bytes = b"") -> bytes:
    """Tokens of a bucket with their owners, ascending: a byte for the step from owner to owner, large steps apart."""
    step = np.diff(owner, prepend=0)
    large = step[step >= 255]
    head = np.array([len(tokens), len(large), len(rest)], "<u4").tobytes()
    return head + np.minimum(step, 255).astype(np.uint8).tobytes() + large.astype("<u4").tobytes() + _put48((tokens - _first_of(bucket, buckets)) >> np.uint64(_lost_bits(buckets))) + rest


def unpacked(cell: memoryview, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray, memoryview]:
    n, large, rest = np.frombuffer(cell, "<u4", 3).astype(np.int64).tolist()
    step = np.frombuffer(cell, np.uint8, n, 12).astype(np.int64)
    step[step == 255] = np.frombuffer(cell, "<u4", large, 12 + n)
    at = 12 + n + 4 * large
    tokens = (_get48(cell, n, at) << np.uint64(_lost_bits(buckets))) + _first_of(bucket, buckets)
    return np.cumsum(step), tokens, cell[at + 6 * n : at + 6 * n + rest]


class Sender:
    """The sets of one flush of a map task."""

    def __init__(self, buckets: int, percent: int, hot_sets: int):
        self.buckets, self.percent, self.hot_sets = buckets, percent, hot_sets
        self.clear()

    def clear(self) -> None:
        self.ids: list[int | None] = []
        self.marks: list[int] = []
        self.class_of: list[int] = []
        self.known: dict[bytes, int] = {}
        self.sets: list[np.ndarray] = []
        self.tokens = 0

    def add(self, ident: int | None, mark: int, words: np.ndarray, k: int) -> None:
        lost = np.uint64(_lost_bits(self.buckets))
        found = np.sort(shingle_hashes(words, k) >> lost << lost)
        if len(found) > 1:
            found = found[np.append(True, found[1:] != found[:-1])]
        key = hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else NO_SET
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.sets)
            self.sets.append(found)
            self.tokens += len(found)
        self.ids.append(ident)
        self.marks.append(mark)
        self.class_of.append(at)

    def flush(self, sender: int) -> Iterator[tuple[int, int, bytes | None, dict | None]]:
        """(bucket, sender, postings or None, sets or None); the row of sets has a negative bucket of its own and passes the counting step untouched."""
        if not self.ids:
            return
        sizes = np.array([len(x) for x in self.sets], np.int64)
        tokens = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        hot = np.zeros(0, np.uint64)
        if len(sizes) > self.hot_sets:
            ordered = np.sort(tokens)
            edge = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
            hot = ordered[edge][np.diff(np.append(edge, len(ordered))) > self.hot_sets]
        is_hot = np.zeros(len(tokens), bool)
        if len(hot):
            place = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
            is_hot = hot[place] == tokens
        hot_counts = np.bincount(owner[is_hot], minlength=len(sizes))
        prefix = prefix_length(sizes, self.percent)
        limits_b = [int(x[p - 1]) if len(x) else 0 for x, p in zip(self.sets, prefix.tolist(), strict=True)]
        limits_c = [int(np.partition(x * ORDER_C, p - 1)[p - 1]) if len(x) else 0 for x, p in zip(self.sets, prefix.tolist(), strict=True)]
        yield -1 - sender, sender, None, {
            "ids": self.ids, "marks": self.marks, "class_of": self.class_of, "keys": list(self.known), "sizes": sizes.tolist(),
            "hot_counts": hot_counts.tolist(), "hot": tokens[is_hot].tobytes(),
            "limits": np.array([limits_b, limits_c], np.uint64).tobytes(),
        }
        tokens, owner = tokens[~is_hot], owner[~is_hot]
        bucket, hot_bucket = buckets_of(tokens, self.buckets).astype(np.int64), buckets_of(hot, self.buckets).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, tokens, owner = bucket[order], tokens[order], owner[order]
        some = np.union1d(bucket, hot_bucket)
        edges = (np.searchsorted(where, some, side).tolist() for where in (bucket, hot_bucket) for side in ("left", "right"))
        for b, i, j, x, y in zip(some.tolist(), *edges, strict=True):
            common = _put48((hot[x:y] - _first_of(b, self.buckets)) >> np.uint64(_lost_bits(self.buckets)))
            yield b, sender, packed(owner[i:j], tokens[i:j], b, self.buckets, common), None


class Ids:
    """Schemas for ids of one type."""

    def __init__(self, kind: DataType):
        ids, name = pa.list_(to_arrow_type(kind)), kind.simpleString()
        numbers = pa.list_(pa.int64())
        self.sets = pa.struct([
            ("ids", ids), ("marks", numbers), ("class_of", pa.list_(pa.int32())), ("keys", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())),
            ("hot_counts", pa.list_(pa.int32())), ("hot", pa.binary()), ("limits", pa.binary()),
        ])
        self.sets_ddl = f"struct<ids: array<{name}>, marks: array<bigint>, class_of: array<int>, keys: array<binary>, sizes: array<int>, hot_counts: array<int>, hot: binary, limits: binary>"
        self.classes = pa.schema([
            ("sender", pa.int64()), ("key", pa.binary()), ("ids", ids), ("marks", numbers), ("n", pa.int32()), ("own", pa.int32()),
            ("limit_b", pa.int64()), ("limit_c", pa.int64()), ("shared", pa.binary()), ("prefix", numbers),
        ])
        self.classes_ddl = f"sender bigint, key binary, ids array<{name}>, marks array<bigint>, n int, own int, limit_b bigint, limit_c bigint, shared binary, prefix array<bigint>"


def _sent(kind: Ids, k: int, percent: int, buckets: int, flush_tokens: int, hot_sets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        flush_no = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal flush_no
            rows = list(held.flush(TaskContext.get().partitionId() << 20 | flush_no))
            flush_no += 1
            held.clear()
            for a in range(0, len(rows), 64):
                b, s, p, m = zip(*rows[a : a + 64], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(s, pa.int64()), pa.array(p, pa.binary()), pa.array(m, kind.sets)], ["bucket", "sender", "postings", "sets"])

        held = Sender(buckets, percent, hot_sets)
        for batch in batches:
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data, offsets = utf8(batch.column(2))
            for a, b in slices(offsets):
                part = offsets[a : b + 1]
                body = data[part[0] : part[-1]]
                starts, ends, first = word_spans(body, part - part[0])
                words = word_hashes(body, starts, ends)
                for i in range(b - a):
                    held.add(ids[a + i], marks[a + i], words[first[i] : first[i + 1]], k)
                    if max(held.tokens, ROW_TOKENS * len(held.ids)) >= flush_tokens:
                        yield from out()
        yield from out()

    return run


def _answered(kind: Ids, buckets: int):
    def run(keys: tuple, table: pa.Table) -> pa.Table:
        """One bucket: counts tokens over all senders and answers each with its shared ones."""
        tidy()
        bucket = keys[0].as_py()
        schema = pa.schema([("sender", pa.int64()), ("bucket", pa.int64()), ("answer", pa.binary()), ("sets", kind.sets)])
        if bucket < 0:
            n = table.num_rows
            return pa.table([table["sender"], table["bucket"], pa.nulls(n, pa.binary()), table["sets"]], schema=schema)
        order = np.argsort(table["sender"].to_numpy(), kind="stable").tolist()
        cells = [unpacked(memoryview(table["postings"][i].as_buffer()), bucket, buckets) for i in order]
        every = np.concatenate([tokens for _, tokens, _ in cells])
        common = np.unique(np.concatenate([_get48(rest, len(rest) // 6, 0) for _, _, rest in cells]))
        common = (common << np.uint64(_lost_bits(buckets))) + _first_of(bucket, buckets)
        order_t = np.argsort(every, kind="stable")
        ordered = every[order_t]
        edge = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
        df = np.diff(np.append(edge, len(ordered)))
        rank = ranks(df)
        rank[df == 1] = 0
        if len(common):
            rank[np.isin(ordered[edge], common)] = HOT
        by_token = np.empty(len(every), np.uint8)
        by_token[order_t] = np.repeat(rank, df)
        answers, at = [], 0
        for owner, tokens, _ in cells:
            here = by_token[at : at + len(tokens)]
            at += len(tokens)
            shared = here > 0
            answers.append(packed(owner[shared], tokens[shared], bucket, buckets, here[shared].tobytes()) if shared.any() else None)
        senders = table["sender"].take(pa.array(order))
        return pa.table([senders, table["bucket"], pa.array(answers, pa.binary()), pa.nulls(len(order), kind.sets)], schema=schema).filter(pa.array([a is not None for a in answers]))

    return run


def _classes(kind: Ids, percent: int, buckets: int):
    def run(keys: tuple, table: pa.Table) -> pa.Table:
        tidy()
        return one(keys, table)

    def one(keys: tuple, table: pa.Table) -> pa.Table:
        """One sender: its sets with their shared tokens; key and tokens only of sets that can have a partner."""
        sets = next(x for x in table["sets"].to_pylist() if x is not None)
        n = len(sets["sizes"])
        hot_counts = np.array(sets["hot_counts"], np.int64)
        owners = [np.repeat(np.arange(n), hot_counts)]
        tokens = [np.frombuffer(sets["hot"], np.uint64)]
        rank = [np.full(len(tokens[0]), HOT, np.uint8)]
        for bucket, cell in zip(table["bucket"].to_pylist(), table["answer"], strict=True):
            if cell.is_valid:
                owner, token, rest = unpacked(memoryview(cell.as_buffer()), bucket, buckets)
                owners.append(owner)
                tokens.append(token)
                rank.append(np.frombuffer(rest, np.uint8))
        owner, token, rank_of = np.concatenate(owners), np.concatenate(tokens), np.concatenate(rank)
        order = np.argsort(owner, kind="stable")
        token, rank_of = token[order], rank_of[order]
        begin = np.searchsorted(owner[order], np.arange(n + 1))
        limits = np.frombuffer(sets["limits"], np.int64).reshape(2, -1)
        members: list[list] = [[] for _ in range(n)]
        marks: list[list] = [[] for _ in range(n)]
        for ident, mark, c in zip(sets["ids"], sets["marks"], sets["class_of"], strict=True):
            members[c].append(ident)
            marks[c].append(mark)
        rows = []
        for c, size in enumerate(sets["sizes"]):
            a, b = begin[c], begin[c + 1]
            own, p = size - int(b - a), prefix_length(size, percent)
            if size == 0:
                rows += [(None, [ident], [mark], 0, 0, None, None, None, None) for ident, mark in zip(members[c], marks[c], strict=True)]
            elif own >= p:
                rows.append((None, members[c], marks[c], size, own, None, None, None, None))
            else:
                mine, r = token[a:b], rank_of[a:b]
                lead = np.lexsort((mine, r))[: p - own]
                rows.append((sets["keys"][c], members[c], marks[c], size, own, int(limits[0, c]), int(limits[1, c]), np.sort(mine).tobytes(), mine[lead].view(np.int64)))
        columns = zip(*rows, strict=True)
        sender = keys[0].as_py()
        return pa.table([pa.array([sender] * len(rows), pa.int64()), *(pa.array(list(x), f.type) for x, f in zip(columns, list(kind.classes)[1:], strict=True))], schema=kind.classes)

    return run


def _share(x: np.ndarray, y: np.ndarray) -> bool:
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return False
    return bool((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).any())


def linked(x: np.ndarray, y: np.ndarray, n: tuple[int, int], b: tuple[int, int], c: tuple[int, int], percent: int) -> bool:
    """Filters under orders B and C, then the exact test, on the sorted shared tokens of two sets of sizes n."""
    bx, by = np.uint64(b[0] & (1 << 64) - 1), np.uint64(b[1] & (1 << 64) - 1)
    if not _share(x[: np.searchsorted(x, bx, "right")], y[: np.searchsorted(y, by, "right")]):
        return False
    cx, cy = np.uint64(c[0] & (1 << 64) - 1), np.uint64(c[1] & (1 << 64) - 1)
    if not _share(np.sort(x[x * ORDER_C <= cx]), np.sort(y[y * ORDER_C <= cy])):
        return False
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (n[0] + n[1] - common)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = {name: batch.column(name) for name in batch.schema.names}
            numbers = {k: x[k].to_pylist() for k in ("n_u", "n_v", "limit_b_u", "limit_b_v", "limit_c_u", "limit_c_v")}
            good = [
                linked(
                    np.frombuffer(x["shared_u"][i].as_buffer(), np.uint64), np.frombuffer(x["shared_v"][i].as_buffer(), np.uint64),
                    (numbers["n_u"][i], numbers["n_v"][i]), (numbers["limit_b_u"][i], numbers["limit_b_v"][i]), (numbers["limit_c_u"][i], numbers["limit_c_v"][i]), percent,
                )
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([x["u"], x["v"], pa.array(good, pa.bool_())], ["u", "v", "linked"])

    return run


def _compared(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(u, v, linked) for each pair of class keys."""
    side = lambda s: classes.select(F.col("key").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "limit_b", "limit_c", "shared")))
    both = pairs.join(side("v"), "v").join(side("u"), "u")
    return both.mapInArrow(tidied(_verified(percent)), "u binary, v binary, linked boolean")


def _possible(percent: int):
    """Of two classes with sizes n and own tokens: can they be similar at all?"""
    most = F.least(F.col("n_u") - F.col("own_u"), F.col("n_v") - F.col("own_v"))
    return 100 * most >= percent * (F.col("n_u") + F.col("n_v") - most)


def _pivots(entries: DataFrame, turn: int) -> DataFrame:
    """For each token that sets of different components have: the set with the fewest tokens of its own; in later turns another, by hash."""
    order = F.struct((F.col("own") if turn == 0 else F.xxhash64("key", F.lit(turn))).alias("rank"), "key", "n", "own", "component")
    spread = (F.min("component") != F.max("component")).alias("spread")
    return entries.groupBy("token").agg(F.min(order).alias("p"), spread).where("spread").select("token", F.col("p.key").alias("u"), F.col("p.n").alias("n_u"), F.col("p.own").alias("own_u"), F.col("p.component").alias("component_u"))


def _sides(entries: DataFrame, s: str) -> DataFrame:
    return entries.select("token", F.col("key").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "own", "component")))


def _reach(percent: int) -> Column:
    """The largest size of a set that a set of n tokens, own of them in no other set, can be similar to."""
    shared = F.col("n") - F.col("own")
    return F.floor((100 + percent) * shared / percent) - F.col("n")


def _with_partners(entries: DataFrame, percent: int) -> DataFrame:
    """Entries of tokens without those that no size in the token's group allows, of groups that then still spread over components."""
    entries = entries.withColumn("reach", _reach(percent))
    bounds = written(entries.groupBy("token").agg(F.min("n").alias("least"), F.max("reach").alias("most")), "jaccard-bounds")
    some = entries.join(bounds, "token").where((F.col("least") <= F.col("reach")) & (F.col("most") >= F.col("n"))).drop("least", "most", "k")
    again = written(some.groupBy("token").agg(F.count(F.lit(1)).alias("k"), (F.min("component") != F.max("component")).alias("spread")).where("spread").drop("spread"), "jaccard-spread")
    kept = written(some.join(again, "token"), "jaccard-open")
    removed(entries.sparkSession, path_of(bounds), path_of(again))
    return kept


def _in_blocks(entries: DataFrame, classes: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (u, v) between components of large token groups.

    Sets that share such tokens form clusters; a cluster's sets, by size, are dealt
    into blocks of about so many sets, or SHARE times as many tokens, and each two blocks of which some sets can be similar are one small group of rows.
    """
    hubs = written(entries.groupBy("token").agg(F.min("key").alias("hub")), "jaccard-hubs")
    edges = entries.join(hubs, "token").select(F.col("key").alias("u"), F.col("hub").alias("v")).distinct()
    sets = entries.select("key", "component", "n", "reach").distinct()
    clusters = components(edges).select(F.col("node").alias("key"), F.col("component").alias("cluster")).join(sets, "key")
    clusters = written(clusters, "jaccard-clusters")
    # Sizes of a cluster, in order, and how many sets precede each: small tables, from which every set gets its block.
    counts = clusters.groupBy("cluster", "n").agg(F.count(F.lit(1)).alias("k"))
    weight = F.ceil(F.col("n") / SHARE)
    before = F.sum(F.col("k") * weight).over(Window.partitionBy("cluster").orderBy("n")) - F.col("k") * weight
    counts = written(counts.select("cluster", "n", before.alias("before"), "k"), "jaccard-sizes")
    place = F.col("before") + F.pmod(F.xxhash64("key"), F.col("k")) * weight
    dealt = written(clusters.join(counts, ["cluster", "n"]).select("cluster", "key", "component", "n", "reach", F.floor(place / block).alias("block")), "jaccard-dealt")
    blocks = written(dealt.groupBy("cluster", "block").agg(F.min("n").alias("least"), F.max("reach").alias("most")), "jaccard-blocks")
    other = blocks.select("cluster", F.col("block").alias("j"), F.col("least").alias("least_j"), F.col("most").alias("most_j"))
    pairs = blocks.withColumnRenamed("block", "i").join(other, "cluster").where((F.col("i") <= F.col("j")) & (F.col("least") <= F.col("most_j")) & (F.col("least_j") <= F.col("most")))
    pairs = pairs.select("cluster", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    rows = dealt.select("cluster", "block", "key", "component").join(pairs, ["cluster", "block"]).drop("block")
    links = written(rows.join(classes.drop("sender"), "key").groupBy("cluster", "i", "j").applyInArrow(_block_links(percent), "u binary, v binary"), "jaccard-links")
    removed(entries.sparkSession, *(path_of(x) for x in (hubs, clusters, counts, dealt, blocks)))
    return links


def _block_links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Of all sets of one group: links between components, enough to join what they join."""
        n, own = (table[c].to_numpy().astype(np.int64) for c in ("n", "own"))
        shared = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shared"]]
        _, component = np.unique(np.array(table["component"].to_pylist(), object), return_inverse=True)
        g = len(n)
        size = np.array([len(x) for x in shared])
        most = np.minimum((n - own)[:, None], (n - own)[None, :])
        candidate = np.triu((component[:, None] != component[None, :]) & (100 * most >= percent * (n[:, None] + n[None, :] - most)))
        token, row = np.concatenate(shared), np.repeat(np.arange(g), size)

        def first(order: str) -> tuple[np.ndarray, np.ndarray]:
            """The tokens of all prefixes under one order, and their sets."""
            if order == "a":
                prefix = [x.values.to_numpy().view(np.uint64) for x in table["prefix"]]
                return np.concatenate(prefix), np.repeat(np.arange(g), [len(x) for x in prefix])
            limit = np.repeat(table[f"limit_{order}"].to_numpy().view(np.uint64), size)
            here = (token if order == "b" else token * ORDER_C) <= limit
            return token[here], row[here]

        for order in "abc":
            if candidate.any():
                candidate &= _together(*first(order), g) > 0
        pairs = np.argwhere(candidate)
        both = _together(token, row, g) if len(pairs) > MANY_PAIRS else None
        root = list(range(g))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        u, v = [], []
        for i, j in pairs.tolist():
            x, y = find(component[i]), find(component[j])
            if x != y:
                common = int(both[i, j]) if both is not None else len(np.intersect1d(shared[i], shared[j], assume_unique=True))
                if 100 * common >= percent * (int(n[i]) + int(n[j]) - common):
                    root[x] = y
                    u.append(i)
                    v.append(j)
        keys = table["key"]
        return pa.table({"u": keys.take(pa.array(u, pa.int64())), "v": keys.take(pa.array(v, pa.int64()))})

    return run


def _together(token: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """How many tokens each two rows have in common."""
    out = np.zeros((rows, rows), np.float32)
    values, place = np.unique(token, return_inverse=True)
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    for a in range(0, len(values), 4096):
        i, j = np.searchsorted(place, [a, a + 4096])
        some = np.zeros((rows, 4096), np.float32)
        some[row[i:j], place[i:j] - a] = 1
        out += some @ some.T
    return out.astype(np.int64)


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links).  Options: see tables_of."""
    return tables_of(docs, id_col, text_col, **options)[0].drop("_mark")


def tables_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5, percent: int = 80, bucket_tokens: int | None = None, flush_tokens: int | None = None, hot_sets: int = 64, few_sets: int = 32, block: int = 256) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of joined() with the mark of their text, and the written tables that they are read from.

    percent: two documents link when 100 * intersection >= percent * union.
    few_sets: of what the pivots leave, tokens of at most so many sets have their
    pairs compared one by one, the others in blocks of about so many sets as block says.
    bucket_tokens, flush_tokens: by default as many as the module's text says.
    """
    spark = docs.sparkSession
    kind = Ids(docs.select(id_col).schema[0].dataType)
    source = docs.select(F.col(id_col).alias("_id"), _mark(F.col(text_col)).alias("_mark"), F.col(text_col).cast("string").alias("_text"))
    size = source.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, flush = shape_of(size, partitions, bucket_tokens, flush_tokens)

    sent = source.mapInArrow(tidied(_sent(kind, shingle, percent, buckets, flush, hot_sets)), f"bucket bigint, sender bigint, postings binary, sets {kind.sets_ddl}")
    answered = sent.groupBy("bucket").applyInArrow(_answered(kind, buckets), f"sender bigint, bucket bigint, answer binary, sets {kind.sets_ddl}")
    with arrow_rows(spark, 2000):
        table = written(answered.groupBy("sender").applyInArrow(_classes(kind, percent, buckets), kind.classes_ddl), "jaccard-classes")

    open_sets = table.where(F.col("key").isNotNull())
    leads = open_sets.groupBy("key").agg(F.min("sender").alias("sender"))
    classes = open_sets.join(leads, ["key", "sender"])
    entries = written(classes.select("key", "n", "own", F.explode("prefix").alias("token")).withColumn("component", F.col("key")), "jaccard-entries")

    # One turn of pivots for most links, another for what the first left, then all pairs that can still matter.
    links: DataFrame | None = None
    trash = []
    for turn in range(PIVOT_TURNS + 1):
        groups = entries.groupBy("token").agg(F.count(F.lit(1)).alias("k"), (F.min("component") != F.max("component")).alias("spread"))
        # Sides of joins by token are written first: then both are plain shuffles, and a token of very many sets is split.
        spread = written(groups.where("spread").select("token", "k"), "jaccard-spread")
        still = written(entries.join(spread, "token"), "jaccard-open")
        trash += [spread, still]
        if still.isEmpty():
            break
        if turn < PIVOT_TURNS:
            pivots = written(_pivots(still, turn), "jaccard-pivots")
            trash.append(pivots)
            pairs = _sides(still, "v").join(pivots, "token")
        else:
            still = _with_partners(still, percent)
            trash.append(still)
            few = still.where(F.col("k") <= few_sets)
            pairs = _sides(few, "u").join(_sides(few, "v"), "token").where("u < v")
        pairs = pairs.where("component_u <> component_v").where(_possible(percent)).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        with arrow_rows(spark, 500):  # a row holds the tokens of one or two sets
            fresh = written(_compared(pairs, classes, percent).where("linked").select("u", "v"), "jaccard-links")
            if turn == PIVOT_TURNS:
                many = still.where(F.col("k") > few_sets)
                fresh = fresh if many.isEmpty() else fresh.union(_in_blocks(many, classes, percent, block))
        links = fresh if links is None else links.union(fresh)
        if turn < PIVOT_TURNS:
            found = components(links).withColumnRenamed("node", "key")
            trash.append(entries)
            entries = written(entries.drop("component").join(found, "key", "left").withColumn("component", F.coalesce("component", "key")), "jaccard-entries")
    trash.append(entries)

    if links is None:
        whole = open_sets.select("key").distinct().withColumn("component", F.col("key"))
    else:
        found = components(links).withColumnRenamed("node", "key")
        whole = open_sets.select("key").distinct().join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
    local = F.array_min("ids")
    firsts = written(open_sets.groupBy("key").agg(F.min(local).alias("first")).join(whole, "key"), "jaccard-firsts")
    least = written(firsts.groupBy("component").agg(F.min("first").alias("least")), "jaccard-least")
    final = written(firsts.join(least, "component").select("key", "least"), "jaccard-components")
    removed(spark, *(path_of(x) for x in [*trash, firsts, least]))
    rows = table.select("key", "ids", "marks", "n").join(final, "key", "left")
    rows = rows.select(F.explode(F.arrays_zip("ids", "marks")).alias("_row"), F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("least", F.array_min("ids")).alias("component_id"))
    return rows.select(F.col("_row.ids").alias(id_col), "n_shingles", "component_id", F.col("_row.marks").alias("_mark")), [table, final]


def _mark(text: Column) -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64(text.cast("string"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, one of each component: that with the smallest id.  Rows without an id stay.

    Of rows that share an id, each stays or goes by the component of its own text; all rows of a component with its smallest id stay.
    """
    classes, tables = tables_of(docs, id_col, text_col, **options)
    dropped = written(classes.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone"), F.col("_mark").alias("_text")).distinct(), "jaccard-dropped")
    removed(docs.sparkSession, *(path_of(x) for x in tables))
    row = docs.select(F.struct("*").alias("_row"))
    same = (F.col(f"_row.`{id_col}`") == F.col("_gone")) & (_mark(F.col(f"_row.`{text_col}`")) == F.col("_text"))
    return row.join(dropped.hint("merge"), same, "left_anti").select("_row.*")
