"""Operators that ask a query set of all documents, and fill-in-middle: edge cases, and plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrollspark.llm import decontamination, fill_in_middle, fm_index, item_blocks, mixing, ranked_search, toxicity
from tests.llm.test_operators import EDGES, FOLD, docs_df

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string, spans string, term string, _text string"
WORDS = "alpha Beta gamma DELTA épée ñu zeta 7 x9 日本".split()


def words_of(text):
    return TERM.findall((text or "").translate(FOLD))


def items_df(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x") for i, t in rows], ITEMS)


def random_corpus(seed=3):
    rng = random.Random(seed)
    sentence = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(i, sentence(rng.choice([1, 2, 4, 9, 10, 11, 25]) if i % 5 == 0 else rng.randint(12, 30))) for i in range(30)]
    items += [(3, "a second text of an item that is there twice " + sentence(5)), (30, None), (31, ""), (32, " -- "), (None, sentence(12))]
    docs = [*EDGES, "ab" * 3000, "alpha " * 3000]
    for _ in range(60):
        parts = [sentence(rng.randint(0, 12)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            own = words_of(rng.choice(items)[1])
            at = rng.randint(0, max(0, len(own) - 10))
            parts.insert(rng.randint(0, len(parts)), rng.choice([" ", ", ", "\n- "]).join(own[at : at + rng.randint(8, 20)]).upper())
        docs.append(" unseen ".join(parts) if rng.random() < 0.5 else "; ".join(parts))
    return docs + docs[-5:], items


# FM-index


@pytest.mark.parametrize("seed", range(6))
def test_fm_index_finds_all_places(seed):
    rng = np.random.default_rng(seed)
    highest = int(rng.choice([1, 2, 5, 300]))
    symbols = np.concatenate([np.append(rng.integers(1, highest + 1, rng.integers(1, 60)), 0) for _ in range(20)] + [np.ones(200, np.int64), [0]] * 2)
    index = fm_index.FMIndex(symbols, highest, step=int(rng.choice([1, 3, 8])))
    order = fm_index.suffix_order(symbols, index.bits)
    zero = {int(i): k - len(symbols) for k, i in enumerate(np.flatnonzero(symbols == 0))}
    keys = [[int(s) if s else zero[i + j] for j, s in enumerate(symbols[i : i + 300])] for i in range(len(symbols))]
    for key in keys:
        ends = next(j for j, s in enumerate(key) if s < 0)
        del key[ends + 1 :]
    assert order.tolist() == sorted(range(len(symbols)), key=keys.__getitem__)
    for length in (1, 2, 5):
        patterns = rng.integers(1, highest + 1, (30, length))
        low, high = index.search(patterns)
        for pattern, a, b in zip(patterns, low, high, strict=True):
            found = sorted(index.locate(np.arange(a, b)).tolist())
            assert found == [i for i in range(len(symbols) - length + 1) if (symbols[i : i + length] == pattern).all()]


# Decontamination


def plain_matches(docs, items, window=10):
    windows = defaultdict(set)
    for ident, text in items:
        own = words_of(text)
        m = min(window, len(own))
        for j in range(len(own) - m + 1 if own else 0):
            windows[tuple(own[j : j + m])].add(ident)
    sizes = sorted({len(w) for w in windows})
    out = []
    for text in docs:
        own, hit, named = words_of(text), set(), set()
        for m in sizes:
            for j in range(len(own) - m + 1):
                if found := windows.get(tuple(own[j : j + m])):
                    hit |= set(range(j, j + m))
                    named |= found - {None}
        out.append((len(own), hit, named))
    return out


@pytest.mark.parametrize(("block_bytes", "shard_bytes", "partitions"), [(1 << 22, 1 << 22, 2), (1 << 22, 500, 3), (700, 1 << 20, 2)])
def test_matches_are_those_of_the_plain_version(spark, block_bytes, shard_bytes, partitions):
    docs, items = random_corpus()
    ids = [None if i == 2 else i for i in range(len(docs))]
    found = decontamination.matches(docs_df(spark, docs, ids).repartition(partitions), items_df(spark, items), block_bytes=block_bytes, shard_bytes=shard_bytes).collect()
    assert len(found) == len(docs)
    for row in found:
        i = 2 if row["doc_id"] is None else row["doc_id"]
        n, hit, named = plain_matches([docs[i]], items)[0]
        assert (row["n_words"], set(row["items"]), len(row["items"])) == (n, named, len(named))
        assert [x for s in row["spans"] for x in range(s["start"], s["end"])] == sorted(hit)
        starts = [m.span() for m in TERM.finditer(docs[i] or "")]
        for a, b in zip(row["spans"], row["spans"][1:], strict=False):
            assert a["end"] < b["start"]
        for s in row["spans"]:
            assert (s["from_char"], s["to_char"]) == (starts[s["start"]][0], starts[s["end"] - 1][1])


@pytest.mark.parametrize("block_bytes", [1 << 22, 700])
def test_cleaned_texts_have_no_spans_left(spark, block_bytes):
    docs, items = random_corpus(5)
    frame, benchmark = docs_df(spark, docs), items_df(spark, items)
    spans = {r["doc_id"]: r["spans"] for r in decontamination.matches(frame, benchmark).collect()}
    back = decontamination.cleaned(frame, benchmark, block_bytes=block_bytes).collect()
    assert len(back) == len(docs)
    for row in back:
        text, want, at = docs[row["doc_id"]] or "", "", 0
        for s in spans[row["doc_id"]]:
            want, at = want + text[at : s["from_char"]], s["to_char"]
        assert row["text"] == want + text[at:]


def test_matches_without_items_or_documents(spark):
    docs = docs_df(spark, ["alpha beta", None])
    rows = decontamination.matches(docs, items_df(spark, []).limit(0)).orderBy("doc_id").collect()
    assert [(r["n_words"], r["spans"], r["items"]) for r in rows] == [(2, [], []), (0, [], [])]
    assert decontamination.matches(docs.limit(0), items_df(spark, [(1, "a")])).count() == 0


def test_rows_that_share_an_id_keep_their_own_matches(spark):
    leak = " ".join(WORDS)
    docs = docs_df(spark, [leak, "clean", leak, leak + " more"], [7, 7, 7, 7])
    for block_bytes in (1 << 20, 40):
        rows = decontamination.matches(docs, items_df(spark, [(1, leak), (2, "Zwölf Boxkämpfer")]), block_bytes=block_bytes).collect()
        assert sorted((r["n_words"], len(r["spans"]), tuple(r["items"])) for r in rows) == [(1, 0, ()), (10, 1, (1,)), (10, 1, (1,)), (11, 1, (1,))]


def test_spans_merge_across_passes(spark):
    row = spark.range(1).select(F.expr("array(named_struct('start', 5, 'end', 9, 'from_char', 50, 'to_char', 90), named_struct('start', 0, 'end', 5, 'from_char', 0, 'to_char', 49), named_struct('start', 20, 'end', 30, 'from_char', 200, 'to_char', 300), named_struct('start', 22, 'end', 24, 'from_char', 220, 'to_char', 240))").alias("spans"))
    assert [tuple(x) for x in row.select(decontamination.merged(F.col("spans")).alias("s")).first()["s"]] == [(0, 9, 0, 90), (20, 30, 200, 300)]


def test_blocks_hold_every_item_once(spark):
    rows = [(i, "word " * (i % 7)) for i in range(50)] + [(None, None)]
    tables = list(item_blocks.blocks(items_df(spark, rows), "item_id", "text", 100))
    assert len(tables) > 3 and sorted(i or -1 for t in tables for i in t["item"].to_pylist()) == sorted(i or -1 for i, _ in rows)


# Ranked search


def plain_ranking(docs, items, k=10):
    tf = [Counter(words_of(t)) for _, t in docs]
    n_docs, n_terms = sum(bool(c) for c in tf), sum(c.total() for c in tf)
    df = Counter(t for c in tf for t in c)
    terms = defaultdict(set)
    for ident, text in items:
        terms[ident] |= set(words_of(text))
    out = []
    for ident, own in terms.items():
        scores = []
        for (doc, _), c in zip(docs, tf, strict=True):
            m = 10 + 90 * c.total() * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(ident, rank + 1, None if null else doc, -score) for rank, (score, null, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block_bytes", "partitions", "k"), [(1 << 22, 1, 10), (1 << 22, 4, 3), (600, 3, 10)])
def test_ranking_is_that_of_the_plain_version(spark, block_bytes, partitions, k):
    docs, items = random_corpus(9)
    ids = [None if i in (5, 40) else i % 70 for i in range(len(docs))]
    found = ranked_search.search(docs_df(spark, docs, ids).repartition(partitions), items_df(spark, items), k, block_bytes=block_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_ranking(list(zip(ids, docs, strict=True)), items, k)


def test_ranking_of_copies_goes_by_id(spark):
    docs = docs_df(spark, ["same text here"] * 400 + ["other"] * 100, list(range(500, 0, -1)))
    rows = ranked_search.search(docs.repartition(3), items_df(spark, [(1, "SAME here"), (2, "none of it")])).orderBy("rank").collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in rows] == [(1, i, 100 + i) for i in range(1, 11)]


def test_ranking_of_nothing(spark):
    docs, items = docs_df(spark, ["alpha", None, ""]), items_df(spark, [(1, "alpha"), (2, None)])
    assert ranked_search.search(docs.limit(0), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    assert ranked_search.search(docs.where("text IS NULL"), items).count() == 0


def test_radix_order_is_stable():
    rng = np.random.default_rng(1)
    for top in (1, 300, 1 << 20, 1 << 40):
        keys = rng.integers(0, top, 5000)
        assert (ranked_search.radix_order(keys) == np.argsort(keys, kind="stable")).all()


def test_long_products_are_exact():
    assert ranked_search.lengths(np.array([10**7]), 10**12, 10**15).tolist() == [10 + 90 * 10**7 * 10**12 // 10**15]


# Fill-in-middle


def plain_middle(ident, text, seed="1"):
    text, h = text or "", hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_middle_is_that_of_the_plain_version_and_comes_back(spark):
    rng = random.Random(4)
    alphabet = ["a", "<", "S", ">", "P", "M", "<P", "é", "日", "🙂", "\0", "\n", "<S", "M>"]
    texts = [*EDGES, "<P>", "x<M>y", "日本🙂é" * 2000, "a" * 1024, "é" * 512, "a" * 1025] + ["".join(rng.choices(alphabet, k=rng.choice([1, 2, 5, 30, 3000]))) for _ in range(150)]
    ids = [None if i == 3 else i // 2 for i in range(len(texts))]
    made = fill_in_middle.transformed(docs_df(spark, texts, ids).repartition(3))
    rows = made.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    want = Counter((i, *plain_middle(i, t), t or "") for i, t in zip(ids, texts, strict=True))
    assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in rows) == want
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert fill_in_middle.transformed(docs_df(spark, texts, ids).limit(0)).count() == 0


def test_checkpoints_find_every_code_point():
    rng = random.Random(8)
    texts = ["", "a" * 5000, "é" * 3000, "".join(rng.choices("aé日🙂", k=4000)), "", "🙂"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    found = fill_in_middle.Checkpoints(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert found.lengths.tolist() == [len(t) for t in texts]
    for i, text in enumerate(texts):
        for point in sorted({0, len(text), *(rng.randint(0, len(text)) for _ in range(200))}):
            assert found.byte_of(i, point) == len(text[:point].encode())


# Training of the toxicity classifier on texts of any length


def test_a_labelled_text_that_is_too_long_takes_no_other_out(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("good fine nice".split() if i % 2 else "vile bad foul".split(), k=30)) for i in range(120)]
    known = [r["i"] for r in spark.range(120).withColumnRenamed("id", "i").where(~toxicity.held_out(F.col("i"))).orderBy(F.xxhash64("i")).collect()]
    for place in (0, 10):  # of the ids in the order in which they are taken
        long = list(texts)
        long[known[place]] = "long " * 20_000
        labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)], "doc_id bigint, toxic int")
        docs = docs_df(spark, long)
        got = {r["_id"] for r in toxicity.sampled(docs, labels, 10_000, 50_000, "doc_id", "text", "toxic").collect()}
        assert got == set(known) - {known[place]}
        scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, toxicity.trained(docs, labels, train_bytes=50_000)).collect()}
        assert all((scores[i] > 0.5) == (i % 2 == 0) for i in range(120) if i != known[place])
    with pytest.warns(UserWarning, match="nothing is learnt"):
        assert toxicity.sampled(docs, labels, 10_000, 3, "doc_id", "text", "toxic").count() == 0


def test_rows_without_id_are_spread_over_blocks(spark):
    docs = docs_df(spark, [f"text number {i}" for i in range(400)], [None] * 300 + list(range(100)))
    got = mixing.mixture(docs.withColumn("source", F.lit("one")), block_docs=20).where("pass = 0")
    rows = got.groupBy("block", F.col("doc_id").isNull().alias("none")).count().where("none").collect()
    assert got.count() == 400 and len(rows) == 20 and max(r["count"] for r in rows) < 60
