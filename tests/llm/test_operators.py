"""Every operator on edge cases, and against a brute-force version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from scrollspark.llm import bytesops, chat_format, exact_dedup, graph, jaccard_join, jpeg_media, mixing, queries, sentencepiece_nbest, suffix_dedup, tables, toxicity, url_rules, warc
from tests.conftest import rows_of, rows_of_sql

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i * i % 977}" for i in range(20_000))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _text string, _key string, _id string, score string, sender string, token string"


def docs_df(spark, texts, ids=None):
    """Documents with extra columns whose names clash with inner ones."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", 0, "x", "x", "x", "x", "x", "x") for i, t in zip(ids, texts, strict=True)], DOCS)


def random_texts(n=60, seed=1):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("alpha beta gamma delta Épée ñu zeta Eta theta iota kappa".split()) + str(rng.randint(0, 60)) for _ in range(rng.choice([3, 8, 60, 150]))) for _ in range(n // 3)]
    out = []
    for _ in range(n):
        words = rng.choice(pool).split(" ")
        for _ in range(rng.choice([0, 0, 1, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 9)}"
        out.append(" ".join(words) if rng.random() < 0.8 else " ".join(words).upper())
    return out


EDGES = [None, "", " \t\n", "a", "A", "a b c d", "a b c d e", "É é", "a\nb", "<|x|> \\ ### </turn>", LONG, LONG, LONG.replace("w5", "y", 1), "same text", "same text", "SAME text", "日本語 テキスト 🙂", "nul\0byte"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_has_the_oracles_rows(spark, duck, data, name):
    df = queries.QUERIES[name](spark, data)
    assert rows_of(df) == rows_of_sql(duck, queries.ORACLE_SQL[name])


# Chat formatting


def test_chat_round_trip(spark):
    rng = random.Random(2)
    pieces = ["\\", "###", "### User: ", "</turn>", "</turn>\n", "\n", "a", "", " ", "\\\\", "É", "#", "</", "turn>"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd: role\n#", "", None]), rng.choice([None, "".join(rng.choices(pieces, k=rng.randint(0, 8)))])) for c in range(40) for t in range(rng.randint(1, 4))]
    rows += [(100, 0, "user", LONG), (101, 1, "assistant", "tie"), (101, 1, "assistant", "tie"), (None, None, None, None), *queries.PROBE]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, turns string, formatted string")
    formatted = chat_format.formatted(df)
    back = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    texts, masked = defaultdict(str), defaultdict(list)
    for r in formatted.orderBy("part").collect():
        texts[r["conv_id"]] += r["formatted"]
        masked[r["conv_id"]] += [r["formatted"][a:b] for a, b in r["loss_spans"]]
    source = defaultdict(list)
    for c, t, role, text in rows:
        source[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(back) == set(source)
    for c, turns in source.items():
        turns = sorted(turns)
        assert chat_format.recovered(texts[c]) == [(r, x) for _, r, x in turns]
        loss = "".join(x for _, r, x in turns if r == "assistant")
        row = back[c]
        assert row["n_turns"] == len(turns) and row["formatted_chars"] == len(texts[c])
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert masked[c] == [texts[c][a:b] for r, _, a, b in chat_format.parsed(texts[c]) if r == "assistant"]
        assert len(masked[c]) == sum(r == "assistant" for _, r, _ in turns)
    assert chat_format.read_back(chat_format.formatted(df.limit(0))).count() == 0


def test_plain_turns_are_not_escaped():
    assert chat_format.formatted_turns([("user", "a\\b # c"), ("assistant", "d")]) == ("### User: a\\b # c</turn>\n### Assistant: d</turn>\n", 0)
    with pytest.raises(chat_format.GrammarError):
        list(chat_format.parsed("### User: open"))


# WARC


def pages_df(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id bigint, url string, html string, archive string, payload_digest string")


def test_warc_edges(spark):
    big = "é" * 60
    rows = [(1, "http://a/\r\nX: y", big), (5, None, big), (3, "http://b", big), (2, "http://c", None), (4, "http://d", ""), (6, "http://e", "short"), (7, "http://f", "short"), (8, "http://g", LONG), (9, "h", "\r\n\r\nWARC/1.1\r\n"), (None, "n", "z" * 200)]
    got = {r["id"]: r for r in warc.archived(pages_df(spark, rows), payload=True).collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        r, raw = got[None if i is None else str(i)], (html or "").encode()
        copy = i in (3, 5)
        assert (r["type"], r["refers_to"]) == (("revisit", "1") if copy else ("response", None))
        assert (r["size"], r["digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert r["payload"] is None if copy else bytes(r["payload"]) == raw
        assert (r["url"] is None) == (url is None)
    assert warc.archived(pages_df(spark, rows).limit(0)).count() == 0
    twice = warc.archived(pages_df(spark, [(1, "a", big), (1, "a", big), (1, "b", "x"), (2, "c", big)])).collect()
    assert sorted((r["id"], r["type"]) for r in twice) == [("1", "response")] * 3 + [("2", "revisit")]
    odd = [("a>b", "u", big), ("c\r\nX: d%20", "u", "x"), ("", "u", "y"), (None, "u", "z"), ("zé", "u", big)]
    back = warc.archived(spark.createDataFrame(odd, "page_id string, url string, html string")).collect()
    assert {r["id"]: r["refers_to"] for r in back} == {"a>b": None, "c\r\nX: d%20": None, "": None, None: None, "zé": "a>b"}


def test_every_archive_has_its_task(spark):
    names = spark.createDataFrame([(f"a{i * 7919 % 101:03d}", 1) for i in range(101)], "archive string, records bigint")
    per_task = warc._spread(spark, names).groupBy(F.spark_partition_id()).count()
    assert {r["count"] for r in per_task.collect()} == {1}
    assert warc._spread(spark, names.limit(0)).count() == 0


def test_normaliser_takes_any_gzip(tmp_path):
    records = [warc.record(i, f"u{i}", b"x" * i, "", i, None).replace(b"WARC-Payload-Digest: sha256:\r\n", b"") for i in (0, 1, 70_000)]
    engine = zlib.compressobj(9, zlib.DEFLATED, 31)
    one = engine.compress(b"".join(records)) + engine.flush()
    members = b"".join(warc.zlib.compress(r, 1, 31) for r in records)
    for raw in (one, members):
        (tmp_path / "in.gz").write_bytes(raw)
        assert warc.normalise_file(str(tmp_path / "in.gz"), str(tmp_path / "out.gz")) == 3
        data, index = (tmp_path / "out.gz").read_bytes(), (tmp_path / "out.gz.idx").read_text().splitlines()
        import json

        for line, record in zip(index, records, strict=True):
            entry = json.loads(line)
            assert zlib.decompress(data[entry["offset"] : entry["offset"] + entry["length"]], 31) == record
    (tmp_path / "in.gz").write_bytes(one[:-20])
    with pytest.raises((ValueError, zlib.error)):
        warc.normalise_file(str(tmp_path / "in.gz"), str(tmp_path / "out.gz"))


# Toxicity


def toxic_set(n=600, seed=5):
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        words = ["".join(rng.choices("abcdefg", k=4)) for _ in range(rng.randint(5, 60))]
        label = int(rng.random() < 0.3)
        if label:
            words[rng.randrange(len(words))] = rng.choice(["zorkly", "quuxen"])
        texts.append(" ".join(words))
        labels.append(label)
    return texts, labels


def test_toxicity_learns_and_scores_edges(spark):
    texts, labels = toxic_set()
    docs = docs_df(spark, texts + EDGES)
    marks = spark.createDataFrame([(i, x, 1) for i, x in enumerate(labels)] + [(0, None, 1), (None, 1, 1), (9999, 1, 1)], "doc_id bigint, toxic int, quality int")
    model = toxicity.trained(docs, marks)
    rows = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert len(rows) == len(texts) + len(EDGES) and all(0 <= r["score"] <= 1 for r in rows.values())
    test = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((rows[i]["score"] >= 0.7) == bool(labels[i]) for i in test)
    assert right >= 0.95 * len(test)
    base = len(texts)
    assert rows[base]["score"] == rows[base + 1]["score"]
    assert toxicity.scored(docs.limit(0), model).count() == 0
    held = [r["doc_id"] for r in docs.where(toxicity.held_out(F.col("doc_id"))).collect()]
    assert held == [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 3 == 1]
    nothing = toxicity.trained(docs, marks.where("toxic = 0"))
    assert 0 < toxicity.scored(docs, nothing).first()["score"] < 0.5
    assert toxicity.trained(docs, marks.limit(0)).bias == 0.0


def plain_scores(train, labels, texts, sizes):
    """The classifier with dictionaries and Newton's method: ratios, quarter for the shift, and fit."""
    grams = lambda t: {"".join(" " if c in " \t\n\x0b\f\r" else c.lower() for c in t)[i : i + n] for n in sizes for i in range(len(t) - n + 1)}
    sets = [grams(t) for t in train]
    known = sorted(g for g, k in Counter(g for x in sets for g in x).items() if k >= toxicity.LEAST_TEXTS)

    def fit(use):
        some, y = [sets[i] for i in use], np.array([labels[i] for i in use], float)
        n = [int((y == k).sum()) for k in (0, 1)]
        ratio = {}
        for g in known:
            p, q = (sum(g in x for x, label in zip(some, y, strict=True) if label == k) for k in (1, 0))
            if p + q >= toxicity.LEAST_TEXTS:
                ratio[g] = math.log((p + 1) / (n[1] + 2) / ((q + 1) / (n[0] + 2)))
        rows = lambda xs: np.array([[1.0] + [ratio[g] if g in x else 0.0 for g in ratio] for x in xs])
        x, w = rows(some), np.zeros(len(ratio) + 1)
        ridge = np.full(len(w), toxicity.PENALTY / len(y))
        ridge[0] = 0
        for _ in range(60):
            p = 1 / (1 + np.exp(-x @ w))
            w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(ridge + 1e-12), x.T @ (p - y) / len(y) + ridge * w)
        return lambda xs: rows(xs) @ w

    tried = [i for i in range(len(train)) if i % 4 == 0]
    margin = fit([i for i in range(len(train)) if i % 4])([sets[i] for i in tried])
    best, shift = -1.0, 0.0
    for k in range(int(math.log((len(labels) - sum(labels)) / sum(labels)) * 4 + 1e-6) + 1):
        hit = [m + k / 4 >= math.log(7 / 3) for m in margin]
        f1 = 2 * sum(h and labels[i] for h, i in zip(hit, tried, strict=True)) / max(1, sum(hit) + sum(labels[i] for i in tried))
        if f1 > best:
            best, shift = f1, k / 4
    return 1 / (1 + np.exp(-fit(range(len(train)))([grams(t) for t in texts]) - shift))


def test_toxicity_agrees_with_a_plain_fit(monkeypatch):
    monkeypatch.setattr(toxicity, "PENALTY", 5.0)
    rng = random.Random(3)
    train, labels = [], []
    for _ in range(120):
        label = int(rng.random() < 0.3)
        train.append("".join(rng.choices("aB" if label else "ab\n", weights=[3, 4] if label else [3, 2, 1], k=rng.randint(0, 30))))
        labels.append(label)
    texts = ["", "aaaa", "bBbb", "a\nb\ta", *train[:40]]
    parts = [bytesops.utf8(pa.array(train[a : a + 50])) for a in range(0, 120, 50)]
    model = toxicity.fitted(parts, [np.array(labels[a : a + 50]) for a in range(0, 120, 50)], sizes=(1, 2, 3), penalty=5.0, steps=20_000)
    assert np.abs(model.scores(*bytesops.utf8(pa.array(texts))) - plain_scores(train, labels, texts, (1, 2, 3))).max() < 1e-4


def test_toxicity_sample_is_bounded_and_has_one_text_an_id(spark):
    docs = spark.createDataFrame([(i % 40, f"{i:03d} text" * (1 + i % 3), 0) for i in range(120)] + [(99, None, 0)], "doc_id bigint, text string, score int")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in (*range(40), 99)], "doc_id bigint, toxic int")
    rows = lambda r, b: toxicity.sampled(docs, marks, r, b, "doc_id", "text", "toxic").collect()
    every = rows(1000, 1 << 20)
    assert [r["_id"] for r in sorted(every)] == [i for i in (*range(40), 99) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert all(r["_text"] == (f"{r['_id']:03d} text" * (1 + r["_id"] % 3) if r["_id"] < 40 else "") for r in every)
    assert len(rows(7, 1 << 20)) == 7
    assert 0 < sum(len(r["_text"]) for r in rows(1000, 100)) <= 100


def test_toxicity_passes_any_columns_on(spark):
    model = toxicity.Model(bytesops.span_hashes(bytesops.prefix_codes(np.frombuffer(b"bad", np.uint8)), np.array([0]), np.array([3])), np.array([9.0]), -4.0)
    docs = spark.createDataFrame([(1, "so bad", 0.5, "x"), (2, "good", 0.5, None), (None, None, None, None)], "doc_id bigint, text string, score double, `a.b` string")
    kept = toxicity.accepted(docs, model)
    assert kept.schema == docs.schema and [r["doc_id"] for r in kept.collect()] == [2, None]


def test_toxicity_features_are_code_points():
    data, offsets = bytesops.utf8(pa.array(["éab", "ab"]))
    assert [len(h) for h, _ in toxicity.ngrams(data, offsets, (2,))] == [3]


# Hashes


def thue_morse(doublings, a="a", b="b"):
    text = a
    for _ in range(doublings):
        text += text.translate(str.maketrans(a + b, b + a))
    return text


TWINS = [(t, t.translate(str.maketrans("ab", "ba"))) for t in map(thue_morse, range(10, 13))]


def test_hashes_tell_thue_morse_strings_apart():
    texts = [x for pair in TWINS for x in pair] + [thue_morse(k) for k in range(10)]
    data, offsets = bytesops.utf8(pa.array(texts))
    starts, ends, _ = bytesops.word_spans(data, offsets)
    assert len(np.unique(bytesops.word_hashes(data, starts, ends))) == len(texts)
    for x, y in TWINS:
        words = lambda t: np.array([17 if c == "a" else 99 for c in t], np.uint64)
        assert bytesops.shingle_hashes(words(x), len(x))[0] != bytesops.shingle_hashes(words(y), len(y))[0]


def test_long_words_do_not_collide_in_any_operator(spark, vocabulary):
    texts = [f"{w} {tail}" for pair in TWINS for w in pair for tail in ("q r x z", " ".join(f"v{i}" for i in range(60)))]
    texts += [" ".join([*pair[k : k + 1], *(f"u{n}x{i}" for i in range(55))]) for n, pair in enumerate(TWINS) for k in (0, 1)]
    df = docs_df(spark, texts)
    rows = {r["doc_id"]: r for r in sentencepiece_nbest.summarised(df, vocabulary, 2).collect()}
    assert all(rows[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts))
    got = {r["doc_id"]: [[s["start"], s["end"]] for s in r["spans"]] for r in suffix_dedup.repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute_spans(texts, range(len(texts)))
    joined = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.joined(df).collect()}
    assert [joined[i] for i in range(len(texts))] == brute_components(texts)


def test_colliding_segments_are_encoded_again(vocabulary, monkeypatch):
    data, offsets = bytesops.utf8(pa.array(["the cat sat on the mat", "", "a dog héllo 日本", None]))
    right = sentencepiece_nbest.encode(sentencepiece_nbest.Lattice(vocabulary), data, offsets, 3)
    monkeypatch.setattr(sentencepiece_nbest, "byte_hashes", lambda d, a, b: (b - a).astype(np.uint64))
    lattice = sentencepiece_nbest.Lattice(vocabulary)
    for _ in range(2):
        got = sentencepiece_nbest.encode(lattice, data, offsets, 3)
        assert got.ids.tolist() == right.ids.tolist() and got.changes == right.changes and np.allclose([x for s in got.scores for x in s], [x for s in right.scores for x in s])


@pytest.mark.parametrize("ids", ["bigint", "string", "double"])
def test_long_conversations_are_read_back_in_pieces(spark, monkeypatch, ids):
    monkeypatch.setattr(chat_format, "PIECE_BYTES", 100)
    kind = {"bigint": int, "string": lambda i: f"c{i:02}", "double": lambda i: float("nan") if i == 29 else float(i)}[ids]
    rows = [(kind(i), t, "assistant", f"{i} {t} " + "x" * 40) for i in range(30) for t in range(2)]
    # One conversation with most of all turns, many of them at one place.
    rows += [(kind(13), 2 + t // 2 if t < 300 else 500, ("user", "assistant")[t % 2], f"{t:03} ### é" * (t % 9)) for t in range(600)]
    rows = [r for i, r in enumerate(rows) if i % 2] + [r for i, r in enumerate(rows) if not i % 2]
    documents = chat_format.formatted(spark.createDataFrame(rows, f"conv_id {ids}, turn int, role string, text string"))
    pieces = documents.groupBy("conv_id").count().where("count > 20").collect()
    assert [r["conv_id"] for r in pieces] == [kind(13)]
    got = {str(r["conv_id"]): r for r in chat_format.read_back(documents).collect()}
    assert len(got) == 30 == chat_format.read_back(documents).count()
    for i in range(30):
        turns = sorted((t, role, text) for c, t, role, text in rows if str(c) == str(kind(i)))
        row = got[str(kind(i))]
        assert row["n_turns"] == len(turns) and row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256("".join(x for _, r, x in turns if r == "assistant").encode()).hexdigest()


# SentencePiece


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece_nbest.Vocabulary.load(queries.PIECE_MODEL)


def brute_nbest(vocabulary, text, n):
    """All segmentations of a short text by recursion, best first."""
    raw = b" " + text.encode().replace(b"\xe2\x96\x81", b"\xff")
    index = vocabulary.index

    def ways(at):
        if at == len(raw):
            yield 0.0, ()
            return
        size = sentencepiece_nbest.char_size(raw[at])
        steps = [(at + k, *index[raw[at : at + k]]) for k in range(1, vocabulary.longest + 1) if raw[at : at + k] in index and at + k <= len(raw)]
        if raw[at : at + size] not in index:
            steps.append((at + size, -1, vocabulary.unknown))
        for end, piece, score in steps:
            ids = (piece,) if piece >= 0 else tuple(vocabulary.byte_ids[b] for b in raw[at:end])
            for rest, tail in ways(end):
                yield score + rest, ids + tail

    return sorted({w for w in ways(0)}, key=lambda w: -w[0])[:n]


@pytest.mark.parametrize("text", ["a", "the cat", "in on a", "héllo", "日 本", "a\nb", "  two"])
def test_nbest_is_exact(vocabulary, text):
    lattice = sentencepiece_nbest.Lattice(vocabulary)
    got = sentencepiece_nbest.encode(lattice, *bytesops.utf8(pa.array([text])), 4)
    want = brute_nbest(vocabulary, text, 4)
    assert got.scores[0] == [s for s, _ in want]
    lists = [tuple(x) for x in sentencepiece_nbest.segmentations(got.ids.tolist(), got.changes[0])]
    assert len(set(lists)) == len(lists) and lists[0] in {ids for s, ids in want if s == want[0][0]}


def test_encoding_edges(spark, vocabulary):
    texts = [*EDGES, "▁ mark", "x" * 500, "no" * 40 + " " + "y" * 70]
    docs = docs_df(spark, texts)
    rows = {r["doc_id"]: r for r in sentencepiece_nbest.summarised(docs, vocabulary).collect()}
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        assert (rows[i]["decoded_bytes"], rows[i]["decoded_sha256"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert rows[i]["alternatives_decode"] and (rows[i]["n_tokens"] == 0) == (not raw)
    assert rows[13]["ids_sha256"] == rows[14]["ids_sha256"]
    tokens = {r["doc_id"]: r for r in sentencepiece_nbest.encoded(docs, vocabulary).collect()}
    assert all(len(tokens[i]["ids"]) == rows[i]["n_tokens"] and tokens[i]["scores"][0] == rows[i]["score"] for i in rows)
    assert sentencepiece_nbest.summarised(docs.limit(0), vocabulary).count() == 0


def test_unbroken_texts_take_linear_steps(vocabulary, monkeypatch):
    """Scores that do not add up exactly make many paths that are all but equal."""
    odd = sentencepiece_nbest.Vocabulary(vocabulary.pieces, vocabulary.ids, [x * 0.1234567 for x in vocabulary.scores], vocabulary.byte_ids)
    for words in (vocabulary, odd):
        lattice, calls = sentencepiece_nbest.Lattice(words), []
        edges = lattice.edges_to
        monkeypatch.setattr(lattice, "edges_to", lambda *x, calls=calls, edges=edges: calls.append(1) or edges(*x))
        price = dict(zip(words.ids, words.scores, strict=True))
        for text in ("a" * 3000, "ab-" * 1000, "日本語" * 300 + "x" * 3000, "".join(random.Random(4).choices("etaoinshrdlu", k=3000))):
            calls.clear()
            raw = b" " + text.encode()
            found = lattice.nbest(raw, 5)
            assert len(found) == 5 and len(calls) <= 6 * len(raw)
            assert len({tuple(ids) for _, ids in found}) == 5 and [x for x, _ in found] == sorted((x for x, _ in found), reverse=True)
            for score, ids in found:
                assert sentencepiece_nbest.decoded_bytes(lattice, ids) == raw
                assert not set(ids) <= set(price) or np.isclose(score, sum(price[i] for i in ids))


# Suffix arrays


def test_minimisers_of_long_texts(monkeypatch):
    grams = np.random.default_rng(3).integers(0, 50, 5000).astype(np.uint64)
    want = sorted({i + int(np.argmin(grams[i : i + 43])) for i in range(len(grams) - 42)})
    for chunk in (7, 4958, 6_000):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        assert suffix_dedup.minimisers(grams, 43).tolist() == want


def brute_spans(texts, ids, least=50):
    owner, repeated, windows = {}, set(), []
    for i, text in zip(ids, texts, strict=True):
        w = WORD.findall((text or "").translate(FOLD))
        keys = [tuple(w[j : j + least]) for j in range(len(w) - least + 1)]
        windows.append(keys)
        for k in keys if i is not None else ():
            if owner.setdefault(k, i) != i:
                repeated.add(k)
    out = []
    for keys in windows:
        spans = []
        for j, k in enumerate(keys):
            if k in repeated:
                if spans and j <= spans[-1][1]:
                    spans[-1][1] = j + least
                else:
                    spans.append([j, j + least])
        out.append(spans)
    return out


@pytest.mark.parametrize("hot", [1, 3, 200_000])
def test_repeats_are_exact(spark, hot):
    rng = random.Random(8)
    fresh = lambda n: [f"{rng.getrandbits(40):x}" for _ in range(n)]
    passage, line = fresh(80), fresh(30)
    texts = [*EDGES, *(" ".join(fresh(20) + passage[a : a + 49 + a % 3] + fresh(20) + line + fresh(5)) for a in range(0, 30, 2)), *random_texts(30, 3)]
    texts += [" ".join(passage[:25] + passage[:60]), " ".join(line * 3)]
    got = {r["doc_id"]: [[s["start"], s["end"]] for s in r["spans"]] for r in suffix_dedup.repeats(docs_df(spark, texts), hot_rows=hot).collect()}
    assert [got[i] for i in range(len(texts))] == brute_spans(texts, range(len(texts)))


def test_repeats_with_ids_of_other_types(spark):
    words = " ".join(f"z{i}" for i in range(60))
    docs = spark.createDataFrame([("b", words), ("a", "more " + words), (None, words), ("c", None)], "doc_id string, text string")
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in suffix_dedup.repeats(docs).collect()}
    assert got == {"b": [(0, 60)], "a": [(1, 61)], None: [], "c": []}


def test_runs_over_many_batches_are_compared_as_one():
    gram, least = 2, 4
    rng = np.random.default_rng(3)
    n = 60
    table = pa.table({
        "run": pa.array(np.repeat([1, 2, 3], [5, 45, 10])), "part": pa.array(np.zeros(n), pa.int32()), "parts": pa.array(np.ones(n), pa.int32()), "doc": pa.array(np.arange(n) % 30), "at": pa.array(np.full(n, 2), pa.int32()),
        "before": pa.array([rng.integers(0, 2, 2).astype(">u4").tobytes() for _ in range(n)]), "after": pa.array([rng.integers(0, 2, 2).astype(">u4").tobytes() for _ in range(n)]),
    })
    spans = lambda size: sorted(r for b in suffix_dedup._matches(gram, least)(iter(table.to_batches(size))) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    before, suffix_dedup.CHUNK = suffix_dedup.CHUNK, 8
    try:
        assert spans(3) == spans(7) == spans(n)
    finally:
        suffix_dedup.CHUNK = before


def test_windows_that_matches_cover_leave_a_task_once(spark, monkeypatch):
    rng = random.Random(11)
    fresh = lambda n: [f"{rng.getrandbits(40):x}" for _ in range(n)]
    line, passage = fresh(7), fresh(120)
    made, plain = {}, suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", lambda df, name: made.setdefault(name, plain(df, name)))
    rows = []
    for copies in (40, 80):
        made.clear()
        texts = [" ".join(fresh(5) + passage + line * 20 + fresh(60)) for _ in range(copies)]
        got = {r["doc_id"]: [[s["start"], s["end"]] for s in r["spans"]] for r in suffix_dedup.repeats(docs_df(spark, texts), hot_rows=3).collect()}
        assert [got[i] for i in range(copies)] == brute_spans(texts, range(copies))
        rows.append(made["suffix-windows"].count())
    # Of the about 300 windows of a text, those at the edge of what it shares are its own.
    assert rows[0] < 40 * 50 + 4 * 300 and rows[1] < 80 * 50 + 4 * 300


def test_repeats_within_one_id_do_not_count(spark):
    df = docs_df(spark, [LONG, LONG, None], [1, 1, 2])
    assert all(not r["spans"] for r in suffix_dedup.repeats(df).collect())
    assert suffix_dedup.repeats(df.limit(0)).count() == 0
    mixed = docs_df(spark, [LONG, "too short", " ".join(f"z{i}" for i in range(60)), LONG], [1, 1, 1, 2])
    for hot in (0, 100):
        assert {(r["doc_id"], len(r["spans"])) for r in suffix_dedup.repeats(mixed, hot_rows=hot).collect()} == {(1, 1), (2, 1)}


# N-gram Jaccard join


def brute_components(texts, percent=80):
    sets = []
    for text in texts:
        w = WORD.findall((text or "").translate(FOLD))
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(n=90, seed=4):
    """Mutations of one text: some link to many others, some to none."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"m{rng.randint(0, 10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("options", [{}, {"few_sets": 2, "hot_sets": 2, "flush_tokens": 500, "bucket_tokens": 100, "block": 7}, {"few_sets": 1000, "hot_sets": 1000, "bucket_tokens": 1}])
def test_joined_components_are_exact(spark, options):
    texts = [*EDGES, *random_texts(), *near_copies()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.joined(docs_df(spark, texts), **options).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)


def short_pairs(n=200, seed=9):
    """Pairs of 5 to 15 words, the second with a word more at its end, one less or one changed."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"p{i}w{rng.randrange(10**6)}" for _ in range(rng.randint(5, 15))]
        out += [" ".join(words), " ".join(rng.choice([[*words, "more"], [*words, "more"], words[1:], [*words[:-1], "changed"]]))]
    return out


def test_links_of_short_texts_are_exact(spark):
    texts = short_pairs()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.joined(docs_df(spark, texts)).collect()}
    want = brute_components(texts)
    assert [i for i in range(len(texts)) if got[i] != want[i]] == []


def test_cells_follow_their_tokens():
    """Bytes for a token stay the same from few buckets to many more than 2**16, whatever the number of sets."""
    rng = np.random.default_rng(2)
    sizes = []
    for buckets in (3, 80, 1 << 12, 1 << 16, (1 << 16) + 1, 10**6):
        tokens = np.sort(rng.integers(0, 1 << 63, 40 * 64, dtype=np.uint64) * np.uint64(2))
        lost = np.uint64(jaccard_join._lost_bits(buckets))
        tokens = tokens >> lost << lost
        owners = np.sort(rng.integers(0, 3000, len(tokens)))
        bucket = jaccard_join.buckets_of(tokens, buckets)
        total = 0
        for b in np.unique(bucket).tolist():
            here = bucket == b
            cell = jaccard_join.packed(owners[here], tokens[here], b, buckets, b"rest")
            total += len(cell) - 16
            back = jaccard_join.unpacked(memoryview(cell), b, buckets)
            assert back[0].tolist() == owners[here].tolist() and back[1].tolist() == tokens[here].tolist() and bytes(back[2]) == b"rest"
        sizes.append(total / len(tokens))
    assert min(sizes) >= 7 and max(sizes) <= 7 + 4
    assert jaccard_join.shape_of(10**14, 200, None, None)[0] > 1 << 16
    buckets, flush = jaccard_join.shape_of(10**14, 200, None, None)
    assert flush / buckets >= 60 and flush < 1 << 25 + 1


def templates(n=400, seed=12):
    """Texts of four shared passages of six and some words of their own: most alike under 80 %, some just over."""
    rng = random.Random(seed)
    passages = [" ".join(f"t{p}w{i}" for i in range(30)) for p in range(6)]
    return [" ".join([*rng.sample(passages, 4), *(f"own{k}x{i}" for i in range(rng.randint(0, 9)))]) for k in range(n)]


@pytest.mark.parametrize("options", [{}, {"few_sets": 4, "hot_sets": 8, "flush_tokens": 2000, "block": 16}, {"few_sets": 4, "hot_sets": 8, "block": 64, "share": 30}])
def test_texts_of_shared_passages_are_exact(spark, monkeypatch, options):
    options = dict(options)
    monkeypatch.setattr(jaccard_join, "SHARE", options.pop("share", jaccard_join.SHARE))
    texts = templates()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.joined(docs_df(spark, texts), **options).collect()}
    want = brute_components(texts)
    assert [i for i in range(len(texts)) if got[i] != want[i]] == []


def test_join_takes_ids_of_other_types(spark):
    docs = spark.createDataFrame([("b", "a b c d e f g h i j"), ("a", "a b c d e f g h i j k"), (None, "x"), ("z", None)], "doc_id string, text string")
    assert sorted((r["doc_id"] or "", r["component_id"] or "") for r in jaccard_join.joined(docs).collect()) == [("", ""), ("a", "a"), ("b", "a"), ("z", "z")]
    assert sorted(r["doc_id"] or "" for r in jaccard_join.representatives(docs).collect()) == ["", "a", "z"]


def test_join_keeps_every_row(spark):
    df = docs_df(spark, ["a b c d e f", "a b c d e f", "x", None], [7, None, 7, 8])
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in jaccard_join.joined(df).collect()) == [(-1, 7), (7, 7), (7, 7), (8, 8)]
    kept = jaccard_join.representatives(docs_df(spark, ["a b c d e f g", "a b c d e f g", None], [3, 2, 1]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2] and kept.columns == df.columns
    assert jaccard_join.joined(df.limit(0)).count() == 0


def test_rows_that_share_an_id_have_their_own_verdicts(spark):
    texts = ["a b c d e f g h i j", "a b c d e f g h i j k", "not like any other text at all", "l m n o p q r s t"]
    kept = jaccard_join.representatives(docs_df(spark, texts, [1, 5, 5, 6]))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, texts[0]), (5, texts[2]), (6, texts[3])]


def test_components_of_large_graphs_too(spark, monkeypatch):
    rng = random.Random(6)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(5001, 5050)]
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    want = defaultdict(set)
    found = {r["node"]: r["component"] for r in graph.components(df).collect()}
    monkeypatch.setattr(graph, "SMALL", 0)
    rounds = {r["node"]: r["component"] for r in graph.components(df).collect()}
    assert found == rounds
    for node, component in found.items():
        want[component].add(node)
    assert all(min(nodes) == c for c, nodes in want.items())
    assert all(found[u] == found[v] for u, v in edges if u != v)
    assert graph.components(df.limit(0)).count() == 0


# Media columns


def test_media_edges(spark):
    rows = {r["doc_id"]: r for r in jpeg_media.described(jpeg_media.encoded(docs_df(spark, EDGES)), keep=("n_bytes",)).collect()}
    for i, text in enumerate(EDGES):
        raw = (text or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert rows[13].asDict() | {"doc_id": 0} == rows[14].asDict() | {"doc_id": 0}
    assert jpeg_media.encoded(docs_df(spark, EDGES).limit(0)).count() == 0
    none = jpeg_media.described(spark.createDataFrame([(1, None)], "doc_id bigint, media binary")).first()
    assert none["media_bytes"] is None


def test_every_byte_value_and_long_payloads():
    rng = np.random.default_rng(1)
    for n in (64, 640, 64 * jpeg_media.MAX_ROWS + 128):
        payload = rng.integers(0, 256, n).astype(np.uint8)
        (images,) = jpeg_media.thumbnails(jpeg_media.encode_payloads(payload, np.array([n])))
        assert b"".join(x.tobytes() for _, _, x in images) == payload.tobytes()
        assert len(images) == -(-n // (64 * jpeg_media.MAX_ROWS))


def colour_jpeg(blocks, restart=0):
    """A 4:2:0 JPEG of given (y0 y1 y2 y3 cb cr) DC levels for each MCU of one row, with an AC term in every block."""
    import struct

    ac_bits, ac_symbols = bytes([0, 2, 1] + [0] * 13), bytes([0x00, 0x01, 0xF0])
    dc = {s: (c, n) for s, c, n in jpeg_media.codes(jpeg_media.DC_BITS, jpeg_media.DC_SYMBOLS)}
    ac = {s: (c, n) for s, c, n in jpeg_media.codes(ac_bits, ac_symbols)}
    bits, out, before = "", b"", [0, 0, 0]

    def flush(bits):
        bits += "1" * (-len(bits) % 8)
        return int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00") if bits else b""

    for m, levels in enumerate(blocks):
        if restart and m and m % restart == 0:
            out += flush(bits) + bytes([0xFF, 0xD0 + (m // restart - 1) % 8])
            bits, before = "", [0, 0, 0]
        for k, level in enumerate(levels):
            c = 0 if k < 4 else k - 3
            d, before[c] = level - before[c], level
            size = abs(d).bit_length()
            code, n = dc[size]
            bits += f"{code:0{n}b}" + (f"{d if d > 0 else d + (1 << size) - 1:0{size}b}" if size else "")
            for symbol, extra in ((0xF0, ""), (0x01, "1"), (0x00, "")):
                code, n = ac[symbol]
                bits += f"{code:0{n}b}" + extra
    out += flush(bits)
    seg = jpeg_media._segment
    return b"".join((
        b"\xff\xd8", seg(0xE0, b"JFIF\0"), seg(0xDB, b"\0" + bytes([8] * 64)), seg(0xC0, struct.pack(">BHHB", 8, 16, 16 * len(blocks), 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])),
        seg(0xC4, b"\x00" + jpeg_media.DC_BITS + jpeg_media.DC_SYMBOLS + b"\x10" + ac_bits + ac_symbols), seg(0xDD, struct.pack(">H", restart)) if restart else b"",
        seg(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])), out, b"\xff\xd9",
    ))


@pytest.mark.parametrize("restart", [0, 1, 3])
def test_other_baseline_jpegs_decode(restart):
    rng = random.Random(9)
    blocks = [[rng.randint(-100, 100) for _ in range(6)] for _ in range(40)]
    ((w, h, thumb),) = jpeg_media.thumbnails([colour_jpeg(blocks, restart)])[0]
    want = np.array([[b[v * 2 + x] for b in blocks for x in (0, 1)] for v in (0, 1)]) + 128
    assert (w, h) == (640, 16) and (thumb == want).all()
    with pytest.raises(ValueError):
        jpeg_media.thumbnails([b"\xff\xd8\xff\xc2\x00\x0b\x08\x00\x08\x00\x08\x01\x01\x11\x00"])
    with pytest.raises(ValueError):
        jpeg_media.thumbnails([b"no image"])


# URL filters


def test_url_rules_agree_with_a_plain_matcher(spark):
    rng = random.Random(7)
    hosts = ["com", "example.com", "a.example.com", "example.net", "x.net", "EXAMPLE.org", "org", "examplecom", "com.evil", "", "notexample.com:80"]
    paths = ["", "/", "/en/", "/en/7", "/en/77", "/en/8", "/de/8", "/de/9?x=/en/7", "/es/#/", "/x.com/en/", "//com/en/", "/" + "y" * 5000 + ".com/en/"]
    urls = [f"{rng.choice(['http', 'HTTPS', 'a://b'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)] + [None, "", "no scheme/com/en/", "://com/en/1", "http://com"]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, host string, _canonical string")
    for r, url in zip(sorted(url_rules.judged(df, queries.URL_RULES).collect()), urls, strict=True):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0].translate(FOLD)
            path = re.match("[^?#]*", rest[len(re.match("[^/?#]*", rest)[0]) :])[0]
        fit = [x for x in queries.URL_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fit, key=lambda x: len(x.text), default=None)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best and best.text, best.action if best else "allow"), url
    assert url_rules.judged(df.limit(0), queries.URL_RULES).count() == 0
    assert {r["verdict"] for r in url_rules.judged(df, [], default="block").collect()} == {"block"}


def test_url_rules_of_the_query_are_those_of_its_contract(spark, tmp_path):
    listed = "block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/"
    assert ", ".join(f"{r.action} {r.text}" for r in queries.URL_RULES) == listed
    urls = ["http://com/en/", "http://a.example.com/en/77", "http://x.net/de/9", "http://example.net/de/7", "http://example.net/de/81", "http://a.org/es/", "http://net/en/"]
    spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").write.parquet(str(tmp_path / "pages.parquet"))
    found = sorted(queries.op8_url_filters(spark, str(tmp_path)).select("page_id", "rule", "verdict").collect())
    assert [(r["rule"], r["verdict"]) for r in found] == [
        ("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"), (None, "allow"),
    ]


def test_wildcards_inside_rules_agree_with_regular_expressions(spark):
    rng = random.Random(13)
    rules = [url_rules.Rule("block", h, p) for h, p in (("*.com", "/a"), ("x?z.net", "/"), ("net", "/*/b?/"), ("a*b.org", "/q*r*s"), ("org", "/*é"), ("d*", "/"), ("*", "/zz"))]
    urls = ["http://" + "".join(rng.choices(["a", "b", "x", "z", ".com", ".net", ".org", "x.z", "d"], k=rng.randint(1, 5))) + "".join(rng.choices(["/", "a", "b", "/b1/", "q", "r", "s", "é", "zz", "y" * 70], k=rng.randint(0, 9))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    text = lambda part, inside: "".join({"*": f"{inside}*", "?": inside}.get(c, re.escape(c)) for c in part)
    hits = 0
    for r in url_rules.judged(df, rules).collect():
        raw = f".{r['host']}{r['path']}".encode().decode("latin-1")
        fits = [x for x in rules if re.match(r"(?s)[^/]*" + text(f".{x.host}", "[^/]") + text(x.path.encode().decode("latin-1"), "."), raw)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        hits += best is not None
        assert r["rule"] == (best and best.text), raw
    assert 100 < hits < 1400


def test_very_long_urls_end_early():
    automaton = url_rules.ShiftAnd(queries.URL_RULES)
    urls = [".com/en/" + "x" * 3_000_000, ".other/" + "y" * 3_000_000, ".net"]
    began = time.perf_counter()
    assert automaton.match(*bytesops.utf8(pa.array(urls))).any(axis=1).tolist() == [True, False, False]
    assert time.perf_counter() - began < 2


# Exact dedup


@pytest.mark.parametrize("content_hash", [None, lambda text: F.length(text) % 3, lambda text: F.lit(b"one")])
@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_dedup_edges(spark, keep, content_hash):
    """Also with hashes under which very many texts collide: bytes decide."""
    texts, ids = [*EDGES, "same text", "lone"], [*range(len(EDGES)), None, 3]
    df = docs_df(spark, texts, ids)
    groups = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[(t or "").translate(FOLD)].append(i)
    best = {t: {"min": min, "max": max}[keep]([i for i in m if i is not None]) for t, m in groups.items()}
    want = sorted(((i if i is not None else -1), best[(t or "").translate(FOLD)], len(groups[(t or "").translate(FOLD)]), hashlib.sha256((t or "").translate(FOLD).encode()).hexdigest()) for i, t in zip(ids, texts, strict=True))
    got = exact_dedup.decisions(df, keep=keep, content_hash=content_hash).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)
    left = exact_dedup.deduplicated(df, keep=keep, content_hash=content_hash)
    assert left.columns == df.columns
    assert sorted((r["doc_id"], (r["text"] or "").translate(FOLD)) for r in left.collect()) == sorted((i, t) for t, i in best.items())
    assert exact_dedup.decisions(df.limit(0)).count() == 0


@pytest.mark.parametrize("keep", ["min", "max"])
def test_one_row_of_each_text_stays(spark, keep):
    rows = [(2, "same", 1.0), (2, "same", 2.0), (1, "Same", 3.0), (None, "x", 4.0), (None, "x", 5.0), (2, "b", 6.0), (3, "b", 7.0), (None, None, 8.0), (9, "", 9.0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, `a.b` double")
    got = sorted((r["doc_id"] or 0, (r["text"] or "").lower()) for r in exact_dedup.deduplicated(df, keep=keep).collect())
    assert got == sorted([(1 if keep == "min" else 2, "same"), (0, "x"), (2 if keep == "min" else 3, "b"), (9, "")])
    assert exact_dedup.deduplicated(df.limit(0), keep=keep).count() == 0


# Mixing


def plain_hash(*values):
    """Of 32-bit numbers, but 64-bit ones in lists; signed; null leaves the hash as it is."""
    h = 42
    for v in values:
        if v != [None]:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v[0]) if isinstance(v, list) else struct.pack("<i", v), seed=h)
    return h - (1 << 64) if h >> 63 else h


def plain_mixture(rows, target, most, block_docs, seed=1):
    """(id, source, pass, block, token_at, n) from (id, source, n), by a scan for the exponent and one ordered list for each pass."""
    total, docs = Counter(), defaultdict(list)
    for row in rows:
        total[row[1]] += row[2]
        docs[row[1]].append(row)
    known = [t for t in total.values() if t]

    def shares(a):
        return [t**a / sum(x**a for x in known) for t in known]

    fits = lambda a: -sum(x * math.log(x) for x in shares(a)) >= target * math.log(len(known))
    low = lambda a: max(x * sum(known) / t for x, t in zip(shares(a), known, strict=True)) > most
    steps = [k / 20_000 for k in range(20_001)]
    a = max(k for k in steps if fits(k))
    a = a if not low(a) else min((k for k in steps if not low(k)), default=1.0)
    out = []
    for source, members in docs.items():
        size = total[source]
        passes = size**a / sum(x**a for x in known) * sum(known) / size if size else 1.0
        blocks = -(-len(members) // block_docs)
        block_of = lambda i: plain_hash(seed, [i]) % blocks  # noqa: E731, B023
        for p in range(math.ceil(passes)):
            at, rest = 0, size if p + 1 <= passes else math.floor((passes - p) * size)
            for i, _, n in sorted(members, key=lambda r: (plain_hash(seed + 1, p, block_of(r[0])), plain_hash(seed + 2, p, [r[0]]))):  # noqa: B023
                if at + n <= rest:
                    out.append((i, source, p, block_of(i), p * size + at, n))
                at += n
    return a, out


@pytest.mark.parametrize(("target", "most"), [(0.95, 3.0), (0.8, 100.0), (0.999, 1.5)])
def test_mixture_agrees_with_a_plain_version(spark, target, most):
    rng = random.Random(11)
    texts = [" ".join(["w"] * rng.randint(0, 30)) for _ in range(300)]
    source = [rng.choices(["big", "mid", "tiny", None], [60, 20, 3, 5])[0] for _ in texts]
    df = spark.createDataFrame([(i, t if i else None, s, "x") for i, (t, s) in enumerate(zip(texts, source, strict=True))], "doc_id bigint, text string, source string, pass string")
    got = sorted((r["doc_id"], r["source"] or "", r["pass"], r["block"], r["token_at"], r["n_tokens"]) for r in mixing.mixture(df, target_entropy=target, max_repeats=most, block_docs=16).collect())
    size = [len((t if i else "").split()) for i, t in enumerate(texts)]
    a, want = plain_mixture(list(zip(range(300), source, size, strict=True)), target, most, 16)
    totals = Counter()
    for s, k in zip(source, size, strict=True):
        totals[s] += k
    assert abs(mixing.exponent([(float(v), 1) for v in totals.values()], target, most, float(sum(size))) - a) <= 1e-4
    # The exponents differ by up to a step of the scan, so the ends of last passes may differ by a document.
    want = sorted((i, s or "", *rest) for i, s, *rest in want)
    differ = set(got) ^ set(want)
    assert len(differ) <= 4 and len({r[:3] for r in got}) == len(got)
    assert all(r[2] == max(x[2] for x in got if x[1] == r[1]) for r in differ)


def test_exponents():
    sizes = [(1000.0, 1), (10.0, 1), (1.0, 2)]
    for goal in (0.5, 0.9, 1.0):
        a = mixing.exponent(sizes, goal, 1e9, None)
        assert mixing.entropy(sizes, a) >= goal * np.log(4) - 1e-9
        assert a == 1.0 or mixing.entropy(sizes, min(1.0, a + 1e-3)) < goal * np.log(4)
    assert mixing.repeats(sizes, mixing.exponent(sizes, 1.0, 2.0, None), None) <= 2 + 1e-9
    assert mixing.exponent([], 1.0, 2.0, None) == 1.0


def test_whole_mixture_keeps_every_row(spark):
    df = docs_df(spark, [*EDGES, "dup id", None], [*range(len(EDGES)), 4, None])
    got = mixing.mixed(df, target_entropy=0.99, max_repeats=2.0, whole=True)
    times = Counter(r["doc_id"] for r in got.collect())
    assert got.columns == df.columns and set(times) == {*range(len(EDGES)), None} and max(times.values()) <= 4
    assert mixing.mixed(df.limit(0), whole=True).count() == 0 and mixing.mixture(df.limit(0)).count() == 0


def test_whole_mixture_of_very_many_sources_keeps_every_row(spark):
    row = F.col("id")
    source = F.when(row < 101, "large").when(row < 201, "less").otherwise(F.concat(F.lit("s"), row))
    df = spark.range(100_202).select(row.alias("doc_id"), F.when(row < 201, "w w w w w w w w w w").otherwise("w").alias("text"), source.alias("source"))
    got = mixing.mixture(df, target_entropy=1.0, max_repeats=2.0, whole=True).where("pass = 0").groupBy((F.col("source") == "large").alias("large")).count()
    assert {r["large"]: r["count"] for r in got.collect()} == {True: 101, False: 100_101}


# The pipeline


def test_pipeline_stages(spark, data):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, seen = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data)
        assert docs.columns == columns, name
        left = {r["doc_id"] for r in docs.collect()}
        assert left <= seen
        seen = left
    with tables.scratch() as made:
        last = pipeline.run(spark, data)
    assert {r["doc_id"] for r in last.collect()} == seen and "n_tokens" in last.columns
    there = [x for x in made if Path(x.removeprefix("file:")).exists()]
    assert len(made) > 10 and len(there) == 1 and "stage-sentencepiece" in there[0]
    texts = [r["text"] for r in docs.dropDuplicates(["doc_id"]).collect()]
    assert len({t.translate(FOLD) for t in texts}) == len(texts)
    found = brute_components(texts)
    assert all(root == i for i, (_, root) in enumerate(found))


def test_pipeline_stages_take_edges(spark, data):
    import corpus_pipeline as pipeline

    texts, ids = [*EDGES, *near_copies(10), None, "", "same text"], [None, *range(1, 9), None, *range(10, len(EDGES)), *range(100, 110), None, None, 3]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, `a.b` string, _id string, _text string, _row string, _key string, key string, token string, pass int, block int"
    docs = spark.createDataFrame([(i, t, None, None if k % 3 else "s", None, 0.5, "x", "x", "x", "x", "x", "x", "x", 1, 1) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], names)
    for name, stage in pipeline.STAGES:
        docs, empty = stage(spark, docs, data), stage(spark, docs.limit(0), data)
        assert docs.count() > 0 and empty.count() == 0 and empty.columns == docs.columns, name
    kept = {r["doc_id"] for r in docs.collect()}
    assert None in kept and len(kept) > 5
