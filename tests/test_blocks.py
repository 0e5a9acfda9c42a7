"""Lists in blocks against plain Python."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scrollspark.operators import ocr_work, perplexity
from scrollspark.operators.blocks import list_blocks, ranked


def expected(rows, per_block):
    by_key = {}
    for key, order, value in sorted(rows, key=lambda r: (r[0] or "", r[1] is not None, r[1] or 0)):
        by_key.setdefault(key, []).append(value)
    return {
        (key, i // per_block): (-(-len(values) // per_block), len(values), values[i : i + per_block]) for key, values in by_key.items() for i in range(0, len(values), per_block)
    }


def test_blocks_of_hot_small_and_null_keys(spark):
    rows = [("hot", i * 7 % 5000, f"v{i}") for i in range(5000)] + [(f"k{i}", i, None if i % 2 else "x") for i in range(300)] + [(None, i, f"n{i}") for i in range(9)] + [("one", None, "first"), ("one", 1, "second")]
    df = spark.createDataFrame(rows, "id string, n int, value string").withColumn("_rank", F.lit(1)).withColumn("items", F.lit("x"))
    found = {(r["id"], r["block"]): (r["blocks"], r["total"], r["items"]) for r in list_blocks(df, "id", ["n"], "value", 64).collect()}
    assert found == expected(rows, 64)


def test_a_hot_key_lies_in_several_parts_and_equal_rows_too(spark):
    df = spark.range(20_000).select(F.lit("a").alias("id"), F.lit(1).alias("n"))
    found = ranked(df, "id", ["n"])
    assert [r[0] for r in found.select("_rank").orderBy("_rank").collect()] == list(range(20_000))
    blocks = list_blocks(df.withColumn("v", F.lit("same")), "id", ["n"], "v", 1000).collect()
    assert sorted(r["block"] for r in blocks) == list(range(20)) and all(len(r["items"]) == 1000 for r in blocks)


def test_equal_order_goes_by_a_hash_and_empty_tables_give_no_rows(spark):
    df = spark.createDataFrame([("a", 1, str(i)) for i in range(200)], "id string, n int, value string")
    lists = [[r["items"] for r in list_blocks(df.repartition(n), "id", ["n"], "value", 50).orderBy("block").collect()] for n in (1, 5)]
    assert lists[0] == lists[1] and sorted(x for part in lists[0] for x in part) == sorted(str(i) for i in range(200))
    assert list_blocks(df.where("false"), "id", ["n"], "value").count() == 0
    with pytest.raises(ValueError):
        list_blocks(df, "id", ["n"], "value", 0)


def test_blocks_joined_are_the_lists(spark):
    chunks = spark.range(3000).select((F.col("id") % 2).alias("doc"), F.col("id").alias("chunk"), (F.col("id") * 0.5).alias("ppl"))
    whole = {r["doc"]: r["chunks"] for r in perplexity.chunk_lists(chunks, "doc").collect()}
    parts = {}
    for r in perplexity.chunk_list_blocks(chunks, "doc", per_block=400).orderBy("block").collect():
        parts.setdefault(r["doc"], []).extend(r["items"])
    assert parts == whole
    pages = chunks.select("doc", F.col("chunk").alias("page_index"), F.col("ppl").alias("result"))
    one = {r["doc"]: (r["results"], r["processed_pages"]) for r in ocr_work.build_results(pages, "doc").collect()}
    assert {r["doc"]: (r["results"], r["processed_pages"]) for r in ocr_work.result_blocks(pages, "doc").collect()} == one


@pytest.mark.parametrize(("context", "stride"), [(4, 2), (4, 4), (8, 3)])
def test_windows_reach_a_batch_scorer_whole_and_few_at_a_time(spark, context, stride):
    rows = [(k, [f"{k}{i}" for i in range(n)]) for k, n in (("a", 1), ("b", 2), ("c", 4), ("d", 9), ("e", 61))] + [("f", []), ("g", None)]

    def load():
        def score(some):
            assert len(some) <= 5
            return [sum(int(t[1:]) for t in tokens[start:end]) / (end - start) for tokens, start, end in some]

        return score

    found = perplexity.batch_scores(spark.createDataFrame(rows, "k string, words array<string>"), "k", "words", load, context, stride, 5).collect()
    want = []
    for k, words in rows:
        for chunk, begin, end, scored in perplexity.plan(len(words or []), context, stride):
            first = end - scored if chunk else begin + 1
            want.append((k, chunk, sum(range(first, end)) / (end - first), scored))
    assert sorted((r["k"], r["chunk"], r["nll"], r["scored"]) for r in found) == want


@pytest.mark.parametrize("frequent", [2, 10_000])
def test_unigram_scores_sort_no_tokens(spark, monkeypatch, capsys, frequent):
    monkeypatch.setattr(perplexity, "FREQUENT", frequent, raising=False)
    texts = {i: ["the"] * (40 + i) + [f"w{i}", f"w{i % 3}"] * 5 + ["the"] for i in range(8)} | {8: ["alone"], 9: [], 10: None}
    counts = Counter(w for ws in texts.values() for w in ws or ())
    whole = sum(counts.values()) + len(counts)
    want = {}
    for i, ws in texts.items():
        for at, w in list(enumerate(ws or ()))[1:]:
            want.setdefault((i, 0 if at < 16 else (at - 16) // 8 + 1), []).append(-math.log((counts[w] + 1) / whole))
    out = perplexity.unigram_scores(spark.createDataFrame(list(texts.items()), "id int, words array<string>"), "id", "words", 16, 8)
    found = {(r["id"], r["chunk"]): r for r in out.collect()}
    assert {k: r["scored"] for k, r in found.items()} == {k: len(v) for k, v in want.items()}
    assert all(math.isclose(found[k]["nll"], sum(v) / len(v), rel_tol=1e-12) for k, v in want.items())
    # A task that gets all tokens of a word would sort them.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        perplexity.unigram_scores(spark.createDataFrame(list(texts.items()), "id int, words array<string>"), "id", "words", 16, 8).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
