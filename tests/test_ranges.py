"""Tables in files of key ranges, the kept text index, stems, and reading that stops early."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scrollspark.functions.stemming import english_stem, stem_of
from scrollspark.operators import ingest, perplexity, search, store, text_index, workflow
from scrollspark.operators.ranges import ranged
from scrollspark.operators.store import SnapshotStore

# The published sample of the stemmer's vocabulary: words and stems.
SAMPLE = """
consign consign consigned consign consigning consign consignment consign consist consist consisted consist consistency consist consistent consist consistently consist consisting consist consists consist
consolation consol consolations consol consolatory consolatori console consol consoled consol consoles consol consolidate consolid consolidated consolid consolidating consolid consoling consol
consolingly consol consols consol consonant conson consort consort consorted consort consorting consort conspicuous conspicu conspicuously conspicu conspiracy conspiraci conspirator conspir
conspirators conspir conspire conspir conspired conspir conspiring conspir constable constabl constables constabl constance constanc constancy constanc constant constant
knack knack knackeries knackeri knacks knack knag knag knave knave knaves knave knavish knavish kneaded knead kneading knead knee knee kneel kneel kneeled kneel kneeling kneel kneels kneel knees knee
knell knell knelt knelt knew knew knick knick knif knif knife knife knight knight knightly knight knights knight knit knit knits knit knitted knit knitting knit knives knive knob knob knobs knob
knock knock knocked knock knocker knocker knockers knocker knocking knock knocks knock knopp knopp knot knot knots knot
""".split()


def test_stems_are_the_published_ones(spark):
    words = dict(zip(SAMPLE[::2], SAMPLE[1::2], strict=True))
    rows = spark.createDataFrame([(w,) for w in [*words, None]], "w string").select("w", english_stem(F.col("w")).alias("s")).collect()
    assert {r["w"]: r["s"] for r in rows} == words | {None: None}
    more = {"generously": "generous", "skies": "sky", "dying": "die", "happy": "happi", "say": "say", "hoping": "hope", "hopping": "hop", "ties": "tie", "cries": "cri", "gas": "gas", "gaps": "gap", "inning": "inning", "it's": "it", "youth": "youth", "": "", "épées": "épées"}
    assert {w: stem_of(w) for w in more} == more


def keyed(spark, rows):
    return spark.createDataFrame(rows, "id string, note string")


def held(table):
    return sorted((r["id"], r["note"]) for r in table.read().collect())


def test_a_merge_leaves_other_files_alone(spark, tmp_path):
    rows = spark.range(10_000).select(F.format_string("%05d", "id").alias("id"), F.lit("old").alias("note"))
    table = ranged(rows, f"{tmp_path}/a", "id", rows_per_file=500)
    assert len(table.parts) >= 20 and table.count() == 10_000
    source = spark.range(3_100, 4_100).select(F.format_string("%05d", "id").alias("id"), F.lit("new").alias("note"))
    after = table.changed(source, lambda near: store.merge(near, source, "id", {"note": store.REPLACE}), f"{tmp_path}/b")
    stayed = {p for p in table.parts} & {p for p in after.parts}
    assert {p.path for p in table.parts} - {p.path for p in stayed} == {p.path for p in table.parts if p.high >= "03100" and p.low <= "04099"}
    assert len(stayed) >= len(table.parts) - 4
    assert {(r["note"], r["n"]) for r in after.read().groupBy("note").agg(F.count("*").alias("n")).collect()} == {("old", 9_000), ("new", 1_000)}
    found = after.lookup(["03100", "nothing"])
    assert [tuple(r) for r in found.collect()] == [("03100", "new")] and len(after.lookup(["07777"]).inputFiles()) == 1
    page = after.page(3, after="04098")
    assert [r["id"] for r in page.collect()] == ["04099", "04100", "04101"] and len(page.inputFiles()) <= 2
    assert [r["id"] for r in after.page(4, where="id LIKE '%999'").collect()] == ["00999", "01999", "02999", "03999"]
    assert after.page(5, after="99999").count() == 0 and after.page(5, after="09998").count() == 1


def test_changes_are_those_of_a_dictionary(spark, tmp_path):
    rng = random.Random(1)
    model = {f"k{rng.randint(0, 400):03d}": "0" for _ in range(150)}
    table = ranged(keyed(spark, list(model.items())), f"{tmp_path}/0", "id", rows_per_file=20)
    for turn in ("1", "2"):
        change = {f"k{rng.randint(-50, 500):03d}": turn for _ in range(12)} | {"": turn, "zz": turn}
        gone = set(rng.sample(sorted(model), 5))
        source, leaving = keyed(spark, list(change.items())), keyed(spark, [(k, None) for k in gone])
        apply = lambda near, source=source, leaving=leaving: store.merge(near.join(leaving, "id", "left_anti"), source, "id", {"note": store.REPLACE})
        table = table.changed(source.union(leaving), apply, f"{tmp_path}/{turn}")
        model = {k: v for k, v in model.items() if k not in gone} | change
        assert held(table) == sorted(model.items())
    whole = table.compacted(f"{tmp_path}/c")
    assert held(whole) == sorted(model.items()) and len(whole.parts) < len(table.parts)
    assert type(whole).from_json(spark, whole.to_json()) == whole


def test_a_key_of_many_rows_lies_in_several_files(spark, tmp_path):
    rows = [("hot", f"{i:04d}") for i in range(300)] + [(f"p{i}", "x") for i in range(300)] + [("a", "x")]
    table = ranged(keyed(spark, rows), f"{tmp_path}/a", "id", ("note",), rows_per_file=50)
    assert sum(p.low <= "hot" <= p.high for p in table.parts) >= 6
    batch = keyed(spark, [("hot", "new"), ("b", "y")])
    after = table.changed(batch, lambda near: store.replace_links(near, batch, "id"), f"{tmp_path}/b")
    assert held(after) == sorted([("hot", "new"), ("b", "y"), *((k, n) for k, n in rows if k != "hot")])


def test_what_a_table_in_ranges_refuses(spark, tmp_path):
    with pytest.raises(ValueError, match="rows without id"):
        ranged(keyed(spark, [(None, "x")]), f"{tmp_path}/a", "id")
    table = ranged(keyed(spark, [(f"{i}", "x") for i in range(9)]), f"{tmp_path}/b", "id", rows_per_file=3)
    with pytest.raises(ValueError, match="overlap"):
        table.changed(keyed(spark, [("0", "")]), lambda near: near.union(keyed(spark, [("7x", "not given")])), f"{tmp_path}/c")
    empty = ranged(keyed(spark, []), f"{tmp_path}/d", "id")
    assert empty.parts == () and empty.read().count() == 0 and empty.page(3).count() == 0 and empty.lookup(["a"]).count() == 0
    assert held(empty.changed(keyed(spark, [("a", "x")]), lambda near: keyed(spark, [("a", "x")]), f"{tmp_path}/e")) == [("a", "x")]


def test_a_store_keeps_ranges_and_cleans_up(spark, tmp_path):
    shop = SnapshotStore(spark, str(tmp_path))
    shop.publish(a=keyed(spark, [(f"{i}", "x") for i in range(9)]), b=keyed(spark, [("b", "b")]))
    shop.publish(a=shop.ranged("a", "id", rows_per_file=3))
    for note in "yz":
        new = keyed(spark, [("4", note)])
        shop.publish(a=shop.changed("a", new, lambda near, new=new: store.merge(near, new, "id", {"note": store.REPLACE}), "id"))
    assert shop.clean(keep=1) == 0  # all files are young
    before = {str(p) for p in tmp_path.rglob("*.parquet")}
    assert shop.clean(keep=1, older_than=-60) > 0
    after = {str(p) for p in tmp_path.rglob("*.parquet")}
    assert after < before and held(shop.ranged("a", "id"))[4] == ("4", "z") and shop.read("a").count() == 9 and shop.read("b").count() == 1
    shop.publish("b", c=shop.read("a"))
    assert shop.tables() == ["a", "c"]


def test_reading_stops_at_the_limit(spark, tmp_path):
    for i in range(8):
        (tmp_path / f"{i}.jsonl").write_text("".join(json.dumps({"id": f"{i}-{k}", "title": "t"}) + "\n" for k in range(5)))

    known = spark.createDataFrame([("0-0",), ("0-1",), ("1-4",)], "id string")
    lines = [p for p in ingest.waves(spark, str(tmp_path / "[0-7].jsonl"), first=1)]
    assert [sorted(f.rsplit("/", 1)[1] for f in p.inputFiles()) for p in lines] == [["0.jsonl"], ["1.jsonl", "2.jsonl"], ["3.jsonl", "4.jsonl", "5.jsonl", "6.jsonl"], ["7.jsonl"]]
    assert [r["ordinal"] for p in lines for r in p.orderBy("ordinal").collect()] == list(range(40))
    found = ingest.first_new_of_files(spark, str(tmp_path / "[0-7].jsonl"), known, 7, first=1)
    assert len(found) == 2 and [r["id"] for p in found for r in p.orderBy("ordinal").collect()] == ["0-2", "0-3", "0-4", "1-0", "1-1", "1-2", "1-3"]
    shop = workflow.initialised(SnapshotStore(spark, str(tmp_path / "store")))
    read = []

    def waves():
        for wave in ingest.waves(spark, str(tmp_path / "[0-7].jsonl"), first=1):
            read.append(wave)
            yield wave

    assert workflow.process(shop, waves(), "", None, limit=7)["accepted"] == 7 and len(read) == 2


def test_an_index_in_segments_is_the_index_of_all(spark, tmp_path):
    schema = "id bigint, title string, text string"
    kept = text_index.TextIndex(SnapshotStore(spark, str(tmp_path)), "fts", "id", ["title", "text"], rows_per_file=5)
    texts = {i: (f"Title {i}", f"running{'' if i % 3 else ' of'} horses number {i} café") for i in range(40)}
    frame = lambda ids: spark.createDataFrame([(i, *texts[i]) for i in ids], schema)
    kept.add(frame(range(25)))
    for i in (3, 30):
        texts[i] = (None, "the Horse runs")
    texts[4] = (None, None)
    kept.add(frame([*range(25, 40), 3, 4]))

    def plain():
        index = search.index(frame(texts), "id", ["title", "text"], stemmed=False)
        stemmed = index.groupBy(english_stem(F.col("term")).alias("term"), "id").agg(F.sum("tf").alias("tf"))
        return sorted(map(tuple, stemmed.collect()))

    assert len(kept.segments()) == 2 and sorted(map(tuple, kept.postings().collect())) == plain()
    assert sorted(r["id"] for r in kept.search(["Runs", "the", "HORSE"]).collect()) == sorted(set(range(40)) - {4})
    assert kept.search(["title", "horse", "nothere"]).count() == 0 and kept.search(["the"]).count() == 0
    files = sum(len(kept._postings(s).parts) for s in kept.segments())
    assert len(kept.files_of(["title"])) <= 4 < files
    kept.merge()
    assert len(kept.segments()) == 1 and sorted(map(tuple, kept.postings().collect())) == plain()
    kept.add(spark.createDataFrame([(3, "a", "b zebra"), (3, "a", "zebra"), (None, "zebra", "zebra")], schema))
    assert [r["id"] for r in kept.search(["zebras"]).collect()] == [3]


def test_percentiles_of_large_keys_are_exact(spark):
    rng = random.Random(2)
    rows = [("hot", rng.choice([1.5, float(rng.randint(0, 300)) / 7, None])) for _ in range(900)] + [(None, 2.0), (None, 4.0), ("one", 3.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, ppl double").repartition(5)
    want = {r["k"]: r for r in df.where("ppl IS NOT NULL").groupBy("k").agg(*(F.percentile("ppl", F.lit(q)).alias(name) for name, q in perplexity.PERCENTILES.items())).collect()}
    got = {r["k"]: r for r in perplexity.exact_percentiles(df, "k").collect()}
    assert set(got) == set(want) == {"hot", "one", None}
    for k, row in want.items():
        assert all(abs(got[k][name] - row[name]) < 1e-9 for name in perplexity.PERCENTILES)
    assert perplexity.exact_percentiles(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("texts, calls", [(["apples and pears"] * 1200 + [None, ""], 3), (["apples " * 100_000, "x", "apples " * 200_000, "apples"], 2)])
def test_words_are_counted_in_bounded_batches(spark, tmp_path, texts, calls):
    seen = tmp_path / "seen"

    def stem(term: str) -> str:
        if term == "apples":
            with open(seen, "a") as log:
                log.write("1")
        return term.removesuffix("s")

    kept = text_index.TextIndex(SnapshotStore(spark, str(tmp_path / "shop")), "fts", "id", ["text"], stem=stem)
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    kept.add(rows)
    # The stem is asked for once in each batch that has the word.
    assert len(seen.read_text()) == calls
    found = {(r["term"], r["id"]): r["tf"] for r in kept.postings().collect()}
    assert found == {(w.removesuffix("s"), i): n for i, text in enumerate(texts) for w, n in Counter((text or "").split()).items() if w != "and"}
