"""Edge tables of parsing, ingest, store, status, OCR work, scoring, search, downloads and streams."""

import datetime as dt
import functools
import http.server
import json
import random
import struct
import threading
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrollspark import cli
from scrollspark.functions import ocr_document, parsing, payload, raster
from scrollspark.operators import ingest, ocr_work, perplexity, profile, schema, search, status, store
from scrollspark.sources import fetch, files
from scrollspark.streaming import incremental

def moment():
    return F.lit("2024-05-01 00:00:00").cast("timestamp_ntz")


def one(df):
    return [tuple(r) for r in df.collect()]


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize("created, year", [
    ("Mon, 2 Apr 2007 19:18:42 GMT", 2007), ("Tue, 2 Apr 2007 19:18:42 GMT", 2007), ("mon, 02 apr 2007 9:8:2 utc", 2007), ("Mon,  2  Apr 2007 19:18:42  GMT", 2007),
    ("Mon, 2 Apr 2007 19:18:42 EST", None), ("Mon, 30 Feb 2007 19:18:42 GMT", None), ("Mon, 2 Apr 07 19:18:42 GMT", None), ("Mon,2 Apr 2007 19:18:42 GMT", None),
    ("Mon, 2 Apr 2007 19:18:42 GMT ", None), ("Mon, 2 Apr 2007 19:18:42 +0000", None), ("", None), (None, None),
])
def test_http_dates(spark, created, year):
    assert values(spark, [created], lambda c: F.year(parsing.http_timestamp(c))) == [year]


def test_dates(spark):
    assert values(spark, ["2008-01-02", "2008-1-2", "2008-13-01", "", None, "x"], parsing.date_of) == [dt.date(2008, 1, 2), dt.date(2008, 1, 2), None, None, None, None]


def test_ids(spark):
    good = {"0704.0001": "0704.0001", "cs.AI/9901001": "cs.AI/9901001", " 0704.1 ": "0704.1", "x\\y": "x/y", "\t a ": "a"}
    bad = ["", "/abs", "~x", "../x", ".", "..", "a/", "a/b/c", "a b", "a\0b", "a/..", None]
    assert values(spark, list(good), parsing.normal_id) == list(good.values())
    assert values(spark, bad, parsing.normal_id) == [None] * len(bad)
    assert all(values(spark, bad, parsing.id_problem)) and not any(values(spark, list(good), parsing.id_problem))
    assert values(spark, ["cs.AI/1"], lambda c: parsing.id_of_file(F.concat(F.lit("/d/"), parsing.file_name(c)))) == ["cs.AI/1"]


def test_words_split_like_python(spark):
    texts = ["a b", " a b\x1cc\n", "", None, " x\u0085y"]
    assert values(spark, texts, parsing.words) == [(t or "").split() for t in texts]
    assert values(spark, texts, parsing.word_count) == [len((t or "").split()) for t in texts]


LINES = [
    ('{"id":"1","versions":[{"version":"v1","created":"Mon, 2 Apr 2007 19:18:42 GMT"}]}', "counted"),
    ('{"id":"2"}', "ignored"), ('{"id":"3","versions":[]}', "ignored"), ('{"id":"4","versions":null}', "ignored"), ('{"id":"4","versions":0}', "ignored"),
    ('{"id":"5","versions":{"x":1}}', "error"), ('{"id":"6","versions":[{"version":"v1"}]}', "error"), ('{"versions":[{"created":"Mon, 2 Apr 2007 19:18:42 EST"}]}', "error"),
    ("", "error"), ("not json", "error"), ("null", "error"), ("[]", "error"), ("{}", "ignored"), ('{"id":"","versions":[{"created":"mon, 02 apr 2007 9:8:2 utc"}]}', "counted"),
]


def test_profile_lines(spark):
    for line, kind in LINES:
        found = one(profile.articles(spark.createDataFrame([(line,)], "value string")).select("ok"))
        assert found == {"counted": [(True,)], "error": [(False,)], "ignored": []}[kind], line


def test_profile_of_nothing(spark):
    empty = profile.articles(spark.createDataFrame([], "value string"))
    assert one(profile.summary(empty)) == [(None,) * 6]


def test_peak_year_of_a_tie_is_the_first(spark):
    found = spark.createDataFrame([(True, 2001, 1), (True, 2000, 1), (False, None, None)], "ok boolean, year int, n_versions bigint")
    assert profile.summary(found).first()["peak_year"] == 2000


def lines_df(spark, records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r), i) for i, r in enumerate(records)], "value string, ordinal bigint")


def empty_tables(spark):
    return (spark.createDataFrame([], schema.papers_ddl()), spark.createDataFrame([], schema.CATEGORIES), spark.createDataFrame([], schema.LINKS))


RECORDS = [
    {"id": "1", "title": "first", "categories": "a.B  a.B c"}, "not json", "null", "[]", "{}", {"id": "", "title": "x"}, {"id": "../x"},
    {"id": "2", "categories": None, "versions": {"x": 1}}, {"id": "1", "title": "second", "categories": "d"}, {"id": "3", "journal-ref": "J", "update_date": "2008-1-2"},
]


def test_ingest_takes_the_first_or_the_last(spark):
    tables = empty_tables(spark)
    for resume, title in ((True, "first"), (False, "second")):
        out = ingest.load(lines_df(spark, RECORDS), *tables, resume=resume, now=moment())
        papers = {r["id"]: r for r in out.papers.collect()}
        assert set(papers) == {"1", "2", "3"} and papers["1"]["title"] == title
        assert papers["2"]["title"] == "" and papers["3"]["journal_ref"] == "J" and papers["3"]["update_date"] == dt.date(2008, 1, 2)
        assert papers["1"]["pdf_downloaded"] is False
    assert sorted(one(ingest.load(lines_df(spark, RECORDS), *tables, now=moment()).links)) == [("1", "a.B"), ("1", "c")]


def test_ingest_twice_is_once_and_limits_add_up(spark):
    tables = empty_tables(spark)
    lines = lines_df(spark, [{"id": str(i), "categories": f"k{i % 3}"} for i in range(7)])
    whole = ingest.load(lines, *tables, now=moment())
    again = ingest.load(lines, whole.papers, whole.categories, whole.links, now=moment())
    assert again.accepted.count() == 0 and again.skipped.count() == 7 and again.papers.count() == 7
    a = ingest.load(lines, *tables, limit=2, now=moment())
    b = ingest.load(lines, a.papers, a.categories, a.links, limit=3, now=moment())
    five = ingest.load(lines, *tables, limit=5, now=moment())
    assert sorted(one(b.papers.select("id"))) == sorted(one(five.papers.select("id")))
    assert sorted(one(b.links)) == sorted(one(five.links)) and b.skipped.count() == 2
    assert ingest.load(lines, *tables, max_records=3, now=moment()).accepted.count() == 3


def test_upsert_keeps_tracking_columns(spark):
    papers, categories, links = empty_tables(spark)
    first = ingest.load(lines_df(spark, [{"id": "1", "title": "old", "doi": "d"}]), papers, categories, links, now=moment())
    tracked = first.papers.withColumn("pdf_downloaded", F.lit(True)).withColumn("ocr_error", F.lit("e"))
    later = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    row = ingest.load(lines_df(spark, [{"id": "1", "title": "new"}]), tracked, categories, links, resume=False, now=later).papers.first()
    assert (row["title"], row["doi"], row["pdf_downloaded"], row["ocr_error"]) == ("new", None, True, "e")
    assert row["created_at"] == dt.datetime(2024, 5, 1) and row["updated_at"] == dt.datetime(2025, 1, 1)


def test_ordinals_follow_the_file(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("".join(f"line {i}\n" for i in range(500)))
    rows = files.numbered_lines(spark, str(tmp_path / "x.jsonl")).collect()
    assert all(r["value"] == f"line {r['ordinal']}" for r in rows) and len(rows) == 500
    assert files.numbered_lines(spark, str(tmp_path / "x.jsonl"), 7).count() == 7


def test_migrations_go_up_and_down(spark):
    base = spark.createDataFrame([("1",)], "id string").select("id", *(F.lit(None).cast(k.simpleString()).alias(n) for n, k, _ in schema.LEVELS[1] if n != "id"))
    up = schema.migrate(base, 1, 4)
    assert {n for level in schema.LEVELS.values() for n, _, _ in level} == set(up.columns) and up.first()["pdf_downloaded"] is False
    assert schema.migrate(up, 4, 1).columns == base.columns
    assert schema.too_long(spark.createDataFrame([("x" * 51,), ("y" * 50,)], "id string")).count() == 1


def test_store_publishes_tables_together(spark, tmp_path):
    shop = store.SnapshotStore(spark, str(tmp_path))
    shop.publish(a=spark.range(3), b=spark.range(1))
    before = shop.read("a")
    shop.publish(a=spark.range(5))
    assert (shop.read("a").count(), shop.read("b").count(), before.count(), shop.tables()) == (5, 1, 3, ["a", "b"])


def test_only_one_of_two_writers_publishes(spark, tmp_path):
    first, second = (store.SnapshotStore(spark, str(tmp_path)) for _ in range(2))
    first.publish(x=spark.range(1), y=spark.range(1))
    # The second publishes y while the first writes x.
    first.read("x"), second.read("y")
    second.publish(y=spark.range(5))
    with pytest.raises(store.Conflict):
        first.publish(x=spark.range(3))
    assert (second.read("x").count(), second.read("y").count()) == (1, 5)
    first.begin()
    first.publish(x=first.read("x").union(spark.range(2)))
    assert (second.read("x").count(), second.read("y").count()) == (3, 5)
    # The pointer's number and content come from one listing: the other is first after it.
    pointer = store.SnapshotStore._pointer

    def late(self):
        found = pointer(self)
        if self is first:
            second.begin()
            second.publish(y=spark.range(9))
        return found

    first.begin()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(store.SnapshotStore, "_pointer", late)
        with pytest.raises(store.Conflict):
            first.publish(x=spark.range(7))
    assert (first.read("x").count(), first.read("y").count()) == (3, 9)
    assert not list(tmp_path.glob("draft-*"))


def test_migrations_of_a_store(spark, tmp_path):
    shop = store.SnapshotStore(spark, str(tmp_path))
    assert schema.level_of(shop) == 0 and schema.run_migrations(shop, 2) == [1, 2]
    row = spark.createDataFrame([("1", True)], "id string, pdf_downloaded boolean")
    shop.publish(papers=shop.read("papers").unionByName(row, allowMissingColumns=True))
    assert schema.run_migrations(shop) == [3, 4] and schema.run_migrations(shop) == []
    found = shop.read("papers").first()
    assert (found["pdf_downloaded"], found["ocr_processed"], found["pdf_content"]) == (True, False, None)
    assert schema.run_migrations(shop, 1) == [3, 2, 1] and shop.read("papers").columns == [n for n, _, _ in schema.LEVELS[1]]
    assert set(shop.tables()) == {"papers", "categories", "links", schema.VERSION_TABLE}
    with pytest.raises(ValueError):
        schema.run_migrations(shop, 5)


def test_cascade_and_rename(spark):
    papers = spark.createDataFrame([("1",), ("2",)], "id string")
    links = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "a")], schema.LINKS)
    left, left_links = store.delete_cascade(papers, links, spark.createDataFrame([("1",)], "id string"))
    assert one(left) == [("2",)] and sorted(one(left_links)) == [("2", "a"), ("2", "b")]
    names = spark.createDataFrame([("a", "b")], "category string, new_category string")
    renamed, _ = store.rename_categories(links, spark.createDataFrame([("a",), ("b",)], "category string"), names)
    assert sorted(one(renamed)) == [("1", "b"), ("2", "b")]


def flags(spark, rows):
    return spark.createDataFrame(rows, "id string, has_content boolean, pdf_downloaded boolean, pdf_download_error string, categories string, has_ocr boolean, ocr_processed boolean, ocr_error string")


def test_null_flags(spark):
    df = flags(spark, [("1", True, None, None, "cs.AI x", False, None, None), ("2", True, False, None, "CS.a%b", True, False, None), ("3", False, True, "e", None, False, True, "x")])
    assert one(status.download_candidates(df)) == [("2",)]
    assert one(status.download_candidates(df, categories=["cs_a"])) == [("2",)]
    assert one(status.ocr_candidates(df)) == [("2",)]
    assert sorted(one(status.reconciled(df).select("id", "pdf_downloaded"))) == [("1", None), ("2", True), ("3", False)]
    twice = status.reconciled(status.reconciled(df))
    assert sorted(one(twice.select("id", "pdf_downloaded"))) == [("1", None), ("2", True), ("3", False)]
    sync = status.file_sync(df, spark.createDataFrame([("1",), ("9",)], "id string"))
    assert sorted(one(sync)) == [("1", True, True), ("2", False, False), ("3", False, True)]


def test_outcomes_keep_or_clear_the_flag(spark):
    papers = spark.createDataFrame([("1", True, None, None, None), ("2", False, "old", None, None)], "id string, pdf_downloaded boolean, pdf_download_error string, pdf_download_attempted_at timestamp_ntz, pdf_content binary")
    outcomes = spark.createDataFrame([("1", "HTTP 404", None), ("2", None, bytearray(b"%PDF-"))], "id string, error string, content binary")
    for clears in (False, True):
        rows = {r["id"]: r for r in status.store_outcomes(papers, outcomes, moment(), clears).collect()}
        assert rows["1"]["pdf_downloaded"] is not clears and rows["1"]["pdf_download_error"] == "HTTP 404"
        assert rows["2"]["pdf_downloaded"] and rows["2"]["pdf_download_error"] is None and bytes(rows["2"]["pdf_content"]) == b"%PDF-"


def test_payloads(spark):
    df = spark.createDataFrame([(bytearray(b"%PDF-1"), None), (bytearray(b"%PDF-" + b"x" * 9), None), (bytearray(b"<html"), None), (None, None), (bytearray(b"%PDF-"), "99"), (bytearray(b"%PDF-"), "zz")], "b binary, n string")
    assert [r[0] for r in df.select(payload.outcome(F.col("b"), 10, content_length=F.col("n"))).collect()] == ["ok", "too large", "bad signature", "bad signature", "too large", "ok"]
    assert values(spark, [None, "", "application/PDF", "application/octet-stream", "text/html"], payload.content_type_ok) == [True, True, True, True, False]


def test_retries():
    class Fake:
        def __init__(self, *answers):
            self.answers = list(answers)

        def __call__(self, url, timeout):
            x = self.answers.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

    pdf, html, gone = fetch.Response(200, None, "x", b"%PDF-1"), fetch.Response(200, "text/html", None, b"<"), fetch.Response(404, None, None, b"")
    pauses = []
    assert fetch.with_retries(Fake(OSError("a"), OSError("b"), pdf), "u", sleep=pauses.append) == (b"%PDF-1", None) and pauses == [1.0, 1.0]
    assert fetch.with_retries(Fake(html, gone, gone), "u")[1] == "HTTP 404"
    assert fetch.problem(fetch.Response(200, "", "999", b"%PDF-"), 10) == "too large"


class Handler(http.server.BaseHTTPRequestHandler):
    """Answers by the path; /long has no length, /huge says a large one."""

    def do_GET(self):
        if self.path == "/gone":
            return self.send_error(404)
        self.send_response(200)
        self.send_header("Content-Type", "text/html" if self.path == "/page" else "application/pdf")
        if self.path == "/huge":
            self.send_header("Content-Length", str(10**9))
        self.end_headers()
        try:
            self.wfile.write(b"%PDF-" + (b"x" * 100_000 if self.path in ("/long", "/huge") else b"fine"))
        except OSError:
            pass

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler) as found:
        threading.Thread(target=found.serve_forever, daemon=True).start()
        yield f"http://127.0.0.1:{found.server_port}"
        found.shutdown()


def test_http(spark, server, tmp_path):
    load = functools.partial(fetch.HttpFetcher, max_bytes=1000, piece=64)
    want = {"good": (9, None), "page": (None, "unexpected content type text/html"), "gone": (None, "HTTP 404"), "huge": (None, "too large"), "long": (None, "too large")}
    urls = spark.createDataFrame([(k, f"{server}/{k}") for k in want], "id string, url string")
    rows = fetch.downloaded(urls, load, workers=2, delay=0, pause=0, max_bytes=1000).collect()
    assert {r["id"]: (r["content"] and len(r["content"]), r["error"]) for r in rows} == want
    assert len(load()(f"{server}/long", 5).body) == 1001 and load()(f"{server}/huge", 5).body == b""
    closed = spark.createDataFrame([("x", "http://127.0.0.1:9/x")], "id string, url string")
    assert "refused" in fetch.downloaded(closed, load, workers=1, delay=0, pause=0, retries=2).first()["error"]


def test_broken_off_downloads_go_on(spark, tmp_path):
    def load(marks, broken):
        def get(url, timeout):
            (marks / f"{url}-{time.monotonic_ns()}").touch()
            if url == "7" and broken:
                raise SystemExit("the executor is gone")
            return fetch.Response(200, None, None, b"%PDF-" + url.encode())

        return lambda: get

    urls = spark.createDataFrame([(str(i), str(i)) for i in range(12)], "id string, url string")
    run = lambda broken: fetch.downloaded_in_slices(urls, load(tmp_path / "asked", broken), str(tmp_path / "out"), slices=6, workers=1, delay=0)
    (tmp_path / "asked").mkdir()
    with pytest.raises(Exception, match="."):
        run(True)
    before = {x.name.split("-")[0] for x in (tmp_path / "asked").iterdir()}
    for x in (tmp_path / "asked").iterdir():
        x.unlink()
    got = run(False)
    after = [x.name.split("-")[0] for x in (tmp_path / "asked").iterdir()]
    assert sorted(r["id"] for r in got.collect()) == sorted(str(i) for i in range(12))
    assert len(after) == len(set(after)) and before - set(after) and set(after) | before == {str(i) for i in range(12)}


def test_downloads_and_files(spark, tmp_path):
    def load():
        return lambda url, timeout: fetch.Response(200 if "good" in url else 404, None, None, b"%PDF-" + url.encode())

    urls = spark.createDataFrame([("a/good", "u/good"), ("b", "u/b")], "id string, url string")
    got = fetch.downloaded(urls, load, workers=2, delay=0)
    rows = {r["id"]: r for r in got.collect()}
    assert rows["b"]["error"] == "HTTP 404" and bytes(rows["a/good"]["content"]) == b"%PDF-u/good"
    assert [p.rsplit("/", 1)[1] for _, p in one(fetch.saved(got, str(tmp_path)))] == ["a__good.pdf"]
    (tmp_path / "z.txt").write_text("no")
    found = files.pdf_files(spark, str(tmp_path))
    assert one(found.select("id", "length")) == [("a/good", 11)]
    papers = spark.createDataFrame([("a/good", None, False)], "id string, pdf_content binary, pdf_downloaded boolean")
    stored, unknown = status.store_files(papers, found.select("id", "content"))
    assert stored.first()["pdf_downloaded"] and unknown.count() == 0


def test_databases(spark, data, tmp_path):
    """Against the database that comes with Spark."""
    url = f"jdbc:derby:{tmp_path}/papers;create=true"
    rows = files.table(spark, data, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    files.to_jdbc(rows, url, "orders", "overwrite", 2)
    files.to_jdbc(spark.createDataFrame([(None, 1.0, "X")], rows.schema), url, "orders")
    parts = files.jdbc(spark, url, "orders", "o_orderkey", partitions=4)
    assert parts.rdd.getNumPartitions() == 4
    # Each part has rows, and filters reach the database.
    assert all(n > rows.count() / 8 for n in parts.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect())
    assert sorted(map(repr, parts.where("o_orderkey IS NOT NULL").collect())) == sorted(map(repr, rows.toDF(*parts.columns).collect()))
    assert parts.where("o_orderkey IS NULL").count() == 1
    found = files.jdbc(spark, url, "orders").where("o_totalprice > 100000")
    assert "GreaterThan(o_totalprice" in found._jdf.queryExecution().toString() and found.count() == rows.where("o_totalprice > 100000").count() > 0
    assert files.jdbc(spark, url, "(SELECT * FROM orders WHERE 1 = 0) nothing", "o_orderkey").count() == 0


def test_database_urls(monkeypatch):
    url = files.database_url({"DB_HOST": "h", "DB_USER": "u", "DB_PASSWORD": "p@"})
    assert url == "postgresql://u:p%40@h:5432/papers" and files.shown_url(url) == "postgresql://u:***@h:5432/papers"
    assert files.database_url({"SQLALCHEMY_URL": "x"}) == "x"
    assert files.jdbc_options(url) == {"url": "jdbc:postgresql://h:5432/papers", "user": "u", "password": "p@"}
    assert files.jdbc_options("postgresql+psycopg2://h/x") == {"url": "jdbc:postgresql://h/x"}
    monkeypatch.setenv("DB_PASSWORD", "s")
    assert files.resolve_password() == "s"


def test_ocr_text_follows_the_boxes(spark):
    box = lambda content, text=None, y=None: {"label": "t", "content": content, "text": text, "score": "0.9", "coordinate": None if y is None else [0.0, y]}
    boxes = [box("late", y=9.0), box("", "fallback", 2.0), box("tie1", y=5.0), box("tie2", y=5.0), box("none"), box("", ""), box("  ", y=1.0)]
    document = {"results": [{"page_index": 0, "dpi": 100, "layout_det_res": {"boxes": boxes}}, {"page_index": 1, "dpi": None, "layout_det_res": None}], "total_pages": 2, "processed_pages": 2}
    df = spark.createDataFrame([(json.dumps(document),)], "j string").select(F.from_json("j", ocr_document.DOCUMENT).alias("d"))
    assert df.select(ocr_document.document_text(F.col("d"))).first()[0] == "none\n\nfallback\ntie1\ntie2\nlate"
    assert df.select(ocr_document.dpi_of(F.col("d")), ocr_document.dpi_of(F.col("d"), 300)).first() == (100, 300)
    assert df.select(ocr_document.page_of(F.col("d"), 1)["page_index"], ocr_document.page_of(F.col("d"), 7)).first() == (1, None)
    four = {"results": [{"page_index": 3, "dpi": None, "layout_det_res": {"boxes": [box("x"), box("y") | {"coordinate": [0.0, 1.0, 2.0, 3.0], "label": None}]}}], "total_pages": 1, "processed_pages": 1}
    drawn = spark.createDataFrame([("k", json.dumps(four))], "k string, j string").select("k", F.from_json("j", ocr_document.DOCUMENT).alias("document"))
    assert one(ocr_document.drawn_boxes(drawn, "k").drop("coordinate")) == [("k", 3, "#808080", "2. unknown (0.90)")]
    assert values(spark, ["TEXT", "zzz"], ocr_document.colour) == ["#ff9800", "#808080"]
    row = spark.range(1).select(ocr_document.caption(F.lit(0), F.lit(None).cast("string"), F.lit("0.456"))).first()
    assert row[0] == "1. unknown (0.46)"
    assert ocr_document.scrub({"img": 1, "a": [[1]] * 101, "b": [1, None, {"vis_img": 2, "c": 3}]}) == {"b": [1, {"c": 3}]}
    assert ocr_document.wrapped("word " * 500, 100, 16)[-1] == "..." and ocr_document.wrapped("") == []


def test_page_plan_covers_the_target(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(0, 12), [p for p in range(12) if rng.random() < 0.3]) for i in range(30)]
    work = spark.createDataFrame(rows, "k int, target int, processed array<int>")
    plan = ocr_work.page_plan(work, "k", per_run=None, per_batch=3).collect()
    for k, target, done in rows:
        mine = sorted(r["page"] for r in plan if r["k"] == k)
        assert mine == sorted(set(range(target)) - set(done))
    some = ocr_work.page_plan(work, "k", per_run=2).collect()
    assert all(r["is_partial"] == (len(set(range(rows[r["k"]][1])) - set(rows[r["k"]][2])) > 2) for r in some)


def test_finishing_a_paper(spark):
    papers = spark.createDataFrame([("1", "part", False, None, "old"), ("2", "part", False, None, "old")], "id string, ocr_results string, ocr_processed boolean, ocr_processed_at timestamp_ntz, ocr_error string")
    done = spark.createDataFrame([("1", "all", True, None), ("2", None, False, "unreadable")], "id string, results string, completed boolean, error string")
    rows = {r["id"]: r for r in ocr_work.save_results(papers, done, moment()).collect()}
    assert rows["1"]["ocr_results"] == "all" and rows["1"]["ocr_processed"] and rows["1"]["ocr_error"] is None
    assert rows["2"]["ocr_results"] == "part" and rows["2"]["ocr_error"] == "unreadable" and not rows["2"]["ocr_processed"]
    last = ocr_work.last_results(spark.createDataFrame([("1", 0, 1, "a"), ("1", 0, 2, "b")], "id string, page_index int, n int, r string"), "id", "n")
    assert last.first()["r"] == "b"
    assert values(spark, ["x"], lambda c: ocr_work.error_text(F.array(c, c, c, c))) == ["x; x; x"]


def test_windows_agree_with_the_loop(spark):
    for context, stride in ((8, 4), (5, 5), (4, 7), (6, 1), (1, 1)):
        df = spark.createDataFrame([(n, n) for n in range(40)], "k bigint, n bigint")
        got = sorted((r["k"], r["chunk"], r["begin_loc"], r["end_loc"], r["scored"]) for r in perplexity.windows(df, "k", "n", context, stride).collect())
        assert got == sorted((n, *w) for n in range(40) for w in perplexity.plan(n, context, stride)), (context, stride)
        if stride < context:
            for n in range(context + 1, 40):
                assert sum(w[3] for w in perplexity.plan(n, context, stride)) == n - 1


def test_statistics_agree_with_numpy(spark):
    rng = np.random.default_rng(0)
    ppl, n = rng.uniform(1, 50, 31), rng.integers(1, 9, 31)
    df = spark.createDataFrame([("a", float(p), int(k)) for p, k in zip(ppl, n, strict=True)], "k string, ppl double, scored bigint")
    row = {r["k"]: r for r in perplexity.statistics(df, "k", keys=spark.createDataFrame([("a",), ("none",)], "k string")).collect()}
    assert row["a"]["mean_ppl"] == pytest.approx(np.exp((np.log(ppl) * n).sum() / n.sum()))
    for name, q in (("median_ppl", 50), ("p90", 90), ("p95", 95), ("p99", 99)):
        assert row["a"][name] == pytest.approx(np.percentile(ppl, q))
    assert row["a"]["penalized_ppl"] == pytest.approx(np.sqrt((ppl**2).mean()))
    assert row["none"]["mean_ppl"] == float("inf") and row["none"]["num_chunks"] == 0


def test_model_scores_use_the_plan(spark):
    df = spark.createDataFrame([("a", list("abcdefghij")), ("b", ["x"])], "k string, words array<string>")
    got = perplexity.model_scores(df, "k", "words", lambda: lambda tokens, start, end: float(end - start), 4, 2)
    assert sorted((r["chunk"], r["scored"]) for r in got.collect()) == [(c, s) for c, _, _, s in perplexity.plan(10, 4, 2)]


def test_search(spark):
    docs = spark.createDataFrame([(1, "The cat and the dog"), (2, "the CAT"), (3, ""), (4, None)], "doc_id bigint, text string")
    index = search.index(docs, "doc_id", stops=())
    assert sorted(one(search.search(index, "doc_id", ["Cats", "the"]))) == [(1,), (2,)]
    assert ("the", 1, 2) in one(index) and "the" not in {t for t, _, _ in one(search.index(docs, "doc_id"))}
    papers = spark.createDataFrame([(1, "Müller, 李", "Queries in 2024", "flies buses glass gas"), (2, None, "query", None)], "id bigint, authors string, title string, abstract string")
    columns = ["authors", "title", "abstract"]
    assert {t for t, i, _ in one(search.index(papers, "id", columns)) if i == 1} == {"müller", "李", "query", "2024", "fly", "buse", "glass", "ga"}
    assert sorted(one(search.search(search.index(papers, "id", columns), "id", ["queries"]))) == [(1,), (2,)]


def test_a_stream_reads_each_file_once(spark, tmp_path):
    shop = store.SnapshotStore(spark, str(tmp_path / "store"))
    papers, categories, links = empty_tables(spark)
    shop.publish(papers=papers, categories=categories, links=links)
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / f"in/{i}.jsonl").write_text("".join(json.dumps({"id": f"{i}.{k}", "categories": "c"}) + "\n" for k in range(3)))
        incremental.ingest_stream(spark, str(tmp_path / "in"), shop, str(tmp_path / "checkpoint"))
        assert shop.read("papers").count() == 3 * (i + 1) and shop.read("categories").count() == 1
    assert not incremental.poll(lambda: spark.range(0), lambda df: None)


def test_workers_stop_when_idle(spark):
    todo, pauses = [3, 0, 2, 0, 0, 5], []
    select = lambda: spark.range(todo.pop(0))
    done = []
    assert incremental.work(select, lambda df: done.append(df.count()), idle_limit=2, sleep=pauses.append) == 2
    assert done == [3, 2] and todo == [5] and pauses == [10.0, 10.0]


def test_time_of_a_batch_of_pages(spark):
    now, loads = [0.0], []
    hang = threading.Event()

    def load():
        loads.append(1)

        def model(image, page):
            if page == 2:
                hang.wait(5)
            if page == 4:
                raise ValueError("unreadable")
            now[0] += 1
            return str(page)

        return model

    model = ocr_work.Recycled(load, 0.2, 3, clock=lambda: now[0] / 1000)
    model.begin()
    assert [model(b"", p) for p in (0, 1)] == ["0", "1"]
    with pytest.raises(ocr_work.TimedOut):
        model(b"", 2)
    hang.set()
    with pytest.raises(ValueError):
        model(b"", 4)
    assert [model(b"", p) for p in (5, 6, 7)] == ["5", "6", "7"] and len(loads) == 3
    now[0] = 300.0
    with pytest.raises(ocr_work.TimedOut):
        model(b"", 8)
    assert (ocr_work.queue_size(1, 2), ocr_work.queue_size(2, 8), ocr_work.queue_size(8, 8)) == (8, 32, 64)
    pages = spark.createDataFrame([("a", i, b"x") for i in range(4)], "id string, page int, image binary").repartition(2, "page")
    got = ocr_work.recognised(pages, "id", lambda device: lambda image, page: device, seconds=60.0, recycle_after=1, devices=("gpu0", "gpu1"))
    assert {r["content"] for r in got.collect()} <= {"gpu0", "gpu1"}


def test_pictures(spark, tmp_path):
    boxes = [("Text", [2.0, 3.0, 20.0, 12.0]), ("table", [30.0, 5.0, 400.0, 25.0]), ("table", [1.0])]
    document = {"results": [{"page_index": 0, "dpi": 100, "layout_det_res": {"boxes": [{"label": n, "content": "", "text": "", "score": "0.5", "coordinate": c} for n, c in boxes]}}], "total_pages": 1, "processed_pages": 1}
    df = spark.createDataFrame([("k", document)], f"id string, document {ocr_document.DOCUMENT}")
    row = raster.page_pictures(df, "id", width=60, height=40).first()
    picture, texts = read_png(bytes(row["png"]))
    assert texts == ["1. Text (0.50)", "2. table (0.50)"] and picture.shape == (40, 60 + raster.PANEL, 3)
    assert tuple(picture[3, 10]) == ocr_document.COLOURS["text"] and tuple(picture[15, 31]) == ocr_document.COLOURS["table"] and tuple(picture[8, 10]) == raster.WHITE
    picture, texts = read_png(raster.report({2007: 4, 2008: 8}, {1: 5}))
    assert texts == ["2007: 4", "2008: 8", "1: 5"] and picture.shape == (400, 1280, 3)
    dark = (picture == raster.INK).all(axis=2)
    assert dark[:, 100].sum() * 2 == dark[:, 500].sum() == 380
    (tmp_path / "in.jsonl").write_text(json.dumps({"id": "1", "versions": [{"version": "v1", "created": "Mon, 2 Apr 2007 19:18:42 GMT"}]}) + "\n")
    assert cli.main(["profile", str(tmp_path / "in.jsonl"), "--png", str(tmp_path / "out.png")]) == 0
    assert read_png((tmp_path / "out.png").read_bytes())[1] == ["2007: 1", "1: 1"]


def read_png(raw):
    """Picture and texts of an 8-bit RGB file without filters."""
    at, body, texts, size = 8, b"", [], None
    while at < len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        part = raw[at + 8 : at + 8 + n]
        assert struct.unpack(">I", raw[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + part)
        if kind == b"IHDR":
            size = struct.unpack(">II", part[:8])
        elif kind == b"IDAT":
            body += part
        elif kind == b"iTXt":
            texts.append(part.split(b"\0", 5)[5].decode())
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(size[1], -1)
    assert not rows[:, 0].any()
    return rows[:, 1:].reshape(size[1], size[0], 3), texts
