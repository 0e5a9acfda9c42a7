"""Waves of pages, the log of their results, and OCR runs that are broken off."""

import pytest
from pyspark.sql import functions as F

from scrollspark.operators import ocr_work, page_log, ranges, workflow
from scrollspark.operators.store import Conflict, SnapshotStore

RESULT = "id string, page int, content string, error string"


class Broken(RuntimeError):
    pass


class Pages:
    def page_count(self, content):
        return len(content)

    def render(self, content, page, dpi):
        return content[page : page + 1]


def papers_of(spark, folder, sizes, rows_per_file=2):
    return ranges.ranged(spark.createDataFrame(sorted(sizes.items()), "id string, target int").coalesce(1), folder, "id", rows_per_file=rows_per_file)


def waves_of(spark, tmp_path, sizes, wave_pages, per_batch=2):
    papers = papers_of(spark, str(tmp_path / "papers"), sizes)
    plan = ocr_work.page_plan(papers.read().withColumn("processed", F.lit(None).cast("array<int>")), "id", None, per_batch)
    return [sorted(map(tuple, w.collect())) for w in page_log.waves(plan, papers, str(tmp_path / "plan"), wave_pages)]


@pytest.mark.parametrize("wave_pages", [1, 4, 10, 1000])
def test_waves_have_every_page_once_and_batches_in_order(spark, tmp_path, wave_pages):
    sizes = {"a": 5, "b": 0, "c": 9, "d": 2, "e": 1, "f": 6, "g": 2}
    found = waves_of(spark, tmp_path, sizes, wave_pages)
    assert sorted(x for w in found for x in w) == sorted((k, p) for k, n in sizes.items() for p in range(n))
    for name in sizes:
        pages = [p for w in found for k, p in w if k == name]
        assert pages == sorted(pages)
    if wave_pages == 1000:
        assert len(found) == 1
    if wave_pages == 10:
        assert max(map(len, found)) <= 10


def test_a_paper_of_many_pages_and_no_pages_at_all(spark, tmp_path):
    found = waves_of(spark, tmp_path, {"a": 40, "b": 1}, 10)
    assert [len(w) for w in found] == [9, 10, 10, 10, 2]
    assert waves_of(spark, tmp_path / "none", {"a": 0}, 10) == []


def test_slices_join_small_files_and_split_large_ones():
    assert list(page_log._slices({0: 3, 1: 4, 2: 9, 3: 25, 4: 1, 6: 2}, 10)) == [(0, 1, 1), (2, 2, 1), (3, 3, 3), (4, 6, 1)]
    assert list(page_log._slices({}, 10)) == []


def test_the_log_keeps_good_pages_and_its_runs_errors(spark, tmp_path):
    log = page_log.PageLog(SnapshotStore(spark, str(tmp_path / "store")))
    assert log.good().count() == 0 and log.errors("r1").count() == 0
    frame = lambda *rows: spark.createDataFrame(rows, RESULT)
    log.append(frame(("a", 0, "x", None), ("a", 1, None, "bad"), ("b", 0, None, None)), "r1")
    log.append(frame(("a", 1, "y", None), ("c", 0, None, "worse")), "r2", fold_after=1)
    assert sorted(map(tuple, log.good().collect())) == [("a", 0, "x"), ("a", 1, "y"), ("b", 0, None)]
    assert [tuple(r) for r in log.errors("r1").collect()] == []  # its run has ended
    assert [tuple(r) for r in log.errors("r2").collect()] == [("c", 0, "worse")]
    log.append(frame(("a", 1, "a later one", None), ("a", 2, "z", None)), "r2")
    want = [("a", 0, "x"), ("a", 1, "a later one"), ("a", 2, "z"), ("b", 0, None)]
    assert sorted(map(tuple, log.good().collect())) == want
    log.shop.publish(**log.folded())
    assert sorted(map(tuple, log.good().collect())) == want and log._log().folders == ()
    keys = spark.createDataFrame([("a",), ("q",)], "id string")
    assert [(r["id"], sorted(r["processed"])) for r in log.processed(keys).collect()] == [("a", [0, 1, 2])]


def test_errors_of_a_run_outlive_a_fold_within_it(spark, tmp_path):
    log = page_log.PageLog(SnapshotStore(spark, str(tmp_path / "store")))
    log.append(spark.createDataFrame([("a", 0, None, "bad")], RESULT), "r")
    log.append(spark.createDataFrame([("a", 1, "y", None)], RESULT), "r", fold_after=1)
    assert log.errors("r").count() == 1 and log.good().count() == 1


def test_a_fold_rewrites_the_files_of_its_keys_only_and_an_append_none(spark, tmp_path):
    shop = SnapshotStore(spark, str(tmp_path / "store"))
    log = page_log.PageLog(shop, rows_per_file=10)
    log.append(spark.range(100).selectExpr("format_string('%03d', id) AS id", "0 AS page", "'x' AS content", "CAST(NULL AS STRING) AS error").coalesce(1), "r1")
    shop.publish(**log.folded())
    before = {p.path for p in log._base().parts}
    log.append(spark.createDataFrame([("005", 1, "y", None)], RESULT), "r2")
    assert {p.path for p in log._base().parts} == before and len(log._log().folders) == 1
    shop.publish(**log.folded())
    after = {p.path for p in log._base().parts}
    assert len(before) >= 10 and len(before - after) == 1
    assert shop.clean(keep=1, older_than=-60) > 0
    assert log.good().count() == 101


def test_a_log_of_two_writers(spark, tmp_path):
    first, second = (page_log.PageLog(SnapshotStore(spark, str(tmp_path / "store"))) for _ in range(2))
    rows = spark.createDataFrame([("a", 0, "x", None)], RESULT)
    first.shop.begin()
    first.good().count()
    second.append(rows, "r2")
    with pytest.raises(Conflict):
        first.append(rows, "r1")
    assert second.good().count() == 1


def test_a_clean_up_keeps_the_folders_of_a_log(spark, tmp_path):
    shop = SnapshotStore(spark, str(tmp_path / "store"))
    log = page_log.PageLog(shop)
    for page in range(3):
        log.append(spark.createDataFrame([("a", page, "x", None)], RESULT), "r")
    shop.clean(keep=1, older_than=-60)
    assert log.good().count() == 3


def test_a_run_that_is_broken_off_in_mid_paper_loses_one_wave_at_most(spark, tmp_path):
    shop = workflow.initialised(SnapshotStore(spark, str(tmp_path / "store")))
    rows = spark.createDataFrame([("a", bytearray(b"0123456")), ("b", bytearray(b"01"))], "id string, pdf_content binary")
    papers = shop.read("papers").drop("id", "pdf_content").limit(0)
    shop.publish(papers=rows.withColumn("ocr_processed", F.lit(False)).unionByName(papers.drop("ocr_processed"), allowMissingColumns=True).select(*shop.read("papers").columns))

    class Fails(Pages):
        def render(self, content, page, dpi):
            if page >= 4:
                raise Broken("the machine is gone")
            return super().render(content, page, dpi)

    options = {"per_batch": 2, "wave_pages": 4, "dpi": 100}
    with pytest.raises(Exception, match="the machine is gone"):
        workflow.run_ocr(shop, Fails, **options)
    log = page_log.PageLog(shop)
    # The first wave is kept; the second, pages 2 to 5 of a, is lost.
    assert sorted((r["id"], r["page"]) for r in log.good().collect()) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    assert shop.read("papers").where("ocr_processed").count() == 0

    seen = spark.sparkContext.accumulator(0)

    class Counted(Pages):
        def render(self, content, page, dpi):
            seen.add(1)
            return super().render(content, page, dpi)

    assert workflow.run_ocr(shop, Counted, **options) == 2
    assert seen.value == 5
    found = {r["id"]: r for r in shop.read("papers").collect()}
    assert all(r["ocr_processed"] for r in found.values())
    assert [p["page_index"] for p in found["a"]["ocr_results"]["results"]] == list(range(7))
    assert workflow.run_ocr(shop, Pages) == 0


def test_errors_of_pages_make_a_paper_fail_and_are_tried_again(spark, tmp_path):
    shop = workflow.initialised(SnapshotStore(spark, str(tmp_path / "store")))
    rows = spark.createDataFrame([("a", bytearray(b"01x")), ("b", bytearray(b""))], "id string, pdf_content binary")
    names = shop.read("papers").columns
    shop.publish(papers=rows.withColumn("ocr_processed", F.lit(False)).unionByName(shop.read("papers").limit(0), allowMissingColumns=True).select(*names))

    def fails():
        def model(image, page):
            if page == 1:
                raise ValueError(f"page {page} is bad")
            return f"text {page}"

        return model

    assert workflow.run_ocr(shop, Pages, fails, wave_pages=1, per_batch=1) == 2
    found = {r["id"]: r for r in shop.read("papers").collect()}
    assert (found["a"]["ocr_processed"], found["a"]["ocr_error"], found["a"]["ocr_results"]["processed_pages"]) == (False, "page 1 is bad", 2)
    assert found["b"]["ocr_processed"] and found["b"]["ocr_results"]["processed_pages"] == 0
    assert workflow.run_ocr(shop, Pages) == 0  # papers with errors are left alone
    assert workflow.run_ocr(shop, Pages, retry_errors=True) == 1
    row = shop.read("papers").where("id = 'a'").first()
    assert row["ocr_processed"] and row["ocr_error"] is None and [p["page_index"] for p in row["ocr_results"]["results"]] == [0, 1, 2]


def test_a_plain_table_of_pages_becomes_ranges_at_its_first_fold(spark, tmp_path):
    shop = SnapshotStore(spark, str(tmp_path / "store"))
    shop.publish(ocr_pages=spark.createDataFrame([("a", 0, "x", None), ("a", 1, None, "bad"), ("b", 0, "z", None)], RESULT))
    log = page_log.PageLog(shop)
    assert sorted(map(tuple, log.good().collect())) == [("a", 0, "x"), ("b", 0, "z")]
    log.append(spark.createDataFrame([("a", 1, "y", None)], RESULT), "r")
    shop.publish(**log.folded())
    assert sorted(map(tuple, log.good().collect())) == [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")]
    assert shop.read("ocr_pages").columns == ["id", "page", "content", "error"] and len(log._base().parts) >= 1
