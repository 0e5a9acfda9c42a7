"""Runs from metadata to reports over a store."""

import json

import pytest
from pyspark.sql import functions as F

from scrollspark import cli
from scrollspark.operators import status, workflow
from scrollspark.operators.ingest import with_ordinals
from scrollspark.operators.store import SnapshotStore
from scrollspark.sources import fetch


class Pages:
    def page_count(self, content):
        if content.endswith(b"bad"):
            raise ValueError("unreadable")
        return 3

    def render(self, content, page, dpi):
        return content


@pytest.fixture
def shop(spark, tmp_path):
    return workflow.initialised(SnapshotStore(spark, str(tmp_path / "store")))


def fetcher():
    return lambda url, timeout: fetch.Response(404 if url.endswith("/2.pdf") else 200, None, None, b"%PDF-" + (b"bad" if url.endswith("/3.pdf") else b""))


def test_from_lines_to_reports(spark, shop, tmp_path):
    (tmp_path / "in.jsonl").write_text("".join(json.dumps({"id": str(i), "title": f"t{i}", "categories": "a b"}) + "\n" for i in range(5)))
    lines = with_ordinals(spark.read.text(str(tmp_path / "in.jsonl")))
    assert workflow.process(shop, lines, "http://x/pdf", fetcher, limit=4, delay=0, workers=2) == {"accepted": 4, "skipped": 0, "downloaded": 3, "failed": 1}
    again = workflow.process(shop, lines, "http://x/pdf", fetcher, delay=0, workers=2)
    assert again == {"accepted": 1, "skipped": 4, "downloaded": 1, "failed": 0}
    counts = status.counts(workflow.flagged(shop.read("papers"))).first()
    assert (counts["total"], counts["with_pdfs"], counts["failed"]) == (5, 4, 1)
    assert workflow.process(shop, None, "http://x/pdf", None)["accepted"] == 0

    assert workflow.run_ocr(shop, Pages, per_run=2) == 4
    rows = {r["id"]: r for r in shop.read("papers").collect()}
    assert not rows["0"]["ocr_processed"] and rows["0"]["ocr_results"]["processed_pages"] == 2 and rows["3"]["ocr_error"] == "unreadable"
    assert workflow.run_ocr(shop, Pages, per_run=2) == 3
    rows = {r["id"]: r for r in shop.read("papers").collect()}
    assert rows["0"]["ocr_processed"] and [p["page_index"] for p in rows["0"]["ocr_results"]["results"]] == [0, 1, 2]
    assert workflow.run_ocr(shop, Pages) == 0

    report = workflow.perplexity_report(shop.read("papers"), context=4, stride=2, worst=1)
    assert {r["id"] for r in report.statistics.collect()} == {"0", "1", "4"} and report.worst.count() == 3
    assert {r["band"] for r in report.bands.collect()} == {"Very low"}


def test_folders(spark, shop, tmp_path):
    lines = spark.createDataFrame([(json.dumps({"id": i}), k) for k, i in enumerate(["a/1", "b"])], "value string, ordinal bigint")
    workflow.process(shop, lines, "", None)
    found = spark.createDataFrame([("a/1", bytearray(b"x")), ("zz", bytearray(b"y"))], "id string, content binary")
    assert workflow.load_files(shop, found) == {"loaded": 1, "skipped": 0, "unknown": 1}
    assert workflow.load_files(shop, found) == {"loaded": 0, "skipped": 1, "unknown": 1}
    assert workflow.sync_folder(shop, found.select("id").where(F.col("id") == "zz")) == 1
    assert shop.read("papers").where("pdf_downloaded").count() == 0


def test_arguments():
    for bad in (["profile"], ["--store", "x", "candidates", "--limit", "0"], ["--store", "x", "ocr-queue", "--offset", "-1"], ["list"]):
        with pytest.raises(SystemExit):
            cli.main(bad)
    assert cli.parser().parse_args(["--store", "x", "perplexity"]).stride == 512
