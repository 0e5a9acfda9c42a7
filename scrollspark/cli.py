"""Command line: profile, migrate, process, sync, load-files, candidates, ocr-mock, perplexity, list.

    python -m scrollspark.cli profile FILE
    python -m scrollspark.cli --store DIR process --json FILE --limit 100
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import functions as F

from scrollspark.functions import raster
from scrollspark.operators import perplexity, profile, schema, status, workflow
from scrollspark.operators.store import SnapshotStore
from scrollspark.session import create, ship
from scrollspark.sources import fetch, files


def positive(text: str) -> int:
    n = int(text)
    if n <= 0:
        raise argparse.ArgumentTypeError("must be greater than 0")
    return n


def not_negative(text: str) -> int:
    n = int(text)
    if n < 0:
        raise argparse.ArgumentTypeError("must not be negative")
    return n


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="scrollspark")
    p.add_argument("--store", help="folder of the tables")
    p.add_argument("--master", help="Spark master, by default that of the environment")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("profile", help="articles per year, versions per article")
    c.add_argument("file")
    c.add_argument("--png", help="file for the two histograms")
    c = sub.add_parser("process", help="load metadata and reconcile")
    c.add_argument("--json", help="JSON lines of metadata")
    c.add_argument("--limit", type=positive)
    c.add_argument("--max-records", type=positive)
    c.add_argument("--no-resume", action="store_true")
    c.add_argument("--url-base", help="download what was loaded from below this URL")
    c.add_argument("--workers", type=positive, default=4)
    c.add_argument("--delay", type=float, default=fetch.DELAY)
    c = sub.add_parser("migrate", help="take the tables to a level")
    c.add_argument("--level", type=positive, default=schema.HEAD)
    c = sub.add_parser("sync", help="set download flags by the files of a folder")
    c.add_argument("--pdf-path", required=True)
    c = sub.add_parser("load-files", help="store the PDFs of a folder")
    c.add_argument("--pdf-directory", required=True)
    c.add_argument("--limit", type=positive)
    c.add_argument("--no-skip-existing", action="store_true")
    c = sub.add_parser("candidates", help="papers to download")
    c.add_argument("--limit", type=positive, default=100)
    c.add_argument("--categories", nargs="*", default=[])
    c.add_argument("--retry-errors", action="store_true")
    c = sub.add_parser("ocr-queue", help="papers to recognise")
    c.add_argument("--limit", type=positive, default=10)
    c.add_argument("--offset", type=not_negative, default=0)
    c.add_argument("--retry-errors", action="store_true")
    c = sub.add_parser("perplexity", help="score OCR texts with unigram frequencies")
    c.add_argument("--paper-id")
    c.add_argument("--context-length", type=positive, default=perplexity.CONTEXT)
    c.add_argument("--stride", type=positive, default=perplexity.STRIDE)
    c.add_argument("--penalty-power", type=float, default=perplexity.POWER)
    c.add_argument("--show-worst", type=positive, default=perplexity.WORST)
    c = sub.add_parser("list", help="papers with OCR results")
    c.add_argument("--limit", type=positive, default=20)
    sub.add_parser("status", help="progress counts")
    return p


def main(argv: list[str] | None = None) -> int:
    p = parser()
    args = p.parse_args(argv)
    if args.command != "profile" and not args.store:
        p.error("--store is needed")
    spark = ship(create(master=args.master))
    if args.command == "profile":
        found = profile.articles(files.lines(spark, args.file)).persist()
        profile.summary(found).show()
        profile.last_years(profile.year_histogram(found)).show()
        profile.version_histogram(found).orderBy("n_versions").show(1000)
        if args.png:
            years = {r["year"]: r["articles"] for r in profile.year_histogram(found).orderBy("year").collect()}  # a row a year
            versions = {r["n_versions"]: r["articles"] for r in profile.version_histogram(found).where("kept").orderBy("n_versions").collect()}  # under a thousand rows
            Path(args.png).write_bytes(raster.report(years, versions))
        return 0
    shop = SnapshotStore(spark, args.store)
    if args.command == "migrate":
        print({"levels": schema.run_migrations(shop, args.level)})
        return 0
    workflow.initialised(shop)
    papers = workflow.flagged(shop.read("papers"))
    if args.command == "process":
        lines = files.numbered_lines(spark, args.json, args.max_records) if args.json else None
        fetcher = fetch.HttpFetcher if args.url_base else None
        print(workflow.process(shop, lines, args.url_base or "", fetcher, limit=args.limit, resume=not args.no_resume, workers=args.workers, delay=args.delay))
    elif args.command == "sync":
        print({"changed": workflow.sync_folder(shop, files.pdf_files(spark, args.pdf_path, content=False).select("id"))})
    elif args.command == "load-files":
        found = files.pdf_files(spark, args.pdf_directory, args.limit)
        print(workflow.load_files(shop, found, not args.no_skip_existing))
    elif args.command == "candidates":
        status.download_candidates(papers, args.limit, args.categories, args.retry_errors).show(args.limit, False)
    elif args.command == "ocr-queue":
        status.ocr_candidates(papers, args.limit, args.offset, args.retry_errors).show(args.limit, False)
    elif args.command == "perplexity":
        chosen = papers if args.paper_id is None else papers.where(F.col("id") == args.paper_id)
        report = workflow.perplexity_report(chosen, context=args.context_length, stride=args.stride, power=args.penalty_power, worst=args.show_worst)
        report.statistics.join(report.bands, "id").show(truncate=False)
        report.worst.show(truncate=False)
    elif args.command == "list":
        status.available(papers, args.limit).show(args.limit, False)
    else:
        status.counts(papers).show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
