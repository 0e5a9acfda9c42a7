"""Downloads through a pluggable fetcher, with retries and one global rate."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol
from urllib.error import HTTPError
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrollspark.functions.payload import MAX_BYTES, PDF_SIGNATURE

DELAY, RETRIES, TIMEOUT = 3.0, 3, 30.0
OUTCOME = "id string, content binary, error string"


@dataclass
class Response:
    status: int
    content_type: str | None
    content_length: str | None
    body: bytes


class Fetcher(Protocol):
    def __call__(self, url: str, timeout: float) -> Response: ...


@dataclass
class HttpFetcher:
    """GET over HTTP with the standard library; the body is read in pieces and no further than one byte beyond max_bytes."""

    max_bytes: int = MAX_BYTES
    piece: int = 1 << 16
    agent: str = "scrollspark"

    def __call__(self, url: str, timeout: float) -> Response:
        try:
            answer = urlopen(Request(url, headers={"User-Agent": self.agent}), timeout=timeout)
        except HTTPError as refusal:
            answer = refusal
        with answer:
            length = answer.headers.get("Content-Length")
            if length is not None and length.strip().isdigit() and int(length) > self.max_bytes:
                return Response(answer.status, answer.headers.get("Content-Type"), length, b"")
            body = bytearray()
            while len(body) <= self.max_bytes and (piece := answer.read(min(self.piece, self.max_bytes + 1 - len(body)))):
                body += piece
            return Response(answer.status, answer.headers.get("Content-Type"), length, bytes(body))


def problem(response: Response, max_bytes: int = MAX_BYTES) -> str | None:
    """Why a response is not a usable PDF; None if it is."""
    kind = (response.content_type or "").lower()
    if response.status != 200:
        return f"HTTP {response.status}"
    if kind and "pdf" not in kind and "octet-stream" not in kind:
        return f"unexpected content type {response.content_type}"
    length = response.content_length
    if length is not None and length.strip().isdigit() and int(length) > max_bytes or len(response.body) > max_bytes:
        return "too large"
    if not response.body.startswith(PDF_SIGNATURE.encode()):
        return "bad signature"
    return None


def with_retries(fetch: Fetcher, url: str, retries: int = RETRIES, timeout: float = TIMEOUT, pause: float = 1.0, max_bytes: int = MAX_BYTES, sleep: Callable[[float], None] = time.sleep) -> tuple[bytes | None, str | None]:
    """(content, None), or (None, the last error) after so many tries."""
    error: str | None = "not tried"
    for attempt in range(retries):
        try:
            response = fetch(url, timeout)
            error = problem(response, max_bytes)
            if error is None:
                return response.body, None
        except Exception as failure:  # a failed try is a result here
            error = str(failure)
            if attempt + 1 < retries:
                sleep(pause)
    return None, error


def downloaded(urls: DataFrame, load: Callable[[], Fetcher], workers: int = 4, delay: float = DELAY, **options) -> DataFrame:
    """urls: id, url.  One row per id: id, content, error.

    At most workers tasks run at a time, and each waits delay * workers between its requests, so that all
    together keep to one request per delay.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = load()
        for batch in batches:
            for ident, url in zip(batch["id"], batch["url"], strict=True):
                if delay:
                    time.sleep(delay * workers)
                content, error = with_retries(fetch, url, **options)
                yield pd.DataFrame({"id": [ident], "content": [content], "error": [error]})

    return urls.select("id", "url").repartition(workers).mapInPandas(run, OUTCOME)


def downloaded_in_slices(urls: DataFrame, load: Callable[[], Fetcher], folder: str, slices: int = 16, **options) -> DataFrame:
    """As downloaded(), but slice by slice by hash of the id, each written to the folder when it is done.

    Ids that the folder has are not asked for again, so a run that was broken off goes on.
    """
    spark = urls.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.parquet"))
    done = spark.read.schema(OUTCOME).parquet(folder) if there else spark.createDataFrame([], OUTCOME)
    left = urls.join(done.select("id"), "id", "left_anti")
    for k in range(slices):
        downloaded(left.where(F.pmod(F.xxhash64("id"), F.lit(slices)) == k), load, **options).write.mode("append").parquet(folder)
    return spark.read.schema(OUTCOME).parquet(folder)


def saved(contents: DataFrame, folder: str) -> DataFrame:
    """contents: id, content.  Writes each to folder/<safe name>.pdf under a temporary name first; id, path."""
    import pyarrow.fs as pafs

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        files.create_dir(base, recursive=True)
        for batch in batches:
            paths = []
            for ident, content in zip(batch["id"], batch["content"], strict=True):
                name = f"{base}/{ident.replace('/', '__')}.pdf"
                with files.open_output_stream(f"{name}.part", compression=None) as sink:
                    sink.write(content)
                files.move(f"{name}.part", name)
                paths.append(name)
            yield pd.DataFrame({"id": batch["id"], "path": paths})

    return contents.where("content IS NOT NULL").select("id", "content").mapInPandas(run, "id string, path string")


class PageRenderer(Protocol):
    """Page count and page images of a PDF."""

    def page_count(self, content: bytes) -> int: ...

    def render(self, content: bytes, page: int, dpi: int) -> bytes: ...


def rendered(pages: DataFrame, load: Callable[[], PageRenderer], dpi: int = 200) -> DataFrame:
    """pages: id, page, content.  id, page, image."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        renderer = load()
        for batch in batches:
            images = [renderer.render(c, p, dpi) for c, p in zip(batch["content"], batch["page"], strict=True)]
            yield pd.DataFrame({"id": batch["id"], "page": batch["page"], "image": images})

    return pages.select("id", "page", "content").mapInPandas(run, "id string, page int, image binary")
