"""WARC archives: a writer, a normaliser for monolithic gzip, and a reader.

``written_archives`` writes one archive per task as a single gzip stream, the form
that many tools leave behind.  ``normalised`` inflates each such stream once, in
pieces, rewrites every record as a gzip member of its own, and writes a sidecar
index with the offset and length of each member.  ``records`` reads archives through
their index, member by member.

Payloads that occur more than once are stored once: of equal payloads of at
least ``least_bytes`` the page with the smallest id is the response, the others are
revisit records that refer to it.

Files lie in a folder that driver and executors share and are reached through
Arrow's file systems.  A task writes under a name of its own attempt; only
archives in the returned manifest count, so that a task that is run again does
no harm.  No record is held but the one at hand.

Edge cases: null payloads are empty; null urls have no target header; control
characters in urls and all special characters in ids are percent-encoded; null page ids are kept, never refer and
are never referred to; rows that repeat an id are records of their own; an empty table gives no archives; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrollspark.llm.tables import arrow_rows, fresh_path, removed, written

DATE = "2024-01-01T00:00:00Z"
URN = "urn:page"
PIECE = 1 << 18
GZIP = 31  # zlib's window bits for gzip
INDEX = ".idx"


def identity(ident: object) -> str:
    """The URN of a page; the id is percent-encoded, so that any text can be one."""
    return URN if ident is None else f"{URN}:{quote(str(ident), safe='')}"


def page_of(urn: str) -> str | None:
    urn = urn.strip("<>")
    return unquote(urn[len(URN) + 1 :]) if urn.startswith(URN + ":") else None if urn == URN else urn


def payloads(pages: DataFrame, least_bytes: int = 100, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """_id, payload_bytes, payload_digest and refers_to (null for responses) of every page."""
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).alias("_id"), F.octet_length(body).cast("bigint").alias("payload_bytes"), F.sha2(body, 256).alias("payload_digest"))
    return _referring(base, _repeated(base, least_bytes))


def _repeated(base: DataFrame, least_bytes: int) -> DataFrame:
    """payload_digest and _first, the smallest id, of payloads that more than one page has."""
    groups = base.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_k"))
    return written(groups.where("_k > 1").drop("_k"), "warc-repeated")


def _referring(base: DataFrame, firsts: DataFrame) -> DataFrame:
    """refers_to beside the columns of base, instead of _first."""
    found = base.join(firsts.hint("merge"), "payload_digest", "left")
    return found.withColumn("refers_to", F.when(F.col("_id") != F.col("_first"), F.col("_first"))).drop("_first")


def record(ident: object, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: object) -> bytes:
    """One uncompressed WARC record: a response with its payload, or a revisit without."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"") if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{identity(ident)}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{identity(refers_to)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and raw bytes of each record of an inflated stream."""
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        at = -1
        while (at := held.find(b"\r\n\r\n", max(0, at))) < 0:
            at = len(held) - 3
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError("the last record has no end of its headers")
                return
        head = headers(bytes(held[:at]))
        size = at + 4 + int(head["content-length"]) + 4
        if not fill(size):
            raise ValueError("the last record is cut short")
        yield head, bytes(held[:size])
        del held[:size]


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file, of one or more members, in pieces."""
    engine, rest = zlib.decompressobj(GZIP), b""
    while True:
        raw = rest or source.read(PIECE)
        rest = b""
        if not raw:
            if not engine.eof:
                raise ValueError("the gzip stream is cut short")
            return
        if engine.eof:
            engine = zlib.decompressobj(GZIP)
        piece = engine.decompress(raw, 1 << 22)
        rest = engine.unused_data or engine.unconsumed_tail
        if piece:
            yield piece


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if re.match(r"\w+:", uri) else f"file://{uri}")


def written_archives(pages: DataFrame, folder: str, least_bytes: int = 100, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", level: int = 1) -> DataFrame:
    """Writes monolithic archives to the folder; the manifest: archive, records."""
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    raw = body.cast("binary")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), body.alias("_body"), F.sha2(raw, 256).alias("payload_digest"), F.octet_length(raw).cast("bigint").alias("payload_bytes"))
    rows = _referring(rows, _repeated(rows.select("_id", "payload_bytes", "payload_digest"), least_bytes))
    rows = rows.select("_id", "_url", F.when(F.col("refers_to").isNull(), F.col("_body")).alias("_body"), "payload_digest", "payload_bytes", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.mono.warc.gz"
        engine, count, sink = zlib.compressobj(level, zlib.DEFLATED, GZIP), 0, None
        for batch in batches:
            for ident, url, text, digest, size, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sink is None:
                    sink = files.open_output_stream(f"{base}/{name}", compression=None)
                sink.write(engine.compress(record(ident, url, None if text is None else text.encode(), digest, size, refers)))
                count += 1
        if sink is not None:
            sink.write(engine.flush())
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64())], ["archive", "records"])

    with arrow_rows(pages.sparkSession, 1000):
        return written(rows.mapInArrow(run, "archive string, records bigint"), "warc-monolithic")


def normalise_file(source_uri: str, target_uri: str, level: int = 4) -> int:
    """One member per record, and the index beside; returns the number of records."""
    files, path = _filesystem(source_uri)
    out_files, target = _filesystem(target_uri)
    at = count = 0
    with files.open_input_stream(path, compression=None) as source, out_files.open_output_stream(target, compression=None) as sink, out_files.open_output_stream(target + INDEX, compression=None) as index:
        for head, raw in split_records(inflated(source)):
            engine = zlib.compressobj(level, zlib.DEFLATED, GZIP)
            member = engine.compress(raw) + engine.flush()
            sink.write(member)
            entry = {"offset": at, "length": len(member), "type": head["warc-type"], "id": head.get("warc-record-id"), "uri": head.get("warc-target-uri")}
            index.write(json.dumps(entry, ensure_ascii=False).encode() + b"\n")
            at += len(member)
            count += 1
    return count


def normalised(manifest: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """Rewrites each archive of the manifest; the new manifest: archive, records."""
    spark = manifest.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                count = normalise_file(archive, name, level)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], ["archive", "records"])

    return written(_spread(spark, manifest).mapInArrow(run, "archive string, records bigint"), "warc-normalised")


def _spread(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """A manifest has a row per archive, with a name of its own: ranges of one name each, so one archive, one task."""
    return manifest.repartitionByRange(max(1, manifest.count()), "archive")


def read_record(raw: bytes) -> dict:
    """Type, id, url, what a revisit refers to, payload (None for revisits), its digest and full size."""
    edge = raw.index(b"\r\n\r\n")
    head = headers(raw[:edge])
    block = raw[edge + 4 : edge + 4 + int(head["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    kind = head["warc-type"]
    ident = lambda k: page_of(head[k]) if k in head else None
    digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response":
        found = hashlib.sha256(payload).hexdigest()
        if digest and found != digest:
            raise ValueError(f"payload of {head.get('warc-record-id')} does not have its digest")
        digest = found
    return {"id": ident("warc-record-id"), "url": head.get("warc-target-uri"), "type": kind, "refers_to": ident("warc-refers-to"), "digest": digest, "size": len(payload) if kind == "response" else int(size[1]) if size else None, "payload": payload if kind == "response" else None}


READ = pa.schema([("id", pa.string()), ("url", pa.string()), ("type", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("size", pa.int64())])


def records(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of normalised archives, read through the sidecar index: id, url, type, refers_to, digest, size[, payload]."""
    schema = READ.append(pa.field("payload", pa.binary())) if payload else READ

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                files, path = _filesystem(archive)
                rows, size = [], 0
                with files.open_input_stream(path + INDEX, compression=None) as index, files.open_input_file(path) as source:
                    for line in _lines(index):
                        entry = json.loads(line)
                        rows.append(read_record(zlib.decompress(source.read_at(entry["length"], entry["offset"]), GZIP)))
                        size += rows[-1]["size"] or 0
                        if len(rows) == 1000 or size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ddl = "id string, url string, type string, refers_to string, digest string, size bigint" + ", payload binary" * payload
    return _spread(manifest.sparkSession, manifest).mapInArrow(run, ddl)


def _lines(source) -> Iterator[bytes]:
    held = b""
    while piece := source.read(PIECE):
        *lines, held = (held + piece).split(b"\n")
        yield from lines
    if held:
        yield held


def archived(pages: DataFrame, least_bytes: int = 100, payload: bool = False, **columns) -> DataFrame:
    """Writes pages to archives in the shared folder, normalises them, and reads all records back."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    monolithic = written_archives(pages, f"{folder}/monolithic", least_bytes, **columns)
    manifest = normalised(monolithic, f"{folder}/members")
    removed(spark, f"{folder}/monolithic")
    return records(manifest, payload)
