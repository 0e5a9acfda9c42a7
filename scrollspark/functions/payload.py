"""Checks of downloaded payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PDF_SIGNATURE = "%PDF-"  # fixed value
MAX_BYTES = 100 * 1024 * 1024


def content_type_ok(content_type: Column) -> Column:
    """Missing, or of a PDF or plain bytes."""
    kind = F.lower(content_type)
    return F.coalesce(content_type == "", F.lit(True)) | F.coalesce(kind.contains("pdf") | kind.contains("octet-stream"), F.lit(True))


def outcome(body: Column, max_bytes: int = MAX_BYTES, signature: str = PDF_SIGNATURE, content_length: Column | None = None) -> Column:
    """ok, too large or bad signature; an unreadable length header is ignored."""
    large = F.octet_length(body) > max_bytes
    if content_length is not None:
        large = large | F.coalesce(content_length.try_cast("bigint") > max_bytes, F.lit(False))
    head = F.substring(body, 1, len(signature)) == F.lit(signature).cast("binary")
    return F.when(large, "too large").when(~F.coalesce(head, F.lit(False)), "bad signature").otherwise("ok")
