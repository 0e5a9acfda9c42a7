"""Blocks of a query set, such as a benchmark: what one pass over the documents is asked for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrollspark.llm.bytesops import IS_TERM, utf8, word_hashes, word_spans

BLOCK_BYTES = 4 << 20  # of text, about; an item longer than that is a block of its own


def blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Tables (item, text) of about so many bytes, all texts of an item in one of them; one empty table if there are none.

    Only one block at a time is on the driver, and goes to the tasks of its pass.
    """
    rows = items.select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        yield (rows if n == 1 else rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)).toArrow()


class Terms:
    """The words of a block's items: sorted distinct hashes; codes: from 1, of all words in order; first: of each row its first word."""

    def __init__(self, block: pa.Table):
        data, offsets = utf8(block["text"])
        starts, ends, self.first = word_spans(data, offsets, IS_TERM)
        self.hashes, codes = np.unique(word_hashes(data, starts, ends), return_inverse=True)
        self.codes = codes.astype(np.int32) + 1
        self.items = block["item"].combine_chunks()
