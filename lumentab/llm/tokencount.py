"""Token counts: texts are encoded inside Arrow functions that return lengths only.

A batch is worked on in blocks of equal bytes, long texts fall into pieces at white space (see ``pieces``), and
calls of the tokenizer are balanced by bytes.  Rows are neither shuffled nor returned with ids.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows are counted one by one; an empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField

from lumentab.llm.pieces import KIND, PieceTable
from lumentab.llm.words import blocks, text_buffers, with_columns

LIMIT = 2048


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row; ``path`` names a tokenizer file that executors can open."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        buf, offsets = text_buffers(batch.column(1))
        table = PieceTable.of(path)
        counts = [table.lengths(buf, offsets[lo:hi + 1]) for lo, hi in blocks(offsets)]
        return [pa.array(np.diff(offsets), pa.int64()), pa.array(np.concatenate(counts) if counts else [], pa.int64())]

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    counted = with_columns(rows, run, [StructField("n_bytes", LongType(), False), StructField("n_tokens", LongType(), False)], KIND)
    return counted.select(F.col("doc_id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
