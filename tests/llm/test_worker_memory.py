"""What a Python worker holds while it measures texts, and after it."""

import tracemalloc

import numpy as np
import pyarrow as pa

from lumentab.llm import pieces, quality, ship_code, words


def test_measures_of_a_batch_take_small_arrays():
    texts = ["ab c a b,\n" * 200 + str(k) for k in range(1000)]
    column = pa.array([None, *texts, ""])
    tracemalloc.start()
    try:
        got = quality.measure_texts(column)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # 2 MB of text: arrays of a block of 1 MB took 40 MB.
    assert peak < 20 << 20
    buf, offsets = words.text_buffers(column)
    assert all(np.array_equal(g, w) for g, w in zip(got, quality.measure_block(buf, offsets), strict=True))


def test_a_worker_drops_the_tables_of_other_functions():
    table = pieces.PieceTable.of(None)
    as_it_is = lambda batches: batches
    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["n"])
    assert list(words.tidy(as_it_is, pieces.KIND)(iter([batch]))) == [batch]
    assert pieces.PieceTable.of(None) is table
    assert list(words.tidy(as_it_is)(iter([batch]))) == [batch]
    assert pieces.PieceTable.of(None) is not table


def test_batches_are_bounded_by_bytes(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    spark.conf.unset(limit)
    try:
        ship_code.prepare(spark)
        sizes = spark.range(0, 6000, 1, 1).selectExpr("repeat('0123456789', 100) AS text").mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["size", "n"]) for b in batches),
            "size long, n long").collect()
    finally:
        spark.conf.set(limit, before)
    assert sum(r.n for r in sizes) == 6000
    assert max(r.size for r in sizes) < 3 << 20
