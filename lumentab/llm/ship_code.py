"""What a session needs before these operators run: the package on its executors, and Arrow batches bounded by bytes."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lumentab.session import ship_code

#: Bytes of an Arrow batch.  Spark's default of 64 MB is held several times over by an executor and by each of its workers.
BATCH_BYTES = 2 << 20
_LIMIT, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package, once; and lower the limit of Arrow batches unless the session has set its own."""
    ship_code(spark)
    if spark.conf.get(_LIMIT).rstrip("b") == str(_DEFAULT):
        spark.conf.set(_LIMIT, f"{BATCH_BYTES}b")
