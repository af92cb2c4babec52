"""Registry of the runnable queries and their independent SQL statements."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Plan = Callable[[SparkSession, str], DataFrame]
PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"query {name} registered twice")
        PLANS[name] = plan
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return plan

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_every(key: str, step: int, c: str) -> Column:
    """The driver tables hold no NULL: blank every ``step``-th key, as the SQL side does."""
    return F.when(F.col(key) % step != 0, F.col(c)).alias(c)


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round floating columns (all when none is named); adding 0.0 removes the negative zero."""
    names = cols or tuple(n for n, t in df.dtypes if t in ("double", "float"))
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in names})


def as_long(df: DataFrame, *cols: str) -> DataFrame:
    names = cols or tuple(n for n, t in df.dtypes if t in ("int", "smallint", "tinyint"))
    return df.withColumns({c: F.col(c).cast("long") for c in names})
