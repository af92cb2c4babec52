"""Deterministic splits and folds by the md5 rank of a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumentab.operators.order import rows_at
from lumentab.operators.ship import join_with_nulls, ship_if_short

SLOT, HASH = "_slot", "_hash"
# Rows that share a hash prefix, about, where a class has more than 16^3 times as many.
SLOT_ROWS = 1_000_000


def _prefix_digits(rows: int) -> int:
    """Hex digits that keep the rows of a prefix near ``SLOT_ROWS``; the width decides no result."""
    digits = 3
    while rows > SLOT_ROWS * 16 ** digits:
        digits += 1
    return digits


def _hashed(df: DataFrame, key: str, seed: int) -> DataFrame:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn(HASH, digest).withColumn(SLOT, F.substring(HASH, 1, _prefix_digits(df.count())))


def _slots(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows per (class, hash prefix) with the rows before it and the class total."""
    group = Window.partitionBy(*(by or [F.lit(0)]))
    return (
        rows.groupBy(*by, SLOT).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(
            F.sum("_n").over(group.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(group))
    )


def hash_split(df: DataFrame, key: str, fractions: Sequence[float], names: Sequence[str],
               by: Sequence[str] = (), seed: int = 42, out: str = "split") -> DataFrame:
    """Split with exact sizes ``floor(cumulative fraction * n)`` per class.

    Hash prefixes are counted first.  Nearly all prefixes lie wholly in one part and need
    no sort; only the few that hold a boundary are ranked, in tasks of a million rows or 1/4096 of a class.
    """
    by = list(by)
    rows = _hashed(df, key, seed)
    cumulative = [sum(fractions[: i + 1]) for i in range(len(names) - 1)]

    def part(position: Column) -> Column:
        passed = [
            (position >= F.floor(F.lit(round(c, 12)) * F.col("_total"))).cast("int") for c in cumulative
        ]
        return reduce(lambda a, b: a + b, passed)

    table = ship_if_short(_slots(rows, by).select(
        *by, SLOT, "_before", "_total",
        part(F.col("_before")).alias("_first"),
        part(F.col("_before") + F.col("_n") - 1).alias("_last"),
    ))
    placed = join_with_nulls(rows, table, [*by, SLOT])
    labels = F.array(*[F.lit(n) for n in names])
    settled = placed.where("_first = _last").withColumn(out, F.get(labels, F.col("_first")))
    rank = F.row_number().over(Window.partitionBy(*by, SLOT).orderBy(HASH, key))
    border = (
        placed.where("_first < _last").withColumn("_rank", rank)
        .withColumn(out, F.get(labels, part(F.col("_before") + F.col("_rank") - 1)))
    )
    columns = [*df.columns, out]
    return settled.select(*columns).unionByName(border.select(*columns))


def stratified_split(df: DataFrame, key: str, label: str, fractions: Sequence[float],
                     names: Sequence[str], seed: int = 42, out: str = "split") -> DataFrame:
    """Stratified by class; unstratified if some class has fewer than two rows."""
    smallest = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0]
    by = [label] if smallest is not None and smallest >= 2 else []
    return hash_split(df, key, fractions, names, by, seed, out)


def fold_numbers(df: DataFrame, key: str, k: int, label: str | None = None, seed: int = 42,
                 out: str = "fold") -> DataFrame:
    """Fold = md5 rank inside the class modulo k; ranks are taken per hash prefix."""
    by = [label] if label else []
    rows = _hashed(df, key, seed)
    rank = F.row_number().over(Window.partitionBy(*by, SLOT).orderBy(HASH, key))
    table = ship_if_short(_slots(rows, by).select(*by, SLOT, "_before"))
    placed = join_with_nulls(rows.withColumn("_rank", rank), table, [*by, SLOT])
    return placed.withColumn(
        out, F.pmod(F.col("_before") + F.col("_rank") - 1, F.lit(k)).cast("int")
    ).select(*df.columns, out)


def time_split(df: DataFrame, time: str, limits: Sequence, names: Sequence[str], out: str = "split") -> DataFrame:
    """``names[i]`` for times before ``limits[i]``, the last name from the last limit on; NULL time gets NULL."""
    t = F.col(time)
    chain = F.when(t < F.lit(limits[0]), F.lit(names[0]))
    for limit, name in zip(limits[1:], names[1:]):
        chain = chain.when(t < F.lit(limit), F.lit(name))
    return df.withColumn(out, chain.when(t >= F.lit(limits[-1]), F.lit(names[len(limits)])))


def strided_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """n rows evenly spread over the table in key order, first and last row included."""

    def positions(total: int) -> list[int]:
        if total <= n:
            return list(range(total))
        return [i * (total - 1) // max(n - 1, 1) for i in range(n)]

    return rows_at(df, key, positions)
