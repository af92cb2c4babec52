"""One-pass profiles: describe, null and duplicate reports, histograms, box statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lumentab.operators import order
from lumentab.operators.reshape import name_of, stack_cells
from lumentab.operators.ship import ship_if_short


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def stats_by_column(
    df: DataFrame,
    cols: Sequence[str],
    stats: Mapping[str, Callable[[Column], Column]],
    by: Sequence[str] = (),
) -> DataFrame:
    """All statistics of all columns in one aggregate, as rows (group, column, stat ...)."""
    aggs = [f(F.col(c)).alias(f"{c}|{s}") for c in cols for s, f in stats.items()]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{s}`").alias(s) for s in stats]) for c in cols
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sd (n-1), min, quartiles, max per numeric column."""
    by = list(by)
    moments = stats_by_column(
        df,
        cols,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(c).cast("double"),
            "max": lambda c: F.max(c).cast("double"),
        },
        by,
    )
    q = order.quantiles(df, cols, (0.25, 0.5, 0.75), by).select(
        *by, "column", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75")
    )
    return moments.join(q, [*by, "column"], "left").select(
        *by, "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def to_long(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str],
            name: str = "stat", value: str = "value") -> DataFrame:
    """Melt columns to rows (ids, name, value)."""
    return df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in value_cols]).unpivot(
        list(id_cols), list(value_cols), name, value
    )


def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls, share of nulls and empty texts per column in one aggregate."""
    return stats_by_column(
        df,
        cols,
        {
            "nulls": lambda c: F.count_if(c.isNull()),
            "null_pct": lambda c: F.count_if(c.isNull()) * 100.0 / F.count(F.lit(1)),
            "empty": lambda c: F.count_if(F.trim(c.cast("string")) == ""),
        },
    )


def require_complete(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise if any of the columns holds a NULL: one aggregate, stops nothing else."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    bad = {c: row[c] for c in cols if row[c]}
    if bad:
        raise ValueError(f"missing values left: {bad}")


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def null_rows(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows (key, column) for every missing cell: one scan, one generator."""
    gaps = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    return df.select(*key, F.explode(gaps).alias("column"))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct values per column.

    Values are de-duplicated per (column, value) before they are counted, so that one
    column is counted by many tasks instead of one.
    """
    cells = [{"column": F.lit(i), "value": F.col(c).cast("string")} for i, c in enumerate(cols)]
    return (
        stack_cells(df, [], cells).where(F.col("value").isNotNull()).distinct()
        .groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
        .withColumn("column", name_of("column", cols))
    )


def duplicate_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each group of equal rows (NULLs compare equal)."""
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicates"),
    )


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row of every key in the given order.

    ``min`` over a struct combines on the map side; a window would pull all copies of a
    hot key into one task.
    """
    rest = [c for c in df.columns if c not in key and c not in order_by]
    packed = F.struct(*order_by, *rest)
    return df.groupBy(*key).agg(F.min(packed).alias("_first")).select(
        *key, *[F.col(f"_first.{c}").alias(c) for c in [*order_by, *rest]]
    ).select(*df.columns)


def value_counts(df: DataFrame, c: str, domain: Sequence | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Absolute and relative counts; values of a given domain that never occur count 0, others stay."""
    by = list(by)
    counted = df.groupBy(*by, c).agg(F.count(F.lit(1)).alias("n"))
    if domain is not None:
        if by:
            raise ValueError("a fixed domain is supported for ungrouped counts")
        full = df.sparkSession.createDataFrame([(v,) for v in domain], df.select(c).schema)
        known = full.withColumnRenamed(c, "_value")
        counted = known.join(counted, F.col("_value").eqNullSafe(F.col(c)), "full").select(
            F.coalesce(c, "_value").alias(c), F.coalesce("n", F.lit(0)).alias("n"))
    totals = counted.groupBy(*by).agg(F.sum("n").alias("_total"))
    if by:
        return counted.join(totals, by).withColumn("share", F.col("n") / F.col("_total")).drop("_total")
    return counted.withColumn("share", F.col("n") / totals.scalar())


def histogram(df: DataFrame, c: str, bins: int, by: Sequence[str] = (),
              limits: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width bin counts; the last bin is closed; values outside fixed limits are left out."""
    value = F.col(c).cast("double")
    if limits is None:
        row = df.agg(F.min(value), F.max(value)).first()
        if row[0] is None:
            return df.select(*by, F.lit(0).alias("bin"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"),
                             F.lit(0).cast("long").alias("n")).limit(0)
        limits = (row[0], row[1])
    low, high = limits
    if low == high:  # numpy widens a degenerate range by one half on both sides
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    number = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        df.where(value.between(low, high)).groupBy(*by, number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*by, "bin", (F.lit(low) + F.col("bin") * width).alias("lo"),
                (F.lit(low) + (F.col("bin") + 1) * width).alias("hi"), "n")
    )


def box_stats(df: DataFrame, c: str, by: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (extreme values inside the limits) and outlier count per group."""
    by = list(by)
    q = order.quantiles(df, [c], (0.25, 0.5, 0.75), by).select(
        *by, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    return _apply_limits(df, c, q, by, whisker)


def _apply_limits(df: DataFrame, c: str, q: DataFrame, by: list[str], whisker: float) -> DataFrame:
    low = F.col("q1") - whisker * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + whisker * (F.col("q3") - F.col("q1"))
    value = F.col(c).cast("double")
    inside = (value >= low) & (value <= high)
    if by:
        joined = df.join(ship_if_short(q), by)
    else:
        r = q.first()
        joined = df.select("*", *[F.lit(r[n] if r else None).cast("double").alias(n) for n in ("q1", "median", "q3")])
    return joined.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def density_curve(df: DataFrame, c: str, grid: Sequence[float]) -> DataFrame:
    """Gaussian kernel density at the grid points; bandwidth n^(-1/5) * sd (n-1).

    One aggregate with one sum per grid point: no row is multiplied by the grid.
    """
    value = F.col(c).cast("double")
    n, sd = df.agg(F.count(value), F.stddev_samp(value)).first()
    if not sd:  # no bandwidth: fewer than two values, or all alike
        return df.sparkSession.createDataFrame([(float(g), None) for g in grid], "x double, density double")
    h = float(n) ** (-0.2) * sd
    norm = 1.0 / (n * h * (2.0 * 3.141592653589793) ** 0.5)
    sums = [
        F.sum(F.exp(-0.5 * F.pow((value - F.lit(float(g))) / F.lit(h), F.lit(2.0)))).alias(f"g{i}")
        for i, g in enumerate(grid)
    ]
    rows = [F.struct(F.lit(float(g)).alias("x"), (F.col(f"g{i}") * norm).alias("density"))
            for i, g in enumerate(grid)]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def extreme_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column with the highest and with the lowest mean (first name on ties)."""
    means = stats_by_column(df, cols, {"mean": F.avg})
    return means.agg(
        F.min_by("column", F.struct(-F.col("mean"), F.col("column"))).alias("max_column"),
        F.max("mean").alias("max_mean"),
        F.min_by("column", F.struct("mean", "column")).alias("min_column"),
        F.min("mean").alias("min_mean"),
    )


def group_summary(df: DataFrame, by: Sequence[str], spec: Mapping[str, Column]) -> DataFrame:
    """Several named aggregates per group, e.g. mean, sd and conditional shares."""
    return df.groupBy(*by).agg(*[e.alias(name) for name, e in spec.items()])


def share_pct(condition: Column) -> Column:
    """Percent of rows where the condition holds (a missing operand counts as not)."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double")) * 100.0


def pivot_mean(df: DataFrame, row: str, column: str, value: str, levels: Sequence) -> DataFrame:
    """Mean by two keys, one output column per given level."""
    return df.groupBy(row).agg(
        *[F.avg(F.when(F.col(column) == F.lit(v), F.col(value))).alias(str(v)) for v in levels]
    )


def any_true(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
