"""Correlation, rank tests, collinearity, simple regression."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lumentab.operators import order
from lumentab.operators.reshape import name_of, stack_cells
from lumentab.operators.ship import ship_if_short
from lumentab.session import cut_lineage


def pearson_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (a, b, r) for all i<j pairs, pairwise complete, from one aggregate."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))


def full_matrix(pairs: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Symmetric long matrix with the unit diagonal from the i<j pairs."""
    diagonal = pairs.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], pairs.schema)
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "r")).unionByName(diagonal)


def spearman_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of average ranks, pairwise complete: a pair is ranked on the rows that have both values.

    Of each (column, value) it is counted how many of its rows have a value in each other column.  Running sums of
    these counts along the values are the ranks for every pair at once, so the table is read for the cut points, for
    the counts, and for the correlations, whatever the number of columns and gaps.
    """
    cols, each = list(cols), range(len(cols))
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    here = [F.col(f"c{i}").isNotNull().cast("long").alias(f"h{i}") for i in each]
    long = stack_cells(rows.select("*", *here), [f"h{i}" for i in each], [
        {"column": F.lit(i), "value": F.col(f"c{i}")} for i in each]).where(F.col("value").isNotNull())
    counted = order.running_totals(long, "value", {f"n{i}": F.sum(f"h{i}") for i in each}, ["column"])
    ranks = cut_lineage(counted.select("column", "value", F.array(*[
        F.col(f"n{i}_before") + (F.col(f"n{i}") + 1) / 2.0 for i in each]).alias("ranks")))
    for i in each:
        own = ranks.where(F.col("column") == i).select(F.col("value").alias(f"c{i}"), F.col("ranks").alias(f"r{i}"))
        rows = rows.join(ship_if_short(own), f"c{i}", "left")
    pairs = list(combinations(each, 2))
    both = {(i, j): F.col(f"c{i}").isNotNull() & F.col(f"c{j}").isNotNull() for i, j in pairs}
    wide = rows.agg(*[F.corr(F.when(both[i, j], F.col(f"r{i}")[j]), F.when(both[i, j], F.col(f"r{j}")[i])).alias(f"r{n}") for n, (i, j) in enumerate(pairs)])
    told = [F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), F.col(f"r{n}").alias("r")) for n, (i, j) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*told)))


def target_ranking(df: DataFrame, cols: Sequence[str], target: str, top: int | None = None) -> DataFrame:
    """Correlation of every column with the target, strongest first, sign kept."""
    wide = df.agg(*[F.corr(c, target).alias(f"r{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("r")) for i, c in enumerate(cols)]
    ranked = wide.select(F.inline(F.array(*rows))).orderBy(F.abs("r").desc(), "column")
    return ranked.limit(top) if top else ranked


def mann_whitney(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Two-sided Mann-Whitney U of class 0 against class 1 per column.

    U belongs to class 0; z uses the tie and continuity corrections.  Ranks come from the
    distinct values, so ties cost nothing and no column is sorted by one task.
    """
    long = stack_cells(df, [label], [{"column": F.lit(i), "value": F.col(c).cast("double")} for i, c in enumerate(cols)])
    totals = order.running_totals(
        long, "value",
        {"n": F.count(F.lit(1)), "zeros": F.count_if(F.col(label) == 0), "ones": F.count_if(F.col(label) == 1)},
        ["column"],
    ).withColumn("rank", F.col("n_before") + (F.col("n") + 1) / 2.0)
    n, t = F.col("n_all"), F.col("ties")
    mean = F.col("n0") * F.col("n1") / 2.0
    sd = F.sqrt(F.col("n0") * F.col("n1") / 12.0 * ((n + 1) - t / (n * (n - 1))))
    d = F.col("u") - mean
    found = (
        totals.groupBy("column")
        .agg(
            F.max("zeros_total").cast("double").alias("n0"),
            F.max("ones_total").cast("double").alias("n1"),
            F.max("n_total").cast("double").alias("n_all"),
            F.sum(F.col("rank") * F.col("zeros")).alias("rank_sum"),
            F.sum(F.pow(F.col("n").cast("double"), F.lit(3.0)) - F.col("n")).alias("ties"),
        )
        .where((F.col("n0") > 1) & (F.col("n1") > 1))
        .withColumn("u", F.col("rank_sum") - F.col("n0") * (F.col("n0") + 1) / 2.0)
        .withColumn("z", F.signum(d) * F.greatest(F.abs(d) - 0.5, F.lit(0.0)) / F.nullif(sd, F.lit(0.0)))
        .select(name_of("column", cols).alias("column"), "u", "z").collect()
    )
    # One row per column: the tail of the normal distribution is exact here.
    rows = [(r["column"], r["u"], r["z"], None if r["z"] is None else math.erfc(abs(r["z"]) / math.sqrt(2.0))) for r in found]
    return df.sparkSession.createDataFrame(rows, "column string, u double, z double, p double")


def variance_inflation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation on the matrix without a constant, worst first, with bands at 5 and 10.

    The p x p Gram matrix is one aggregate over the rows; only that matrix is inverted on
    the driver.  Rows with a missing cell are left out.
    """
    p = len(cols)
    index = [(i, j) for i in range(p) for j in range(i, p)]
    row = df.dropna(subset=list(cols)).agg(
        *[F.coalesce(F.sum(F.col(cols[i]).cast("double") * F.col(cols[j])), F.lit(0.0)).alias(f"g{i}_{j}") for i, j in index]
    ).first()
    gram = np.empty((p, p))
    for i, j in index:
        gram[i, j] = gram[j, i] = row[f"g{i}_{j}"]
    scale = np.sqrt(np.diag(gram))  # unit columns first: stable for mixed units
    unit = gram / np.outer(np.where(scale > 0, scale, 1.0), np.where(scale > 0, scale, 1.0))
    vif = []
    for j in range(p):
        rest = [i for i in range(p) if i != j]
        # What the other columns leave unexplained; nothing for a collinear or empty column.
        left = unit[j, j] - unit[j, rest] @ np.linalg.pinv(unit[np.ix_(rest, rest)]) @ unit[rest, j]
        vif.append(1.0 / left if left > 1e-12 else math.inf)
    rows = [(c, float(v), "high" if v > 10 else "moderate" if v > 5 else "low") for c, v in zip(cols, vif)]
    return df.sparkSession.createDataFrame(rows, "column string, vif double, band string").orderBy(F.desc("vif"))


def simple_regression(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and R-squared of y on x per group."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def joint_pairs_above(pairs: DataFrame, limit: float) -> DataFrame:
    """Pairs with |r| above the limit, strongest first."""
    return pairs.where(F.abs("r") > limit).orderBy(F.abs("r").desc(), "a", "b")

