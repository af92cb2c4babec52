"""Fills, scalers, outlier rules, encoders.

``fit_*`` runs one bounded aggregate and returns a small model; ``transform`` is a pure
projection.  Fit on training rows, transform any rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lumentab.functions.columns import clip, strip, unbiased_skewness
from lumentab.operators import order
from lumentab.operators.profile import any_true, stats_by_column
from lumentab.operators.reshape import stack_cells
from lumentab.operators.ship import ship_if_short

IQR_FACTOR = 1.5
MAX_LEVELS = 1000


# ---------------------------------------------------------------- fills

def fit_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols if row[c] is not None}


def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    return {c: q[0] for c, q in order.fit_quantiles(df, cols, (0.5,)).items() if q[0] is not None}


def fit_modes(df: DataFrame, cols: Sequence[str], dtype: str = "double") -> dict:
    """Most frequent value per column, in the type of the column."""
    whole = {n for n, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint")}
    found = {r["column"]: r["mode"] for r in order.modes(df, cols, dtype=dtype).collect()}
    return {c: int(v) if c in whole and dtype == "double" else v for c, v in found.items()}


def fill(df: DataFrame, values: Mapping) -> DataFrame:
    """Replace NULL cells by the fitted or given constants."""
    kept = dict(df.dtypes)
    filled = {
        c: F.coalesce(F.col(c), F.lit(v)).cast("double" if isinstance(v, float) else kept[c])
        for c, v in values.items()
    }
    return df.withColumns(filled)


def fill_from_groups(df: DataFrame, by: Sequence[str], cols: Sequence[str], fallback: bool = True) -> DataFrame:
    """NULL -> median of the group -> median of the column.

    Group medians are computed by cuts (no group sits in one task) and joined back: as a
    broadcast if their measured size allows it, otherwise the adaptive skew join splits hot
    groups.
    """
    by = list(by)
    medians = (
        order.quantiles(df, cols, (0.5,), by)
        .groupBy(*by)
        .agg(*[F.max(F.when(F.col("column") == c, F.col("q0"))).alias(f"_{c}_median") for c in cols])
    )
    overall = fit_medians(df, cols) if fallback else {}
    joined = df.join(ship_if_short(medians), by, "left")
    out = joined.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"_{c}_median"), F.lit(overall.get(c)).cast("double")) for c in cols}
    )
    return out.select(*df.columns)


# ---------------------------------------------------------------- scalers

@dataclass(frozen=True)
class AffineModel:
    """x -> (x - shift) / scale per column."""

    params: Mapping[str, tuple[float, float]]

    def scaled(self, c: str) -> Column:
        shift, scale = self.params[c]
        return (F.col(c).cast("double") - F.lit(shift)) / F.lit(scale)

    def restored(self, c: str) -> Column:
        shift, scale = self.params[c]
        return F.col(c) * F.lit(scale) + F.lit(shift)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: self.scaled(c) for c in self.params})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.restored(c) for c in self.params})

    def point(self, values: Sequence[float]) -> list[float]:
        return [(v - s) / k for v, (s, k) in zip(values, self.params.values())]

    def restored_point(self, values: Sequence[float]) -> list[float]:
        return [v * k + s for v, (s, k) in zip(values, self.params.values())]


def _model(pairs: Mapping[str, tuple]) -> AffineModel:
    return AffineModel({
        c: (0.0 if s is None else float(s), float(k) if k else 1.0) for c, (s, k) in pairs.items()
    })


def fit_standard(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> AffineModel:
    """Zero mean, unit deviation; ``ddof`` 0 divides by n, 1 by n-1.  A constant column is only centred."""
    sd = F.stddev_samp if ddof else F.stddev_pop
    rows = stats_by_column(df, cols, {"m": F.avg, "s": sd}).collect()
    return _model({r["column"]: (r["m"], r["s"]) for r in rows})


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> AffineModel:
    """[0, 1]; a constant column maps to 0."""
    rows = stats_by_column(
        df, cols, {"lo": lambda c: F.min(c).cast("double"), "hi": lambda c: F.max(c).cast("double")}
    ).collect()
    return minmax_model({r["column"]: (r["lo"], r["hi"]) for r in rows})


def minmax_model(extremes: Mapping[str, tuple]) -> AffineModel:
    """The [0, 1] model of known (lowest, highest) values."""
    return _model({c: (lo, None if hi is None else hi - lo) for c, (lo, hi) in extremes.items()})


def fit_robust(df: DataFrame, cols: Sequence[str]) -> AffineModel:
    """(x - median) / IQR with exact quantiles."""
    q = order.fit_quantiles(df, cols, (0.25, 0.5, 0.75))
    return _model({c: (v[1], None if v[2] is None else v[2] - v[0]) for c, v in q.items()})


@dataclass(frozen=True)
class PreparationModel:
    """Column-wise preparation: continuous = median fill then robust scale, binary = mode fill."""

    medians: Mapping[str, float]
    scaler: AffineModel
    modes: Mapping[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scaler.transform(fill(fill(df, dict(self.medians)), dict(self.modes)))


def fit_preparation(df: DataFrame, continuous: Sequence[str], binary: Sequence[str]) -> PreparationModel:
    medians = fit_medians(df, continuous)
    scaler = fit_robust(fill(df, medians), continuous)
    return PreparationModel(medians, scaler, fit_modes(df, binary) if binary else {})


def log_if_skewed(df: DataFrame, cols: Sequence[str], limit: float = 1.0) -> tuple[DataFrame, dict[str, float]]:
    """Add ``<c>_log1p`` for every column with |skewness| above the limit; returns the skewness too."""
    row = df.agg(*[unbiased_skewness(c).alias(c) for c in cols]).first()
    skew = {c: row[c] for c in cols}
    new = {f"{c}_log1p": F.log1p(c) for c in cols if skew[c] is not None and abs(skew[c]) > limit}
    return (df.withColumns(new) if new else df), skew


# ---------------------------------------------------------------- outliers

@dataclass(frozen=True)
class Limits:
    """Lower and upper limit per column; None where the column has no spread."""

    bounds: Mapping[str, tuple[float, float] | None]

    def outside(self, c: str) -> Column:
        b = self.bounds[c]
        if b is None:
            return F.lit(False)
        return F.coalesce((F.col(c) < F.lit(b[0])) | (F.col(c) > F.lit(b[1])), F.lit(False))


def fit_iqr_limits(df: DataFrame, cols: Sequence[str], factor: float = IQR_FACTOR,
                   skip_flat: bool = True) -> Limits:
    bounds = {}
    for c, (q1, q3) in order.fit_quantiles(df, cols, (0.25, 0.75)).items():
        spread = None if q1 is None else q3 - q1
        if spread is None or (skip_flat and spread == 0):
            bounds[c] = None
        else:
            bounds[c] = (q1 - factor * spread, q3 + factor * spread)
    return Limits(bounds)


def iqr_report(df: DataFrame, cols: Sequence[str], factor: float = IQR_FACTOR, skip_flat: bool = False) -> DataFrame:
    """Limits and number of outliers per column; a column without spread counts what differs, or is skipped."""
    limits = fit_iqr_limits(df, cols, factor, skip_flat)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(b[0] if b else None).cast("double").alias("low"),
            F.lit(b[1] if b else None).cast("double").alias("high"),
            F.col(c).alias("outliers"),
        )
        for c, b in limits.bounds.items()
    ]
    counts = df.agg(*[F.count_if(limits.outside(c)).alias(c) for c in cols])
    return counts.select(F.inline(F.array(*rows)))


def iqr_filter(df: DataFrame, cols: Sequence[str], factor: float = IQR_FACTOR) -> DataFrame:
    """Keep a row if every column is inside its limits or missing."""
    limits = fit_iqr_limits(df, cols, factor)
    return df.where(~any_true([limits.outside(c) for c in cols]))


def winsorize(df: DataFrame, cols: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    q = order.fit_quantiles(df, cols, (low, high))
    return df.withColumns({c: clip(F.col(c).cast("double"), *q[c]) for c in cols if q[c][0] is not None})


def zscore_flags(df: DataFrame, cols: Sequence[str], limit: float = 3.0) -> DataFrame:
    """``<c>_out`` per column and ``any_out`` where |z| (deviation over n) exceeds the limit."""
    model = fit_standard(df, cols, ddof=0)
    flags = {f"{c}_out": F.coalesce(F.abs(model.scaled(c)) > limit, F.lit(False)).cast("int") for c in cols}
    return df.withColumns(flags).withColumn("any_out", F.greatest(*[F.col(f) for f in flags], F.lit(0)))


# ---------------------------------------------------------------- encoders

def fit_levels(df: DataFrame, cols: Sequence[str], limit: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted non-null levels per column; a column with too many levels is refused, never cut."""
    cells = [{"column": F.lit(c), "level": F.col(c).cast("string")} for c in cols]
    rows = (
        stack_cells(df, [], cells).where(F.col("level").isNotNull()).distinct()
        .limit(limit * len(cols) + 1).collect()
    )
    levels = {c: sorted(r["level"] for r in rows if r["column"] == c) for c in cols}
    for c, found in levels.items():
        if len(rows) > limit * len(cols) or len(found) > limit:
            raise ValueError(f"more than {limit} levels for columns; use hot_cells or bit_codes for {c}")
    return levels


def hot_cells(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One-hot encoding as rows (key, column, level) of the ones: any number of levels, nothing collected."""
    cells = [{"column": F.lit(c), "level": F.col(c).cast("string")} for c in cols]
    return stack_cells(df, [key], cells).where(F.col("level").isNotNull())


def hot_tokens(df: DataFrame, c: str, key: str, separator: str) -> DataFrame:
    """Multi-hot encoding of a multi-answer text as rows (key, token): any number of tokens."""
    tokens = F.array_distinct(F.transform(F.split(F.col(c), separator), lambda t: strip(t)))
    return df.select(key, F.explode(tokens).alias("token")).where("token != ''")


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]], drop_first: bool = False,
            keep_source: bool = False) -> DataFrame:
    """0/1 columns ``<c>_<level>``; NULL and unseen values give all zeros."""
    new = {
        f"{c}_{v}": F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0))
        for c, vs in levels.items()
        for v in (vs[1:] if drop_first else vs)
    }
    out = df.withColumns(new) if new else df
    return out if keep_source else out.drop(*levels)


def level_codes(df: DataFrame, c: str, out: str = "code") -> DataFrame:
    """Table (value, code) with codes in sorted order: no cap, no driver round trip of the values."""
    return order.dense_index(df.select(c).where(F.col(c).isNotNull()).distinct(), c, out)


def encode_levels(df: DataFrame, codes: DataFrame, c: str, out: str = "code", unknown: int | None = None) -> DataFrame:
    """Attach a fitted code table; values it lacks get ``unknown`` (NULL if not given)."""
    joined = df.join(ship_if_short(codes), c, "left")
    return joined if unknown is None else joined.withColumn(out, F.coalesce(F.col(out), F.lit(unknown)))


def bit_codes(df: DataFrame, c: str, key: str, out: str) -> tuple[DataFrame, int]:
    """Binary encoding: value codes in order of first appearance, then one column per bit (lowest first).

    Returns the encoded rows and the number of bits.
    """
    first = df.groupBy(c).agg(F.min(key).alias("_first"))
    codes = ship_if_short(order.dense_index(first, "_first", f"{out}_code").drop("_first"))
    n = codes.count()
    bits = max(1, math.ceil(math.log2(n))) if n > 1 else 1
    coded = df.join(codes, c)
    return coded.withColumns(
        {f"{out}_bin_{b}": F.shiftright(f"{out}_code", b).bitwiseAND(F.lit(1)).cast("int") for b in range(bits)}
    ), bits


def multi_hot(df: DataFrame, c: str, key: str, separator: str, prefix: str,
              limit: int = MAX_LEVELS) -> DataFrame:
    """0/1 column per token of a multi-answer text (the text is split, blanks are stripped)."""
    tokens = F.transform(F.split(F.col(c), separator), lambda t: strip(t))
    levels = fit_levels(df.select(F.explode(tokens).alias("token")).where("token != ''"), ["token"], limit)["token"]
    return df.select(key, *[
        F.coalesce(F.array_contains(tokens, v).cast("int"), F.lit(0)).alias(f"{prefix}{v}") for v in levels
    ])


def fold_rare(df: DataFrame, c: str, min_count: int, other: str = "Rare") -> DataFrame:
    """Replace values seen fewer than ``min_count`` times."""
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    rare = ship_if_short(counts.where(F.col("_n") < min_count))
    return df.join(rare, c, "left").withColumn(
        c, F.when(F.col("_n").isNotNull(), F.lit(other)).otherwise(F.col(c))
    ).select(*df.columns)


def drop_rare(df: DataFrame, c: str, min_count: int = 2) -> DataFrame:
    """Drop rows whose class is seen fewer than ``min_count`` times."""
    rare = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < min_count).select(c)
    return df.join(ship_if_short(rare), c, "left_anti")
