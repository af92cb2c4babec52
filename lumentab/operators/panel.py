"""Panels: returns per identifier, two-period rules, trends, weighted ranking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lumentab.functions.columns import cut
from lumentab.operators import order, prepare, profile
from lumentab.operators.ship import join_with_nulls, ship_if_short


def _time_cuts(df: DataFrame, time: str) -> DataFrame:
    """``_period``: the number of the cut along ``time``; rows without a time come first."""
    kind = df.schema[time].dataType
    at = F.col(time)
    if isinstance(kind, T.DateType):
        at = F.unix_date(at)
    elif not isinstance(kind, T.NumericType):
        at = F.unix_micros(at.cast("timestamp"))
    rows = df.withColumn("_at", at.cast("double"))
    cut = order.with_cut(rows, "_at", order.splitters(rows, ["_at"])["_at"], "_period")
    return cut.withColumn("_period", F.when(F.col("_at").isNull(), -1).otherwise(F.col("_period"))).drop("_at")


def previous_value(df: DataFrame, ids: Sequence[str], time: str, value: str, out: str,
                   ties: Sequence[str] = (), period: str = "month") -> DataFrame:
    """Value of the previous row of the same identifier in time order.

    The window runs inside (identifier, calendar period); the last value of each period is
    carried over on the short period table.  An identifier with a third of all rows is
    thereby spread over its periods.  Without identifiers the one series is cut at time
    quantiles instead, so no task gets a whole period, and a table of the cuts carries values on.
    """
    ids = list(ids)
    rows = df.withColumn("_period", F.date_trunc(period, time)) if ids else _time_cuts(df, time)
    inside = Window.partitionBy(*ids, "_period").orderBy(time, *ties)
    last = rows.groupBy(*ids, "_period").agg(
        F.max(F.struct(time, *ties, F.col(value).alias("_v")))["_v"].alias("_last")
    )
    along = Window.partitionBy(*(ids or [F.lit(0)])).orderBy("_period")
    carried = last.select(*ids, "_period", F.lag("_last").over(along).alias("_carried"))
    numbered = rows.withColumn("_row", F.row_number().over(inside)).withColumn("_prev", F.lag(value).over(inside))
    return (
        join_with_nulls(numbered, carried, [*ids, "_period"])
        .withColumn(out, F.when(F.col("_row") == 1, F.col("_carried")).otherwise(F.col("_prev")))
        .select(*df.columns, out)
    )


def with_returns(df: DataFrame, ids: Sequence[str], time: str, prices: Sequence[str],
                 ties: Sequence[str] = (), period: str = "month", impute_first: bool = True) -> DataFrame:
    """``<p>_ret = p / previous p - 1`` and ``<p>_logret = log1p(ret)``, 0 where there is no previous row."""
    if impute_first:
        df = prepare.fill(df, prepare.fit_medians(df, prices))
    for p in prices:
        df = previous_value(df, ids, time, p, f"_{p}_prev", ties, period)
        ret = F.col(p) / F.nullif(F.col(f"_{p}_prev"), F.lit(0.0)) - 1
        df = df.withColumns({
            f"{p}_ret": F.coalesce(ret, F.lit(0.0)),
            # log1p is NULL at -1 (a fall to zero), where the limit is minus infinity.
            f"{p}_logret": F.when(ret == -1, F.lit(float("-inf"))).otherwise(F.coalesce(F.log1p(ret), F.lit(0.0))),
        }).drop(f"_{p}_prev")
    return df


def two_period_rule(df: DataFrame, ids: Sequence[str], year: str, negative: str,
                    others: Sequence[Column] = (), out: str = "rule") -> DataFrame:
    """1 if a value is negative this year and the year before, or another condition holds."""
    w = Window.partitionBy(*ids).orderBy(year)  # one row per year: a short partition
    twice = (F.col(negative) < 0) & (F.lag(negative).over(w) < 0)
    conditions = [F.coalesce(c, F.lit(False)) for c in (twice, *others)]
    return df.withColumn(out, profile.any_true(conditions).cast("int"))


def slope_or_zero(y: str, x: str) -> Column:
    """Least-squares slope; 0 where fewer than two rows (or one distinct x) give none."""
    return F.coalesce(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")), F.lit(0.0))


# Limits and texts of the ranking verdict.
RISK_LIMIT, CRITICAL_LIMIT, MODERATE_LIMIT, TREND_LIMIT = 0.40, 0.35, 0.55, 0.005
VERDICTS = {
    "critical": "ECHAR — desempeño critico, sin mejora",
    "worsening": "ECHAR — en riesgo y empeorando",
    "improving": "ADVERTENCIA — en riesgo pero mejorando, dar seguimiento",
    "moderate": "SEGUIMIENTO — desempeño moderado",
    "healthy": "OK — desempeño saludable",
}
TREND_TEXTS = {"up": "↑ mejora", "down": "↓ empeora", "flat": "→ estable"}


@dataclass(frozen=True)
class Indicator:
    name: str
    weight: float
    higher_is_better: bool = True


def oriented(c: Column, higher_is_better: bool) -> Column:
    return c if higher_is_better else F.lit(1.0) - c


def score_rows(df: DataFrame, unit: str, indicators: Sequence[Indicator], impute: bool = True) -> DataFrame:
    """Group-median fill, min-max in the good direction, weighted sum as ``score``."""
    names = [i.name for i in indicators]
    filled = prepare.fill_from_groups(df, [unit], names, fallback=False) if impute else df
    # The overall median lies between the extremes, so one aggregate serves the scaling and
    # tells which columns still have gaps (a unit without any value).
    row = filled.agg(
        *[F.min(n).cast("double").alias(f"{n}|lo") for n in names],
        *[F.max(n).cast("double").alias(f"{n}|hi") for n in names],
        *[F.count_if(F.col(n).isNull()).alias(f"{n}|gaps") for n in names],
    ).first()
    gaps = [n for n in names if row[f"{n}|gaps"]]
    if impute and gaps:
        filled = prepare.fill(filled, prepare.fit_medians(filled, gaps))
    model = prepare.minmax_model({n: (row[f"{n}|lo"], row[f"{n}|hi"]) for n in names})
    out = filled.withColumns({
        f"{i.name}_norm": oriented(model.scaled(i.name), i.higher_is_better) for i in indicators
    })
    total = None
    for i in indicators:
        term = F.lit(i.weight) * F.col(f"{i.name}_norm")
        total = term if total is None else total + term
    return out.withColumn("score", total)


def rank_units(scored: DataFrame, unit: str, time: str, label: str) -> DataFrame:
    """Mean, sd, years, label shares and trend of the score per unit; rank 1 is the worst mean."""
    summary = scored.groupBy(unit).agg(
        F.avg("score").alias("score_mean"),
        F.stddev_samp("score").alias("score_std"),
        F.count(time).alias("n"),
        profile.share_pct(F.col(label) == 0).alias("label_0_pct"),
        profile.share_pct(F.col(label) == 1).alias("label_1_pct"),
        slope_or_zero("score", time).alias("trend"),
    )
    return order.dense_index(summary, "score_mean", "_idx", [unit]).withColumn(
        "ranking", F.col("_idx") + 1
    ).drop("_idx")


def trend_text(trend: Column) -> Column:
    return (
        F.when(trend > TREND_LIMIT, TREND_TEXTS["up"])
        .when(trend < -TREND_LIMIT, TREND_TEXTS["down"])
        .otherwise(TREND_TEXTS["flat"])
    )


def verdict(score: Column, trend: Column, limits: Mapping[str, float] | None = None) -> Column:
    at = {"critical": CRITICAL_LIMIT, "risk": RISK_LIMIT, "moderate": MODERATE_LIMIT, **(limits or {})}
    return (
        F.when(score < at["critical"], VERDICTS["critical"])
        .when((score < at["risk"]) & (trend < 0), VERDICTS["worsening"])
        .when(score < at["risk"], VERDICTS["improving"])
        .when(score < at["moderate"], VERDICTS["moderate"])
        .otherwise(VERDICTS["healthy"])
    )


def worst_unit_detail(df: DataFrame, ranking: DataFrame, unit: str, indicators: Sequence[Indicator],
                      worst: int = 3) -> DataFrame:
    """Indicator means of the worst units against the overall mean, flagged by direction."""
    names = [i.name for i in indicators]
    overall = prepare.fit_means(df, names)
    chosen = ranking.where(F.col("ranking") <= worst).select(unit)
    means = df.join(ship_if_short(chosen), unit).groupBy(unit).agg(*[F.avg(n).alias(n) for n in names])
    rows = [
        F.struct(
            F.lit(i.name).alias("indicator"),
            F.col(i.name).alias("unit_mean"),
            F.lit(overall[i.name]).alias("overall_mean"),
            (F.col(i.name) < F.lit(overall[i.name]) if i.higher_is_better
             else F.col(i.name) > F.lit(overall[i.name])).cast("int").alias("flagged"),
        )
        for i in indicators
    ]
    return means.select(unit, F.inline(F.array(*rows)))


def heat_table(df: DataFrame, unit: str, indicators: Sequence[Indicator]) -> DataFrame:
    """Unit means, min-max scaled across units in the good direction."""
    means = df.groupBy(unit).agg(*[F.avg(i.name).alias(i.name) for i in indicators])
    model = prepare.fit_minmax(means, [i.name for i in indicators])
    return means.select(
        unit, *[oriented(model.scaled(i.name), i.higher_is_better).alias(i.name) for i in indicators]
    )
