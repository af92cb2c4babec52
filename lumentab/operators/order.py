"""Order statistics without a one-task sort: running totals, ranks, exact quantiles.

A running sum over a whole table is an unpartitioned window, that is one task.  Here
the value axis is first cut at a few hundred splitters.  Totals per cut are a small
table whose running sum is cheap; inside a cut the window is partitioned by
(group, cut).  Splitters only balance the work: the result is exact for any splitters,
and a group that holds a third of all rows is still spread over many cuts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from lumentab.operators.reshape import name_of, stack_cells
from lumentab.operators.ship import SHIP_ROWS, ship_if_short
from lumentab.session import shuffle_width

CUT = "_cut"
# Cuts, at least; one window task gets about CUT_ROWS rows of a larger table.
MIN_CUTS, CUT_ROWS = 64, 2_000_000
# So few values fit in the buffer of one aggregate; larger tables are cut.
SMALL_ROWS = 100_000
SAMPLE_STEP = 16


def _cuts(df: DataFrame, rows: int = 0) -> int:
    return max(MIN_CUTS, 4 * shuffle_width(df.sparkSession), -(-rows // CUT_ROWS))


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def splitters(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Roughly equal-depth cut points per column; one bounded sketch for all numbers.

    The sketch reads one row in sixteen: cut points only have to spread the values, they
    never decide a result.  A table whose sample shows at most ``SMALL_ROWS`` values needs
    no cuts and gets none.
    """
    n = _cuts(df)
    found: dict[str, list] = {}
    numbers = [c for c in cols if _is_number(df, c)]
    if numbers:
        def sketch(cuts: int) -> Row:
            probs = [i / cuts for i in range(1, cuts)]
            return df.sample(1 / SAMPLE_STEP, seed=7).agg(
                F.count(F.lit(1)).alias("|n"),
                *[F.percentile_approx(F.col(c).cast("double"), probs, 8 * cuts).alias(c) for c in numbers],
            ).first()

        row = sketch(n)
        if _cuts(df, row["|n"] * SAMPLE_STEP) > n:  # a table so large gets more cuts
            row = sketch(_cuts(df, row["|n"] * SAMPLE_STEP))
        small = row["|n"] * SAMPLE_STEP * len(numbers) <= SMALL_ROWS
        found.update({c: [] if small else sorted(set(row[c] or [])) for c in numbers})
    for c in cols:
        if c not in found:  # texts: the values with the smallest hashes are a uniform sample
            sample = (
                df.select(c).where(F.col(c).isNotNull()).distinct()
                .orderBy(F.xxhash64(c)).limit(4 * n).collect()
            )
            values = sorted(r[0] for r in sample)
            # A sample that is the whole set cuts at every value.
            found[c] = values if len(values) < 4 * n else sorted(set(values[i * len(values) // n] for i in range(1, n)))
    return found


def with_cut(df: DataFrame, name: str, points: Sequence, out: str = CUT) -> DataFrame:
    """Add the number of the cut that holds the value (order preserving)."""
    if not points:
        return df.withColumn(out, F.lit(0))
    if isinstance(points[0], str):
        steps, width = [], 1
        while width * 2 <= len(points):
            width *= 2
        while width:
            steps.append(width)
            width //= 2
        table = F.lit(list(points))
        return df.withColumn(
            out,
            F.aggregate(
                F.lit(steps),
                F.lit(0),
                lambda at, step: F.when(
                    (at + step <= len(points)) & (F.get(table, at + step - 1) <= F.col(name)), at + step
                ).otherwise(at),
            ),
        )
    return _with_number_cuts(df, {name: points}, [out])


def _with_number_cuts(df: DataFrame, points: Mapping[str, Sequence[float]], outs: Sequence[str]) -> DataFrame:
    """Cut numbers of several numeric columns by one binary-search transformer."""
    raw = [f"_value{i}" for i in range(len(outs))]
    wide = df.select("*", *[F.col(c).cast("double").alias(r) for c, r in zip(points, raw)])
    cutter = Bucketizer(
        # The transformer wants an inner cut point; for a column without values any will do.
        splitsArray=[[float("-inf"), *(p or [0.0]), float("inf")] for p in points.values()],
        inputCols=raw, outputCols=list(outs), handleInvalid="keep",
    )
    cut = cutter.transform(wide)
    return cut.select(*df.columns, *[F.col(o).cast("int").alias(o) for o in outs])


def running_totals(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
    points: Sequence | None = None,
) -> DataFrame:
    """One row per (group, distinct value) with each sum ``m``, ``m_before`` and ``m_total``.

    ``m_before`` adds up the rows that come strictly earlier in value order.
    """
    by = list(by)
    points = splitters(df, [value])[value] if points is None else points
    if not points:
        return _running_totals_whole(df, value, sums, by, descending)
    cells = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        *[e.alias(m) for m, e in sums.items()]
    )
    cells = with_cut(cells, value, points)
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    group = by or [F.lit(0)]
    over_cuts = Window.partitionBy(*group).orderBy(direction(CUT)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        cells.groupBy(*by, CUT)
        .agg(*[F.sum(m).alias(m) for m in sums])
        .select(
            *by,
            CUT,
            *[F.coalesce(F.sum(m).over(over_cuts), F.lit(0)).alias(f"_{m}_offset") for m in sums],
            *[F.sum(m).over(Window.partitionBy(*group)).alias(f"{m}_total") for m in sums],
        )
    )
    inside = Window.partitionBy(*by, CUT).orderBy(direction(value)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        cells.select("*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_{m}_in") for m in sums])
        .join(offsets, [*by, CUT])
        .select(
            *by,
            value,
            *sums,
            *[(F.col(f"_{m}_offset") + F.col(f"_{m}_in")).alias(f"{m}_before") for m in sums],
            *[f"{m}_total" for m in sums],
        )
    )


def _running_totals_whole(df: DataFrame, value: str, sums: Mapping[str, Column], by: list[str],
                          descending: bool) -> DataFrame:
    """The same over a table known to be small: one window per group, no cuts."""
    cells = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(*[e.alias(m) for m, e in sums.items()])
    group = Window.partitionBy(*(by or [F.lit(0)]))
    before = group.orderBy(F.col(value).desc() if descending else F.col(value).asc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return cells.select(
        *by, value, *sums,
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}_before") for m in sums],
        *[F.sum(m).over(group).alias(f"{m}_total") for m in sums],
    )


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = (),
                  points: Sequence | None = None) -> DataFrame:
    """Rank of every distinct value, 1-based, ties sharing the mean rank."""
    return running_totals(df, value, {"n": F.count(F.lit(1))}, by, points=points).withColumn(
        "rank", F.col("n_before") + (F.col("n") + 1) / 2.0
    )


def dense_index(df: DataFrame, key: str, out: str = "idx", ties: Sequence[str] = ()) -> DataFrame:
    """0-based position of every row in ascending order of ``key``, then of the ``ties`` columns."""
    points = splitters(df, [key])[key]
    if not points:
        whole = Window.partitionBy(F.lit(0)).orderBy(key, *ties)
        return df.withColumn(out, (F.row_number().over(whole) - 1).cast("long"))
    cells = with_cut(df, key, points)
    before = Window.orderBy(CUT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cells.groupBy(CUT).agg(F.count(F.lit(1)).alias("_n"))
        .select(CUT, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(CUT).orderBy(key, *ties)
    return (
        cells.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets), CUT)  # one row per cut
        .withColumn(out, (F.col("_offset") + F.col("_row") - 1).cast("long"))
        .drop(CUT, "_row", "_offset")
    )


def rows_at(df: DataFrame, key: str, positions_of: Callable[[int], Sequence[int]]) -> DataFrame:
    """Rows at the given 0-based positions in ascending order of ``key`` (unique).

    ``positions_of`` gets the number of rows.  Counts per cut (a few thousand numbers) locate
    the positions; only the cuts that hold one are shuffled and ordered.
    """
    cells = with_cut(df, key, splitters(df, [key])[key])
    counts = sorted((r[CUT], r["n"]) for r in cells.groupBy(CUT).agg(F.count(F.lit(1)).alias("n")).collect())
    wanted = sorted(set(positions_of(sum(n for _, n in counts))))
    found, start, i = [], 0, 0
    for cut, n in counts:
        while i < len(wanted) and wanted[i] < start + n:
            found.append((cut, wanted[i] - start + 1))
            i += 1
        start += n
    places = df.sparkSession.createDataFrame(found, f"{CUT} int, _row int")
    if len(found) <= SHIP_ROWS:
        places = F.broadcast(places)
    held = cells.where(F.col(CUT).isin(sorted({c for c, _ in found})))
    ranked = held.withColumn("_row", F.row_number().over(Window.partitionBy(CUT).orderBy(key)))
    return ranked.join(places, [CUT, "_row"]).select(*df.columns)


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str], points: Mapping[str, Sequence]) -> DataFrame:
    """Rows (group, column number, value, cut) for several numeric columns of one scan."""
    wide = df.select(*by, *[c for c in cols if c not in by])
    wide = _with_number_cuts(wide, {c: points[c] for c in cols}, [f"_cut{i}" for i in range(len(cols))])
    return stack_cells(wide, by, [
        {"column": F.lit(i), "value": F.col(c).cast("double"), CUT: F.col(f"_cut{i}")} for i, c in enumerate(cols)
    ]).where(F.col("value").isNotNull())


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per (group, column), ``q0``, ``q1`` ... and ``n``.

    Counts per cut tell which cuts hold a wanted position; only the values of those cuts
    are shuffled and ordered, so the sort touches a small share of the table.
    """
    by = list(by)
    points = splitters(df, cols)
    if not any(points.values()):
        return _quantiles_whole(df, cols, probs, by)
    long = _long(df, cols, by, points)
    per_cut = Window.partitionBy(*by, "column").orderBy(CUT)
    counts = (
        long.groupBy(*by, "column", CUT).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(
            F.sum("_n").over(per_cut.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("n", F.sum("_n").over(Window.partitionBy(*by, "column")))
    )

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("n") - 1)

    def holds(index: Column, start: Column, size: Column) -> Column:
        return (index >= start) & (index < start + size)

    wanted = [f(position(p)) for p in probs for f in (F.floor, F.ceil)]
    hit = wanted and [holds(w, F.col("_before"), F.col("_n")) for w in wanted]
    any_hit = hit[0]
    for h in hit[1:]:
        any_hit = any_hit | h
    needed = ship_if_short(counts.where(any_hit).select(*by, "column", CUT, "_before", "n"))
    cells = (
        long.join(needed, [*by, "column", CUT])
        .groupBy(*by, "column", CUT, "_before", "n", "value").agg(F.count(F.lit(1)).alias("_size"))
    )
    inside = Window.partitionBy(*by, "column", CUT).orderBy("value").rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.col("_start")
    cells = cells.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    picked = cells.groupBy(*by, "column").agg(
        F.max("n").alias("n"),
        *[
            F.max(F.when(holds(f(position(p)), start, F.col("_size")), F.col("value"))).alias(f"_{side}{i}")
            for i, p in enumerate(probs)
            for side, f in (("lo", F.floor), ("hi", F.ceil))
        ],
    )
    return picked.select(
        *by,
        name_of("column", cols).alias("column"),
        "n",
        *[
            (
                F.col(f"_lo{i}")
                + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (position(p) - F.floor(position(p)))
            ).alias(f"q{i}")
            for i, p in enumerate(probs)
        ],
    )


def _quantiles_whole(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: list[str]) -> DataFrame:
    """The same over a table known to be small: the built-in exact percentile in one aggregate."""
    wide = df.groupBy(*by).agg(
        *[F.percentile(F.col(c).cast("double"), list(probs)).alias(f"{c}|q") for c in cols],
        *[F.count(c).alias(f"{c}|n") for c in cols],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}|n`").alias("n"),
                 *[F.get(F.col(f"`{c}|q`"), F.lit(i)).alias(f"q{i}") for i in range(len(probs))])
        for c in cols
    ]
    return wide.select(*by, F.inline(F.array(*rows))).where("n > 0")


def fit_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Quantiles of whole columns as numbers; one short row per column reaches the driver."""
    rows = {r["column"]: [r[f"q{i}"] for i in range(len(probs))] for r in quantiles(df, cols, probs).collect()}
    return {c: rows.get(c, [None] * len(probs)) for c in cols}


def modes(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), dtype: str = "double") -> DataFrame:
    """Most frequent value per (group, column), smallest value on ties: rows (group, column, mode).

    Counts are taken per (group, column, value) first, so no task ever holds a whole group.
    """
    by = list(by)
    cells = [{"column": F.lit(i), "value": F.col(c).cast(dtype)} for i, c in enumerate(cols)]
    return (
        stack_cells(df, by, cells).where(F.col("value").isNotNull())
        .groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*by, "column")
        .agg(F.min_by("value", F.struct(-F.col("_n"), F.col("value"))).alias("mode"))
        .withColumn("column", name_of("column", cols))
    )
