"""Distance joins on a grid: neighbours within a radius, k-th neighbour, nearest centre.

``distance <= eps`` is turned into an equi-join on grid cells.  Copies of a point collapse
to one weighted site first, and a cell with very many sites is salted, so neither a group
of copies nor one dense cell can fill a single task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumentab.functions.columns import squared_distance_to
from lumentab.operators.ship import SHIP_ROWS
from lumentab.session import cut_lineage

# A cell with more sites than this is split over several tasks.
HOT_CELL = 20_000


# Dimensions in which neighbours are counted by strips; labels that are counted side by side.
PLANE, COUNTED_LABELS = 2, 64
# Axes that make cells: a query looks at (2 * reach + 1) ** GRID_AXES cells at most, however many
# dimensions the distance has.  The other dimensions only take part in the exact filter.
GRID_AXES = 3


def cell_names(dims: Sequence[str]) -> list[str]:
    return [f"_g{i}" for i in range(min(len(dims), GRID_AXES))]


def widest(df: DataFrame, dims: Sequence[str]) -> list[str]:
    """The dimensions, those that spread most first where not all of them make cells."""
    if len(dims) <= GRID_AXES:
        return list(dims)
    spread = df.agg(*[F.stddev_pop(F.col(d).cast("double")).alias(d) for d in dims]).first()
    return sorted(dims, key=lambda d: -(spread[d] or 0.0))


def on_grid(df: DataFrame, dims: Sequence[str], side: float) -> DataFrame:
    return df.withColumns({
        g: F.floor(F.col(d).cast("double") / F.lit(side)).cast("long") for g, d in zip(cell_names(dims), dims)
    })


def sites_of(df: DataFrame, dims: Sequence[str], side: float, aggs: Sequence[Column]) -> DataFrame:
    """One row per distinct point with its cell and the given aggregates (for example a weight)."""
    points = df.withColumns({d: F.col(d).cast("double") for d in dims})
    points = points.where(reduce(lambda a, b: a & b, [F.col(d).isNotNull() for d in dims]))
    return on_grid(points, dims, side).groupBy(*cell_names(dims), *dims).agg(*aggs)


def gap_squared(dims: Sequence[str], left: str = "_q_", right: str = "") -> Column:
    return reduce(
        lambda a, b: a + b,
        [(F.col(left + d) - F.col(right + d)) * (F.col(left + d) - F.col(right + d)) for d in dims],
    )


def hot_cells(sites: DataFrame, dims: Sequence[str]) -> DataFrame | None:
    """Cells with more than ``HOT_CELL`` sites and the number of tasks each is dealt to; None if there are none."""
    cells = cell_names(dims)
    hot = (
        sites.groupBy(*cells).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_CELL)
        .select(*cells, F.ceil(F.col("_n") / HOT_CELL).cast("int").alias("_salts"))
    )
    head = hot.limit(SHIP_ROWS + 1).collect()
    if not head:
        return None
    if len(head) <= SHIP_ROWS:  # size checked
        return F.broadcast(sites.sparkSession.createDataFrame(head, hot.schema))
    return hot


def cell_join(queries: DataFrame, sites: DataFrame, dims: Sequence[str], reach: int,
              hot: DataFrame | None = None) -> DataFrame:
    """Every query with the sites of the cells at most ``reach`` steps away.

    Query columns come back with the prefix ``_q_``.  Hot cells are salted: their sites are
    dealt to several join keys and the queries that look at them are repeated per key.
    """
    cells = cell_names(dims)
    steps = F.array(*[
        F.struct(*[F.lit(o).cast("long").alias(f"o{i}") for i, o in enumerate(offset)])
        for offset in product(range(-reach, reach + 1), repeat=len(cells))
    ])
    asked = (
        queries.select(*[F.col(c).alias(f"_q_{c}") for c in queries.columns], F.explode(steps).alias("_step"))
        .withColumns({g: F.col(f"_q_{g}") + F.col(f"_step.o{i}") for i, g in enumerate(cells)})
        .drop("_step")
    )
    keys = list(cells)
    if hot is not None:
        one = F.coalesce("_salts", F.lit(1))
        asked = asked.join(hot, cells, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("_salts")
        sites = sites.join(hot, cells, "left").withColumn(
            "_salt", F.pmod(F.xxhash64(*dims), one).cast("int")).drop("_salts")
        keys.append("_salt")
    # The repeated queries stream past a hash table of the sites of one shuffle partition: they are
    # many times the sites, and sorting them for a merge join would cost more than the join itself.
    return asked.join(sites.hint("shuffle_hash"), keys).drop("_salt")


def _site_keys(dims: Sequence[str]) -> list[str]:
    return [f"_q_{d}" for d in dims]


def neighbour_counts(df: DataFrame, dims: Sequence[str], eps: float) -> DataFrame:
    """Distinct points with their copies and the rows within ``eps`` (the point itself included).

    Rows with a NULL coordinate have no distance and are no point.
    """
    if len(dims) == PLANE:
        from lumentab.operators.strips import ball_sums

        return ball_sums(df.select(*dims), dims, eps, [F.count(F.lit(1))]).select(*dims, "copies", F.get("votes", F.lit(0)).alias("neighbours"))
    dims = widest(df, dims)
    sites = sites_of(df, dims, eps, [F.count(F.lit(1)).alias("copies")])
    near = cell_join(sites, sites, dims, 1, hot_cells(sites, dims)).where(gap_squared(dims) <= F.lit(eps * eps))
    return near.groupBy(*_site_keys(dims)).agg(
        F.max("_q_copies").alias("copies"), F.sum("copies").alias("neighbours")
    ).withColumnsRenamed({f"_q_{d}": d for d in dims})


def with_neighbour_counts(df: DataFrame, dims: Sequence[str], eps: float) -> DataFrame:
    return df.join(neighbour_counts(df, dims, eps).drop("copies"), list(dims), "left")


def neighbour_pairs(df: DataFrame, key: str, dims: Sequence[str], eps: float) -> DataFrame:
    """The join itself: pairs (key, other, distance) of different rows, each pair once."""
    dims = widest(df, dims)
    points = on_grid(df.select(key, *[F.col(d).cast("double").alias(d) for d in dims]), dims, eps)
    near = cell_join(points, points, dims, 1, hot_cells(points, dims)).where(
        (F.col(f"_q_{key}") < F.col(key)) & (gap_squared(dims) <= F.lit(eps * eps))
    )
    return near.select(
        F.col(f"_q_{key}").alias("key"), F.col(key).alias("other"), F.sqrt(gap_squared(dims)).alias("distance")
    )


def kth_distance(df: DataFrame, dims: Sequence[str], k: int) -> DataFrame:
    """Distinct points with their copies and the distance to the k-th other row.

    The search radius starts at the spacing of the densest cell and doubles; a point leaves
    as soon as its ball holds k other rows, so dense regions never see a large ball.  Rows with
    a NULL coordinate are no point.
    """
    dims = widest(df, dims)
    df = df.dropna(subset=list(dims))
    d = len(dims)
    spread = df.agg(*[F.min(x).cast("double").alias(f"lo{i}") for i, x in enumerate(dims)],
                    *[F.max(x).cast("double").alias(f"hi{i}") for i, x in enumerate(dims)],
                    F.count(F.lit(1)).alias("n")).first()
    widths = [spread[f"hi{i}"] - spread[f"lo{i}"] for i in range(d)]
    extent = max(math.sqrt(sum(w * w for w in widths)), 1e-12)
    typical = max((k + 1) / max(spread["n"], 1), 1e-12) ** (1 / d) * extent
    sites = cut_lineage(sites_of(df, dims, typical, [F.count(F.lit(1)).alias("copies")]).drop(*cell_names(dims)))
    densest = on_grid(sites, dims, typical).groupBy(*cell_names(dims)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    radius = typical * min(1.0, ((k + 1) / max(densest, 1)) ** (1 / d))
    pending, done = sites, None
    enough = spread["n"] > k
    while enough:
        gridded = on_grid(sites, dims, radius)
        near = cell_join(on_grid(pending, dims, radius), gridded, dims, 1, hot_cells(gridded, dims)).where(
            gap_squared(dims) <= F.lit(radius * radius)
        ).withColumn("_gap", gap_squared(dims))
        # The k + 1 nearest sites hold the k-th other row: each task sends no more than these of a point.
        outward = Window.partitionBy(*_site_keys(dims)).orderBy("_gap")
        within = outward.rangeBetween(Window.unboundedPreceding, 0)
        found = cut_lineage(
            near.select(*_site_keys(dims), "_q_copies", "copies", "_gap").withColumn("_rank", F.row_number().over(outward))
            .where(F.col("_rank") <= k + 1).withColumn("_within", F.sum("copies").over(within)).where(F.col("_within") > k)
            .groupBy(*_site_keys(dims)).agg(F.max("_q_copies").alias("copies"), F.sqrt(F.min("_gap")).alias("kth"))
            .withColumnsRenamed({f"_q_{x}": x for x in dims})
        )
        done = found if done is None else done.unionByName(found)
        pending = cut_lineage(pending.join(found, list(dims), "left_anti"))
        if pending.isEmpty():
            break
        radius *= 2
    return done if done is not None else sites.withColumn("kth", F.lit(None).cast("double"))


def nearest_centre(vector: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Struct (cluster, d2) of the closest centre, lowest number on ties; no shuffle.

    ``vector`` is an array column; the centres are a short list of numbers.
    """
    from lumentab.functions.columns import squared_distance

    gaps = [
        F.struct(squared_distance(vector, F.lit([float(v) for v in c])).alias("d2"), F.lit(i).alias("cluster"))
        for i, c in enumerate(centres)
    ]
    return F.array_min(F.array(*gaps))


def _plane_labels(df: DataFrame, dims: Sequence[str], label: str, eps: float, labels: Sequence) -> DataFrame:
    """``neighbour_labels`` in the plane, from the counts of each of the ascending ``labels``."""
    from lumentab.operators.strips import ball_sums

    if not labels:
        return df.select(*[F.col(d).cast("double").alias(d) for d in dims], F.col(label).alias("majority")).limit(0)
    kind = df.schema[label].dataType
    names = F.array(*[F.lit(v).cast(kind) for v in labels])
    votes = [F.count_if(F.col("_label").eqNullSafe(F.lit(v).cast(kind))) for v in labels]
    found = ball_sums(df.select(*dims, F.col(label).alias("_label")), dims, eps, votes, apart=True)
    most = F.array_max("votes")
    return found.where(most > 0).select(*dims, F.get(names, F.array_position("votes", most).cast("int") - 1).alias("majority"))


def neighbour_labels(df: DataFrame, dims: Sequence[str], label: str, eps: float) -> DataFrame:
    """Distinct points with the majority label of the rows at distance 0 < d <= eps (smallest label on ties)."""
    if len(dims) == PLANE:
        labels = [r[0] for r in df.select(label).distinct().orderBy(label).limit(COUNTED_LABELS + 1).collect()]
        if len(labels) <= COUNTED_LABELS:
            return _plane_labels(df, dims, label, eps, labels)
    dims = widest(df, dims)
    sites = sites_of(df, dims, eps, [F.count(F.lit(1)).alias("n")])
    points = df.withColumns({d: F.col(d).cast("double") for d in dims})
    voters = on_grid(points, dims, eps).groupBy(*cell_names(dims), *dims, F.col(label).alias("_label")).agg(
        F.count(F.lit(1)).alias("_votes")
    )
    gap = gap_squared(dims)
    return (
        cell_join(sites, voters, dims, 1, hot_cells(voters, dims)).where((gap <= F.lit(eps * eps)) & (gap > 0))
        .groupBy(*_site_keys(dims), "_label").agg(F.sum("_votes").alias("_votes"))
        .groupBy(*_site_keys(dims))
        .agg(F.min_by("_label", F.struct(-F.col("_votes"), F.col("_label"))).alias("majority"))
        .withColumnsRenamed({f"_q_{d}": d for d in dims})
    )


# The three outcomes of the neighbourhood check.
CONSISTENT, SUSPICIOUS, ALONE = "consistente", "sospechoso", "sin_vecinos"


def check_labels(df: DataFrame, dims: Sequence[str], label: str, eps: float) -> DataFrame:
    """Rows with ``status``: does the label agree with the majority of the neighbours?"""
    points = df.withColumns({d: F.col(d).cast("double") for d in dims})
    checked = points.join(neighbour_labels(df, dims, label, eps), list(dims), "left")
    return checked.withColumn(
        "status",
        F.when(F.col("majority").isNull(), ALONE).when(F.col("majority") == F.col(label), CONSISTENT).otherwise(SUSPICIOUS),
    )


def check_summary(checked: DataFrame, label: str) -> DataFrame:
    """Counts and percentages of each status per label."""
    return checked.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("status") == s).alias(n) for n, s in
          (("consistent", CONSISTENT), ("suspicious", SUSPICIOUS), ("alone", ALONE))],
    ).withColumns({f"{n}_pct": F.col(n) * 100.0 / F.col("n") for n in ("consistent", "suspicious", "alone")})
