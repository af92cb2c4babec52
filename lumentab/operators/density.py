"""Density clustering on a grid: exact DBSCAN as joins over cells, in up to three dimensions.

Cells have the side eps / sqrt(d), so all points of a cell are neighbours.  A cell with
``min_pts`` rows is all core without looking at a single pair; only points of poorer cells
(fewer than ``min_pts`` each) count their neighbours.  Clusters are components of the graph
of core *cells*.  The work is therefore linear in the points for fixed ``min_pts``.  More
dimensions take a spanning forest of mutual reachability instead, from lists of nearest sites and
the few edges that these may miss (``blocks``); one forest serves all radii up to its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lumentab.operators import blocks
from lumentab.operators.distance import GRID_AXES, cell_join, cell_names, gap_squared, hot_cells, on_grid, sites_of, widest
from lumentab.operators.ship import ship_if_short
from lumentab.session import cut_lineage, ship_code

NOISE = -1
# Sub-cells per side of a cell in the adjacency test.
FINE = 4


# Edges of a node above which they stay where they are and the node's smallest neighbour is shipped to them.
HUB_EDGES = 10_000


def _with_lowest(edges: DataFrame, lowest: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``m`` of their u, from rows (u, m, n) with n edges each; hubs are few, so their rows are short."""
    hubs = ship_if_short(lowest.where(F.col("n") > HUB_EDGES).select("u", "m"))
    rest = lowest.where(F.col("n") <= HUB_EDGES).select("u", "m")
    return edges.join(hubs, "u").unionByName(edges.join(hubs, "u", "left_anti").join(rest, "u"))


def _star_round(star: DataFrame, hubs: bool) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v; ``hubs`` tells whether some node has very many."""
    both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
    count = F.count(F.lit(1)).alias("n")
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), count)
    met = _with_lowest(both, cut_lineage(low)) if hubs else both.join(low.drop("n"), "u")
    large = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if hubs:
        large = cut_lineage(large)
    low = large.groupBy("u").agg(F.min("v").alias("m"), count)
    met = _with_lowest(large, cut_lineage(low)) if hubs else large.join(low.drop("n"), "u")
    return (
        met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
    )


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, by alternating large-star and small-star.

    ``nodes`` has the column ``node``; ``edges`` has ``a`` and ``b``.  Each round is two
    aggregates and two joins; the lineage is cut after every round (a round reads its input twice).
    A node with more than ``HUB_EDGES`` edges does not gather them in one task.
    """
    star = cut_lineage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    mark = None
    while True:
        # Edges of a component end at its smallest node: the largest count tells of hubs, the sums of a change.
        by_end = star.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
        total, most, change = by_end.agg(F.sum("n"), F.max("n"), F.bit_xor("x")).first()
        if mark == (total, change):
            break
        mark = (total, change)
        star = cut_lineage(_star_round(star, (most or 0) > HUB_EDGES))
    return nodes.join(star.withColumnsRenamed({"u": "node", "v": "component"}), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _box_gap(dims: Sequence[str], far: bool) -> Column:
    """Squared smallest (or largest) possible distance between two boxes."""
    parts = []
    for d in dims:
        if far:
            gap = F.greatest(F.col(f"{d}_hi") - F.col(f"_q_{d}_lo"), F.col(f"_q_{d}_hi") - F.col(f"{d}_lo"))
        else:
            gap = F.greatest(F.col(f"{d}_lo") - F.col(f"_q_{d}_hi"), F.col(f"_q_{d}_lo") - F.col(f"{d}_hi"), F.lit(0.0))
        parts.append(gap * gap)
    return reduce(lambda a, b: a + b, parts)


def _cell_edges(core: DataFrame, dims: Sequence[str], eps: float, reach: int) -> DataFrame:
    """Pairs (a, b) of core cells with two core points at most eps apart.

    Boxes around the points of sub-cells settle nearly all pairs: two boxes are surely near
    or surely apart.  Points are compared only for cell pairs that no box pair connects.
    """
    cells, limit = cell_names(dims), F.lit(eps * eps)
    fine = [f"_f{i}" for i in range(len(dims))]
    side = eps / math.sqrt(len(dims)) / FINE
    core = core.withColumns({f: F.floor(F.col(d) / F.lit(side)).cast("long") for f, d in zip(fine, dims)})
    boxes = core.groupBy(*cells, "node", *fine).agg(
        *[F.min(d).alias(f"{d}_lo") for d in dims], *[F.max(d).alias(f"{d}_hi") for d in dims])

    def near(some: DataFrame) -> DataFrame:
        """Box pairs of different cells that may hold two near points."""
        return (
            cell_join(some, some, dims, reach).where(F.col("_q_node") < F.col("node"))
            .where(_box_gap(dims, far=False) <= limit)
            .withColumnsRenamed({"_q_node": "a", "node": "b"})
        )

    verdict = cut_lineage(
        near(boxes).groupBy("a", "b").agg(F.max(_box_gap(dims, far=True) <= limit).alias("sure")))
    sure, unsure = verdict.where("sure").select("a", "b"), verdict.where("not sure").select("a", "b")
    if unsure.isEmpty():
        return sure
    ends = unsure.select(F.col("a").alias("node")).unionByName(unsure.select(F.col("b").alias("node"))).distinct()
    left = core.select(F.col("node").alias("a"), *[F.col(f).alias(f"_q_{f}") for f in fine],
                       *[F.col(d).alias(f"_q_{d}") for d in dims])
    right = core.select(F.col("node").alias("b"), *fine, *dims)
    open_boxes = near(boxes.join(ends, "node", "left_semi")).join(unsure, ["a", "b"]).select("a", "b", *[f"_q_{f}" for f in fine], *fine)
    tested = (
        open_boxes.join(left, ["a", *[f"_q_{f}" for f in fine]]).join(right, ["b", *fine])
        .where(gap_squared(dims) <= limit).select("a", "b").distinct()
    )
    return sure.unionByName(tested)


def dbscan(df: DataFrame, key: str, dims: Sequence[str], eps: float, min_pts: int) -> DataFrame:
    """Rows (key, cluster, is_core).  ``cluster`` is the smallest core key of the cluster, -1 for noise.

    The neighbourhood counts the point itself.  A border point that touches several clusters
    joins the one with the smallest key, so the result does not depend on row order.  A row with
    a NULL coordinate has no neighbours: it is noise.
    """
    whole, apart = _with_coordinates(df, key, dims)
    return (_dbscan_cells if len(dims) <= GRID_AXES else _dbscan_pairs)(whole, key, dims, eps, min_pts).unionByName(apart)


def _with_coordinates(df: DataFrame, key: str, dims: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with all coordinates; and the others as noise."""
    lost = reduce(lambda a, b: a | b, [F.col(d).isNull() for d in dims])
    noise = F.lit(NOISE).cast(df.schema[key].dataType)
    return df.where(~lost), df.where(lost).select(key, noise.alias("cluster"), F.lit(False).alias("is_core"))


@dataclass(frozen=True)
class Reachability:
    """What every radius up to ``radius`` needs: sites (dims, w, k, core2) and a spanning forest (a, b, far2).

    ``core2`` is the squared distance at which a site becomes core (NULL beyond the radius).  ``far2`` of an edge is
    the squared mutual reachability of its ends: the radius at which both are core and near.  The forest has least
    weights, so at any radius its edges up to there connect the same core points as all near pairs do.
    """

    points: DataFrame
    key: str
    dims: list[str]
    radius: float
    sites: DataFrame
    forest: DataFrame
    planes: blocks.Planes

    def clusters(self, eps: float) -> DataFrame:
        """Rows (key, cluster, is_core) of DBSCAN at a radius up to ``radius``."""
        dims, limit = self.dims, F.lit(eps * eps)
        core = self.sites.where(F.col("core2") <= limit)
        parts = connected_components(
            core.select(F.col("k").alias("node")), self.forest.where(F.col("far2") <= limit).select("a", "b"))
        named = cut_lineage(core.join(parts, F.col("k") == F.col("node")).select("k", F.col("component").alias("cluster")))
        # Sites that are not core ask for the smallest cluster within the radius.
        asking = F.when(F.col("cluster").isNull() & F.col("k").isNotNull(), limit)
        marked = self.sites.join(named.withColumnRenamed("k", "_core"), F.col("k") == F.col("_core"), "left").withColumn("bound", asking)
        border = blocks.least_within(blocks.blocks_of(marked, dims, self.planes, "cluster"), len(dims))
        placed = (
            self.sites.join(named.select(F.col("k").alias("_core"), "cluster"), F.col("k") == F.col("_core"), "left")
            .join(border, F.col("k") == F.col("_asked"), "left")
            .select(*dims, F.coalesce("cluster", "near", F.lit(NOISE)).alias("cluster"), F.col("_core").isNotNull().alias("is_core"))
        )
        return self.points.join(placed, dims).select(self.key, "cluster", "is_core")


# Sites of a list of nearest ones at least; shares of the listed edges at whose length the largest cluster is looked up.
LISTED, LEVELS = 10, (0.7, 0.97, 1.0)


def reachability(df: DataFrame, key: str, dims: Sequence[str], radius: float, min_pts: int) -> Reachability:
    """Core distances and the spanning forest of mutual reachability up to ``radius``, in any number of dimensions.

    Every site lists its nearest ones.  Let ``bound`` be a length at which the listed edges connect a site with one fixed
    site.  Two sites are connected by listed edges no longer than the larger of their bounds, so of the edges that
    are not listed a least forest needs only those shorter than the bound of an end.  Each site asks for these.
    """
    ship_code(df.sparkSession)
    dims = widest(df, dims)
    limit = radius * radius
    points = df.select(key, *[F.col(d).cast("double").alias(d) for d in dims])
    none = F.lit(None).cast("double")
    sites = cut_lineage(sites_of(points, dims, radius, [F.count(F.lit(1)).alias("w"), F.min(key).alias("k")])
                        .select(*dims, "k", "w", none.alias("core2"), none.alias("bound")))
    count = sites.count()
    planes = blocks.planes_of(sites, dims, count)
    listed = cut_lineage(blocks.nearest(blocks.blocks_of(sites, dims, planes), dims, max(LISTED, min_pts), radius, min_pts))
    able = listed.where("core2 IS NOT NULL")
    ends = able.groupBy(F.col("k").alias("b")).agg(F.min("core2").alias("_core2"))
    edges = (
        able.select(F.col("k").alias("a"), "core2", F.explode(F.arrays_zip("others", "gaps")).alias("_o"))
        .select("a", "core2", F.col("_o.others").alias("b"), F.col("_o.gaps").alias("_gap")).where("a <> b").join(ends, "b")
        .select("a", "b", F.greatest("_gap", "core2", "_core2").alias("far2"))
    )
    edges = cut_lineage(edges.mapInArrow(_forests, "a long, b long, far2 double"))
    nodes = able.select(F.col("k").alias("node")).distinct()
    # A single block is compared whole.
    bounds = _bounds(nodes, edges) if count > blocks.BLOCK else nodes.withColumn("_bound", F.lit(None).cast("double"))
    # A whole list, or one that reaches as far as the bound, leaves nothing to ask for.
    asking = F.when(F.greatest("core2", "reach2") <= F.coalesce("_bound", F.lit(limit)), F.coalesce("_bound", F.lit(limit)))
    bounded = able.join(bounds, F.col("k") == F.col("node"), "left").select(
        *dims, "k", "w", "core2", F.when(F.col("reach2").isNotNull(), asking).alias("bound"))
    found = blocks.edges_within(blocks.blocks_of(bounded, dims, planes), len(dims), _forests)
    return Reachability(points, key, dims, radius, listed.select(*dims, "k", "w", "core2"), cut_lineage(edges.unionByName(found)), planes)


def _bounds(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, _bound): the first of a few lengths at which ``edges`` connect a node with one fixed node; others are left out."""
    lengths = edges.agg(F.percentile_approx("far2", list(LEVELS), 10_000)).first()[0]
    root, out = None, None
    for length in sorted(set(lengths or [])):
        parts = cut_lineage(connected_components(nodes, edges.where(F.col("far2") <= length).select("a", "b")))
        if root is None:
            root = parts.groupBy("component").count().orderBy(F.desc("count"), "component").first()["component"]
        own = parts.where(F.col("node") == root).first()["component"]
        told = parts.where(F.col("component") == own).select("node", F.lit(length).alias("_bound"))
        out = told if out is None else out.unionByName(told)
    return nodes.withColumn("_bound", F.lit(None).cast("double")) if out is None else out.groupBy("node").agg(F.min("_bound").alias("_bound"))


# Edges that a task holds before it reduces them to a forest.
_HELD_EDGES = 1 << 20


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def reduced() -> tuple[np.ndarray, ...]:
        a, b, w = (np.concatenate(c) for c in zip(*held))
        keep = least_forest(a, b, w)
        return a[keep], b[keep], w[keep]

    for batch in batches:
        held.append(tuple(c.to_numpy() for c in batch.columns))
        size += batch.num_rows
        if size > _HELD_EDGES:
            held = [reduced()]
            # A forest of many sites is not reduced again until as many edges have come.
            size = -len(held[0][0]) if len(held[0][0]) > _HELD_EDGES // 2 else len(held[0][0])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in reduced()], names=["a", "b", "far2"])


def least_forest(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Places of the edges of a minimum spanning forest, by Boruvka's rounds; ties go to the earlier edge."""
    names, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    place = np.empty(len(a), dtype=np.int64)
    place[np.argsort(w, kind="stable")] = np.arange(len(a))
    by_place = np.argsort(place)
    part = np.arange(len(names))
    keep = np.zeros(len(a), dtype=bool)
    while True:
        px, py = part[x], part[y]
        live = np.flatnonzero(px != py)
        if not len(live):
            return np.flatnonzero(keep)
        best = np.full(len(names), len(a), dtype=np.int64)
        np.minimum.at(best, px[live], place[live])
        np.minimum.at(best, py[live], place[live])
        own = np.flatnonzero(best < len(a))
        edge = by_place[best[own]]
        keep[edge] = True
        # Every part points to the other end of its edge; of two that point at each other the smaller is the root.
        to = np.arange(len(names))
        to[own] = np.where(part[x[edge]] == own, part[y[edge]], part[x[edge]])
        mutual = (to[to] == np.arange(len(names))) & (np.arange(len(names)) < to)
        to[mutual] = np.flatnonzero(mutual)
        while not np.array_equal(to, to[to]):
            to = to[to]
        part = to[part]


def _dbscan_pairs(df: DataFrame, key: str, dims: Sequence[str], eps: float, min_pts: int) -> DataFrame:
    """Many dimensions: a cell cannot stand for its points, so core points are connected by their forest."""
    return reachability(df, key, dims, eps, min_pts).clusters(eps)


def _dbscan_cells(df: DataFrame, key: str, dims: Sequence[str], eps: float, min_pts: int) -> DataFrame:
    """Few dimensions: all points of a cell are neighbours."""
    cells, limit = cell_names(dims), F.lit(eps * eps)
    side, reach = eps / math.sqrt(len(dims)), math.ceil(math.sqrt(len(dims)))
    if len(dims) == 1:
        reach = 1
    rows = on_grid(df.select(key, *[F.col(d).cast("double").alias(d) for d in dims]), dims, side)
    sites = sites_of(df, dims, side, [F.count(F.lit(1)).alias("w"), F.min(key).alias("k")])
    full = sites.groupBy(*cells).agg(F.sum("w").alias("n"))
    sites = cut_lineage(sites.join(full, cells).withColumn("dense", F.col("n") >= min_pts).drop("n"))
    hot = hot_cells(sites, dims)
    poor = sites.where("not dense")
    degree = (
        cell_join(poor.select(*cells, *dims), sites, dims, reach, hot).where(gap_squared(dims) <= limit)
        .groupBy(*[f"_q_{d}" for d in dims]).agg(F.sum("w").alias("degree"))
        .withColumnsRenamed({f"_q_{d}": d for d in dims})
    )
    poor = cut_lineage(poor.join(degree, list(dims)).withColumn("is_core", F.col("degree") >= min_pts))
    core = sites.where("dense").select(*cells, *dims, "k").unionByName(poor.where("is_core").select(*cells, *dims, "k"))
    named = core.groupBy(*cells).agg(F.min("k").alias("node"))
    core = cut_lineage(core.join(named, cells))
    edges = _cell_edges(core, dims, eps, reach)
    parts = connected_components(core.select("node").distinct(), edges)
    by_cell = cut_lineage(
        core.select(*cells, "node").distinct().join(parts, "node").select(*cells, F.col("component").alias("cluster")))
    dense_cells = sites.where("dense").select(*cells).distinct().join(by_cell, cells)
    border = (
        cell_join(poor.where("not is_core").select(*cells, *dims), core.select(*cells, *dims).join(by_cell, cells), dims, reach, hot)
        .where(gap_squared(dims) <= limit)
        .groupBy(*[f"_q_{d}" for d in dims]).agg(F.min("cluster").alias("near"))
        .withColumnsRenamed({f"_q_{d}": d for d in dims})
    )
    placed = (
        poor.join(border, list(dims), "left").join(by_cell, cells, "left")
        .withColumn("cluster", F.when(F.col("is_core"), F.col("cluster")).otherwise(F.coalesce("near", F.lit(NOISE))))
        .select(*cells, *dims, "cluster", "is_core")
    )
    rich = rows.join(dense_cells, cells).select(key, "cluster", F.lit(True).alias("is_core"))
    return rich.unionByName(rows.join(placed, [*cells, *dims]).select(key, "cluster", "is_core"))


def core_points(df: DataFrame, dims: Sequence[str], eps: float, min_pts: int) -> DataFrame:
    """Distinct points with ``is_core``: at least ``min_pts`` rows within eps, the point included."""
    from lumentab.operators.distance import neighbour_counts

    return neighbour_counts(df, dims, eps).withColumn("is_core", F.col("neighbours") >= min_pts)


def dbscan_sweep(df: DataFrame, key: str, dims: Sequence[str], radii: Sequence[float], min_pts: int,
                 max_noise: float = 0.40) -> tuple[DataFrame, float]:
    """First radius that gives two clusters or more and less noise than ``max_noise`` (else the last).

    All radii read one forest, made at the largest.
    """
    whole, apart = _with_coordinates(df, key, dims)
    reach = reachability(whole, key, dims, max(radii), min_pts)
    out, used = None, None
    for eps in radii:
        out, used = cut_lineage(reach.clusters(eps).unionByName(apart)), eps
        stats = out.agg(
            F.count_distinct(F.when(F.col("cluster") != NOISE, F.col("cluster"))).alias("k"),
            F.avg((F.col("cluster") == NOISE).cast("double")).alias("noise")).first()
        if stats["k"] >= 2 and stats["noise"] < max_noise:
            break
    return out, used
