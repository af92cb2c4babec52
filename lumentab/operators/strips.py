"""Rows within a radius in the plane, counted without looking at every near pair.

The plane is cut into square tiles whose side is a multiple of the radius; a tile gets its own sites and those within
the radius around it.  In a tile, sites lie in strips, sorted along the strip: of a strip, a ball holds all sites of an
inner stretch, none outside an outer stretch, and only those between the two are compared.  An axis with few values has
one strip for each, with next to nothing between the stretches; else strips are as high as balances both costs, so a
point costs about the root of its near rows.  Comparisons are those of the plain formula, so counts are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lumentab.operators import distance
from lumentab.operators.ship import SHIP_ROWS
from lumentab.session import ship_code, shuffle_width

# Strips in the height of one radius at most; pairs compared at a time.
MOST_STRIPS, PAIRS = 64, 1 << 21
# A tile should have as many own sites as this many hot cells, and is dealt to several tasks beyond HOT_TILE of them.
OWN_TILE, HOT_TILE = 10, 50
# Factors that keep rounding out of the inner and inside the outer stretch.
SLACK, SLACK_SQUARE = 1e-9, 1e-12


def ball_sums(points: DataFrame, dims: Sequence[str], eps: float, votes: Sequence[Column], apart: bool = False) -> DataFrame:
    """Distinct points (dims) with ``copies`` and ``votes``: the array of each vote's sums over the rows within ``eps``.

    ``votes`` are aggregates over the rows of a point.  With ``apart`` rows at distance 0 do not count.  A point without
    finite coordinates is left out: it has no distance.
    """
    spark = points.sparkSession
    ship_code(spark)
    x, y = dims
    finite = points.withColumns({d: F.col(d).cast("double") for d in dims})
    finite = finite.where((F.abs(x) < float("inf")) & (F.abs(y) < float("inf")))
    cell = [F.floor(F.col(d) / F.lit(eps)) for d in dims]
    size = finite.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.struct(*cell)).alias("cells")).first()
    width = shuffle_width(spark)
    own = min(max(size["n"] / (4 * width), 500), OWN_TILE * distance.HOT_CELL)
    side = eps * max(1, math.floor(math.sqrt(own * max(size["cells"], 1) / max(size["n"], 1))))
    names = [f"_v{i}" for i in range(len(votes))]
    sites = finite.groupBy(x, y).agg(F.count(F.lit(1)).alias("copies"), *[v.cast("long").alias(c) for v, c in zip(votes, names)])

    def place(value: Column) -> Column:
        return F.floor(value / F.lit(side)).cast("long")

    reach = F.lit(eps * (1 + SLACK))
    tiled = sites
    for g, d in (("_g0", x), ("_g1", y)):
        tiled = tiled.withColumn(g, F.explode(F.sequence(place(F.col(d) - reach), place(F.col(d) + reach))))
    tiled = tiled.withColumns({"_ask": (F.col("_g0") == place(F.col(x))) & (F.col("_g1") == place(F.col(y))), "_serve": F.lit(True)})
    keys, hot = ["_g0", "_g1"], _hot_tiles(tiled)
    if hot is not None:
        tiled, keys = _dealt(tiled, hot, dims), [*keys, "_part", "_of"]
    parts = max(2 * width, size["n"] // 200_000)
    schema = f"{x} double, {y} double, copies long, votes array<long>"
    found = (
        tiled.repartition(parts, *keys).groupBy(*keys)
        .applyInArrow(lambda group: _counted(group.select([x, y, "copies", "_ask", "_serve", *names]), eps, apart), schema)
    )
    if hot is None:
        return found
    sums = found.groupBy(x, y).agg(F.max("copies").alias("copies"), *[F.sum(F.get("votes", F.lit(i))).alias(c) for i, c in enumerate(names)])
    return sums.select(x, y, "copies", F.array(*names).alias("votes"))


def _hot_tiles(tiled: DataFrame) -> DataFrame | None:
    """Tiles with too many sites for a task and the number of parts they are dealt to; None if there are none."""
    most = HOT_TILE * distance.HOT_CELL
    hot = tiled.groupBy("_g0", "_g1").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(
        "_g0", "_g1", F.ceil(F.col("_n") / most).cast("int").alias("_parts"))
    head = hot.limit(SHIP_ROWS + 1).collect()
    if not head:
        return None
    return F.broadcast(tiled.sparkSession.createDataFrame(head, hot.schema)) if len(head) <= SHIP_ROWS else hot


def _dealt(tiled: DataFrame, hot: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Askers and sites of a hot tile are dealt to parts by hash; every part of the one meets every part of the other."""
    def role(part: Column, of: Column, ask: Column, serve: bool) -> Column:
        return F.struct(part.cast("int").alias("_part"), of.cast("int").alias("_of"), ask.alias("_ask"), F.lit(serve).alias("_serve"))

    every = F.sequence(F.lit(0), F.col("_parts") - 1)
    mine = F.pmod(F.xxhash64(*dims), F.col("_parts"))
    zero = F.lit(0)
    serving = F.transform(every, lambda p: role(p, mine, F.lit(False), True))
    asking = F.transform(every, lambda p: role(mine, p, F.lit(True), False))
    roles = F.when(F.col("_parts").isNull(), F.array(role(zero, zero, F.col("_ask"), True))).when(
        F.col("_ask"), F.concat(serving, asking)).otherwise(serving)
    return tiled.join(hot, ["_g0", "_g1"], "left").withColumn("_role", F.explode(roles)).drop("_ask", "_serve", "_parts").select("*", "_role.*").drop("_role")


def _counted(group: pa.Table, eps: float, apart: bool) -> pa.Table:
    x, y, copies, ask, serve, *votes = (c.to_numpy() for c in group.columns)
    ask, serve = np.flatnonzero(ask), np.flatnonzero(serve)
    told = ball_counts(x[ask], y[ask], x[serve], y[serve], np.stack([v[serve] for v in votes], axis=1), eps, apart)
    lists = pa.FixedSizeListArray.from_arrays(pa.array(told.ravel()), told.shape[1]).cast(pa.list_(pa.int64()))
    return pa.table([pa.array(x[ask]), pa.array(y[ask]), pa.array(copies[ask]), lists], names=[*group.column_names[:3], "votes"])


def strip_numbers(y: np.ndarray, n_near: float, eps: float) -> np.ndarray:
    """The strip of each of the ascending values ``y``."""
    height = (y[-1] - y[0]) / eps + 1
    values = np.concatenate(([0], np.cumsum(y[1:] != y[:-1])))
    if values[-1] + 1 <= min(MOST_STRIPS, 2 * math.sqrt(n_near)) * height:
        return values
    each = min(max(1.0, math.sqrt(n_near) / 2), MOST_STRIPS)
    return np.floor((y - y[0]) * (each / eps)).astype(np.int64)


def ball_counts(qx: np.ndarray, qy: np.ndarray, sx: np.ndarray, sy: np.ndarray, votes: np.ndarray, eps: float, apart: bool) -> np.ndarray:
    """Sums of ``votes`` (one row per site) over the sites within ``eps`` of each asker."""
    out = np.zeros((len(qx), votes.shape[1]), dtype=np.int64)
    if not len(qx) or not len(sx):
        return out
    if len(np.unique(sx)) < len(np.unique(sy)):  # strips run along the axis of more values
        qx, qy, sx, sy = qy, qx, sy, sx
    limit = eps * eps
    order = np.argsort(sy, kind="stable")
    spread = max(np.ptp(sx) / eps, 1.0) * max(np.ptp(sy) / eps, 1.0)
    strip = strip_numbers(sy[order], len(sx) / spread, eps)
    order = order[np.lexsort((sx[order], strip))]
    sx, sy, votes = sx[order], sy[order], votes[order]
    before = np.concatenate((np.zeros((1, votes.shape[1]), dtype=np.int64), np.cumsum(votes, axis=0)))
    turn = np.lexsort((qx, qy))
    qx, qy = qx[turn], qy[turn]
    reach = eps * (1 + SLACK)
    starts = np.flatnonzero(np.concatenate(([True], strip[1:] != strip[:-1])))
    lows, highs = np.minimum.reduceat(sy, starts), np.maximum.reduceat(sy, starts)
    first, last = np.searchsorted(qy, lows - reach, "left"), np.searchsorted(qy, highs + reach, "right")

    def compared(lo: np.ndarray, hi: np.ndarray, base: int, at: int, zero: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Askers and sites of the stretches ``lo`` to ``hi`` (of the strip from ``at``) that are near, or at distance 0."""
        some = np.flatnonzero(hi > lo)
        if not len(some):
            return
        sizes = (hi - lo)[some]
        ends = np.cumsum(sizes)
        done = 0
        while done < len(some):
            held = ends[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(ends, held + PAIRS, "right")))
            n = sizes[done:stop]
            q = base + np.repeat(some[done:stop], n)
            s = at + np.arange(n.sum()) + np.repeat(lo[some[done:stop]] - (np.cumsum(n) - n), n)
            gap = (qx[q] - sx[s]) * (qx[q] - sx[s]) + (qy[q] - sy[s]) * (qy[q] - sy[s])
            near = gap == 0 if zero else gap <= limit
            yield q[near], s[near]
            done = stop

    def add(found: Iterator[tuple[np.ndarray, np.ndarray]], sign: int) -> None:
        for q, s in found:
            if len(q):
                base, top = q[0], q[-1] + 1
                for k in range(votes.shape[1]):
                    total[base:top, k] += sign * np.bincount(q - base, weights=votes[s, k], minlength=top - base).astype(np.int64)

    total = np.zeros_like(out)
    for a, b, low, high, i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(sx)], lows.tolist(), highs.tolist(), first.tolist(), last.tolist()):
        if i == j:
            continue
        row, x, y = sx[a:b], qx[i:j], qy[i:j]
        near = np.maximum(np.maximum(low - y, y - high), 0.0)
        far = np.maximum(np.abs(y - low), np.abs(y - high))
        wide = np.sqrt(np.maximum(limit * (1 + SLACK_SQUARE) - near * near, 0.0)) * (1 + SLACK)
        sure = limit * (1 - SLACK_SQUARE) - far * far
        deep = np.sqrt(np.maximum(sure, 0.0)) * (1 - SLACK) - 4 * np.spacing(np.abs(x) + eps)
        lo, hi = np.searchsorted(row, x - wide, "left"), np.searchsorted(row, x + wide, "right")
        inside = (sure > 0) & (deep > 0)
        deep = np.where(inside, deep, 0.0)
        from_, to = np.searchsorted(row, x - deep, "left"), np.searchsorted(row, x + deep, "right")
        from_, to = np.where(inside, from_, lo), np.where(inside, to, lo)
        total[i:j] += before[a + to] - before[a + from_]
        add(compared(lo, from_, i, a, False), 1)
        add(compared(to, hi, i, a, False), 1)
        if apart:
            # Squares of differences this small vanish: such points are at distance 0.
            tiny = np.where(near <= 1e-150, 1e-150, -1.0)
            lo, hi = np.searchsorted(row, x - np.maximum(tiny, 0), "left"), np.searchsorted(row, x + np.maximum(tiny, 0), "right")
            add(compared(lo, np.where(tiny > 0, hi, lo), i, a, True), -1)
    out[turn] = total
    return out
