"""Exact top-k inner products with an M-tree: paged metric nodes, best-first, cut by the triangle inequality.

The score of integer vectors is made a distance: with R the largest squared length of all vectors, a vector x gets
the further coordinate sqrt(R - |x|^2) and a query q gets 0, so d(q, x)^2 = |q|^2 + R - 2 q.x, and the highest
score is the least distance.

Index.  A bounded sample (``SAMPLE`` vectors) only places pivots; every vector is assigned.  The root holds the
pivots with the covering radius of their subtrees.  A subtree with more than ``SUBTREE`` vectors is dealt into
several by hash.  A subtree is a table of *pages* of about ``PAGE`` vectors: each stores its pivot, its covering
radius, and the distance of every vector to its pivot.

Search.  Queries go in blocks, first to the subtree of their nearest pivot, which gives every query a k-th distance.
Then each block visits the other subtrees whose pivot is nearer than that distance and the radius allow.  Within a
subtree the pages of a query are read in order of their least possible distance, until that exceeds the k-th
distance so far; in a page only the vectors are computed whose stored parent distance leaves them possible.

Equal vectors: at most k + 1 of them, those with the smallest ids, can be in a result, so no more are indexed;
equal queries are searched once.  A task holds one subtree and one block, whatever the data.

Defined results: vectors that are null or hold null or non-finite components, and rows without id, take no part;
shorter vectors are padded with zeros; of rows equal to the query in id and vector one is the query's own; ties go
to the smaller id; fewer than k others give as many; an empty table gives none.  Scores are exact as long as they
fit in 64 bits: larger products raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lumentab.llm.words import tidy
from lumentab.session import cut_lineage

#: Results of a query, and the scale of the vectors.
K, SCALE = 20, 64
#: Vectors of a subtree, of a page, and queries of a block, about; the pivots of the root at most; sampled vectors at most.
SUBTREE, PAGE, BLOCK, PIVOTS, SAMPLE = 8192, 128, 1024, 4096, 16384
# Rounding of distances: bounds give way by this part of the largest length.
SLACK = 1e-9


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of whole vectors."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & sound)
    return whole.select(F.col(key).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``dim``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    size = np.diff(offsets)
    flat = column.flatten().to_numpy()
    out = np.zeros((len(size), dim), dtype=np.int64)
    if len(flat):
        row = np.repeat(np.arange(len(size)), size)
        out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)] = flat
    return out


class Space:
    """Distances of queries and vectors; ``radius2`` is the largest squared length."""

    def __init__(self, dim: int, radius2: int, largest: int):
        self.dim, self.radius2 = dim, radius2
        self.exact = dim * largest * largest < 1 << 53
        self.slack = SLACK * (1.0 + radius2 ** 0.5)

    def scores(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Exact inner products: in doubles where they hold them."""
        if self.exact:
            return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        return q @ x.T

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with their further coordinate."""
        x = x.astype(np.float64)
        rest = np.sqrt(np.maximum(self.radius2 - (x * x).sum(axis=1), 0.0))
        return np.concatenate((x, rest[:, None]), axis=1)

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances of lifted vectors."""
        square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
        return np.sqrt(np.maximum(square, 0.0))

    def asked(self, q: np.ndarray) -> np.ndarray:
        """Queries with the further coordinate 0."""
        return np.concatenate((q.astype(np.float64), np.zeros((len(q), 1))), axis=1)

    def distance(self, square: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Of queries with squared length ``square`` at a score."""
        return np.sqrt(np.maximum(square + self.radius2 - 2.0 * score, 0.0))


def spread_pivots(space: Space, x: np.ndarray, n: int) -> np.ndarray:
    """Numbers of ``n`` rows of ``x`` at equal steps of an order along the row farthest from the mean: near rows stand close."""
    if n >= len(x):
        return np.arange(len(x))
    lifted = space.lifted(x)
    far = lifted[int(np.argmax(space.between(lifted, lifted.mean(axis=0)[None])[:, 0]))]
    order = np.argsort(space.between(lifted, far[None])[:, 0], kind="stable")
    return order[(np.arange(n) * len(x)) // n]


# ---------------------------------------------------------------- the index

def _assigned(rows: DataFrame, space: Space, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, region, far) with the nearest pivot and its distance; the pivots are bounded by ``PIVOTS``."""
    lifted = space.lifted(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                d = space.between(space.lifted(matrix(part.column(1), space.dim)), lifted)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(near, pa.int64()), pa.array(d[np.arange(len(near)), near])], names=["vec_id", "v", "region", "far"])

    return rows.mapInArrow(tidy(run), "vec_id long, v array<long>, region long, far double")


def pages(members: DataFrame, space: Space) -> DataFrame:
    """One row per page of rows (region, part, vec_id, v): pivot, covering radius, ids, vectors, parent distances, packed."""
    def build(table: pa.Table) -> pa.Table:
        ids, x = table.column("vec_id").to_numpy(), matrix(table.column("v"), space.dim)
        lifted = space.lifted(x)
        chosen = spread_pivots(space, x, -(-len(x) // PAGE))
        d = space.between(lifted, lifted[chosen])
        home = d.argmin(axis=1)
        out = []
        for p in np.unique(home):
            own = np.flatnonzero(home == p)
            own = own[np.argsort(d[own, p], kind="stable")]
            for lo in range(0, len(own), 2 * PAGE):
                row = own[lo:lo + 2 * PAGE]
                far = d[row, p]
                out.append((ids[row].astype(np.int64).tobytes(), x[row].tobytes(), far.tobytes(), x[chosen[p]].tobytes(), float(far.max())))
        names = ["ids", "vectors", "fars", "pivot", "radius"]
        region, part = (pa.array([table.column(c)[0].as_py()] * len(out), pa.int64()) for c in ("region", "part"))
        types = [pa.binary()] * 4 + [pa.float64()]
        return pa.table([region, part, *[pa.array(c, t) for c, t in zip(zip(*out), types)]], names=["region", "part", *names])

    return members.groupBy("region", "part").applyInArrow(
        build, "region long, part long, ids binary, vectors binary, fars binary, pivot binary, radius double")


# ---------------------------------------------------------------- the search

def search(space: Space, leaf: Sequence[tuple], q: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, id, score) of the best ``k`` per query in pages (ids, vectors, fars, pivot, radius), and the distances computed.

    ``bound`` holds distances beyond which a result is of no use.
    """
    dim, n = space.dim, len(q)
    asked, square = space.asked(q), (q.astype(np.float64) ** 2).sum(axis=1)
    ids = [np.frombuffer(p[0], np.int64) for p in leaf]
    fars = [np.frombuffer(p[2], np.float64) for p in leaf]
    vectors = [np.frombuffer(p[1], np.int64).reshape(-1, dim) for p in leaf]
    pivots = space.lifted(np.stack([np.frombuffer(p[3], np.int64) for p in leaf]).reshape(-1, dim))
    to_pivot = space.between(asked, pivots)
    least = np.maximum(to_pivot - np.array([p[4] for p in leaf])[None], 0.0)
    order = np.argsort(least, axis=1, kind="stable")
    limit = bound + space.slack
    best = [np.empty(0, np.int64)] * 3
    computed = to_pivot.size
    for turn in range(len(leaf)):
        page = order[:, turn]
        live = np.flatnonzero(least[np.arange(n), page] <= limit)
        if not len(live):
            break
        live = live[np.argsort(page[live], kind="stable")]
        cuts = np.flatnonzero(np.diff(page[live])) + 1
        found = [best]
        for own in np.split(live, cuts):
            p = int(page[own[0]])
            # The parent distance: |d(q, pivot) - d(x, pivot)| is the least d(q, x) can be.
            open_ = np.abs(to_pivot[own, p][:, None] - fars[p][None]) <= limit[own][:, None]
            some = open_.any(axis=0)
            computed += int(open_.sum())
            score = space.scores(q[own], vectors[p][some])
            near = open_[:, some] & (space.distance(square[own][:, None], score) <= limit[own][:, None])
            r, c = np.nonzero(near)
            found.append([own[r], ids[p][some][c], score[r, c]])
        who, what, score = (np.concatenate(c) for c in zip(*found))
        rank = np.lexsort((what, -score, who))
        who, what, score = who[rank], what[rank], score[rank]
        first = np.searchsorted(who, np.arange(n))
        keep = np.arange(len(who)) - first[who] < k
        best = [who[keep], what[keep], score[keep]]
        count = np.bincount(best[0], minlength=n)
        full = np.flatnonzero(count == k)
        last = np.searchsorted(best[0], full, side="right") - 1
        limit[full] = np.minimum(limit[full], space.distance(square[full], best[2][last]) + space.slack)
    return *best, computed


def _searched(index: DataFrame, queries: DataFrame, visits: DataFrame, space: Space, k: int) -> DataFrame:
    """(q, vec_id, score) found by visits (region, part, block) of queries (block, q, v, bound)."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=["q", "vec_id", "score"])
        leaf = list(zip(*(left.column(c).to_pylist() for c in ("ids", "vectors", "fars", "pivot", "radius"))))
        bound = right.column("bound").to_numpy()
        who, what, score, _ = search(space, leaf, matrix(right.column("v"), space.dim), bound.copy(), k)
        return pa.table([pa.array(right.column("q").to_numpy()[who]), pa.array(what), pa.array(score)], names=["q", "vec_id", "score"])

    keys = ("region", "part", "block")
    held = index.join(visits.select(*keys).distinct(), ["region", "part"])
    asked = queries.join(visits, ["q", "block"]).select(*keys, "q", "v", "bound")
    # Fresh column names on either side, as both come from the visits.
    names = [f"at_{c}" for c in keys]
    held, asked = (side.select(*[F.col(c).alias(n) for c, n in zip(keys, names)], *[c for c in side.columns if c not in keys]) for side in (held, asked))
    return held.groupBy(*names).cogroup(asked.groupBy(*names)).applyInArrow(run, "q long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """First block and number of blocks of each region: small regions share one, large ones are cut."""
    out, block, held = {}, 0, 0
    for region, n in sorted(counts.items()):
        if n > BLOCK:
            block += held > 0
            out[region] = (block, -(-n // BLOCK))
            block, held = block + out[region][1], 0
            continue
        if held + n > BLOCK:
            block, held = block + 1, 0
        out[region] = (block, 1)
        held += n
    return out


def _no_rows(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def top_k(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest scores of every row whose id ``every`` divides."""
    spark = rows.sparkSession
    whole = integer_vectors(rows, key, vector)
    size = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    n, dim, largest, radius2 = whole.agg(
        F.count(F.lit(1)), F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda c: F.abs(c)))), F.max(size)).first()
    if not n:
        return _no_rows(rows)
    largest, dim = int(largest or 0), max(int(dim), 1)
    if dim * largest * largest >= 1 << 63:
        raise OverflowError("inner products do not fit in 64 bits")
    space = Space(dim, int(radius2 or 0) + 1, largest)

    # Of equal vectors the k + 1 smallest ids; one more than k, as a query leaves itself out.
    same = Window.partitionBy("v").orderBy("vec_id")
    objects = cut_lineage(whole.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).drop("_n"))
    share = min(1.0, SAMPLE / n)
    sample = objects.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(SAMPLE).select("v").toArrow()
    x = matrix(sample.column(0), dim) if sample.num_rows else np.zeros((1, dim), np.int64)
    x = x[np.lexsort(x.T[::-1])]
    pivots = x[spread_pivots(space, x, min(PIVOTS, -(-n // SUBTREE)))]

    placed = cut_lineage(_assigned(objects, space, pivots))
    root = {r["region"]: r for r in placed.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect()}
    parts = F.create_map(*[F.lit(v) for r in root.values() for v in (r["region"], -(-r["n"] // SUBTREE))])
    spread = F.pmod(F.xxhash64("vec_id", "v"), parts[F.col("region")])
    index = cut_lineage(pages(placed.withColumn("part", spread), space))
    subtrees = index.select("region", "part").distinct()

    # Distinct queries by a hash of the vector and its place among equal hashes: an id for results.
    asked = whole.where(F.col("vec_id") % every == 0)
    first = asked.groupBy("v").agg(F.min("vec_id").alias("q"))
    distinct = first.groupBy("q").agg(F.collect_list("v").alias("vs")).select("q", F.posexplode("vs").alias("at", "v"))
    distinct = distinct.select(F.when(F.col("at") == 0, F.col("q")).otherwise(F.xxhash64("q", "v")).alias("vec_id"), "v")
    near = cut_lineage(_assigned(distinct, space, pivots).withColumnsRenamed({"vec_id": "q", "region": "home"}))
    homes = {r["home"]: r["n"] for r in near.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not homes:
        return _no_rows(rows)
    block = _blocks(homes)
    table = F.create_map(*[v for h, (b, m) in block.items() for v in (F.lit(h), F.struct(F.lit(b).alias("b"), F.lit(m).alias("m")))])
    at = table[F.col("home")]
    queries = cut_lineage(near.select("q", "v", "home", (at["b"] + F.pmod(F.xxhash64("q"), at["m"])).cast("long").alias("block")))

    # First the subtree at home: its k-th distance bounds the rest.
    endless = queries.withColumn("bound", F.lit(float("inf")))
    chosen = F.create_map(*[F.lit(v) for r in root.values() for v in (r["region"], r["n"])])
    start = endless.where(chosen[F.col("home")].isNotNull()).select("q", "block", F.col("home").alias("region"), F.pmod(F.xxhash64("q"), parts[F.col("home")]).alias("part"))
    home = cut_lineage(_ranked(_searched(index, endless, start, space, k + 1), k + 1).select("q", "vec_id", "score"))
    kth = home.groupBy("q").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("s")).where(F.col("c") == k + 1)
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    # greatest() passes over nulls, so queries without a k-th score are told apart first.
    reached = F.sqrt(F.greatest(squares + float(space.radius2) - 2.0 * F.col("s"), F.lit(0.0)))
    bounded = cut_lineage(queries.join(kth, "q", "left").withColumn(
        "bound", F.when(F.col("s").isNotNull(), reached).otherwise(F.lit(float("inf")))).drop("c", "s"))

    reach = _regions_in_reach(bounded, space, pivots, {r: float(v["radius"]) for r, v in root.items()})
    visits = reach.join(F.broadcast(subtrees) if len(root) * SUBTREE >= n else subtrees, "region").join(
        start.select("q", "region", "part"), ["q", "region", "part"], "left_anti")
    found = _searched(index, bounded, visits, space, k + 1).unionByName(home)
    best = _ranked(found, k + 1).select("q", "vec_id", "score", "rank")
    answers = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best"))

    # Every query drops its own row, or the last.
    told = queries.select("q", "v").join(answers, "q").select("v", "best")
    each = asked.join(told, "v").select(F.col("vec_id").alias("query_id"), "best", F.aggregate(
        "v", F.lit(0).cast("long"), lambda s, c: s + c * c).alias("own"))
    mine = F.array_position(F.transform("best", lambda b: (b["vec_id"] == F.col("query_id")) & (b["score"] == F.col("own"))), F.lit(True))
    rest = F.filter("best", lambda b, i: (F.col("mine") == 0) | (i + 1 != F.col("mine")))
    listed = each.withColumn("mine", mine).select("query_id", F.posexplode(F.slice(rest, 1, k)).alias("at", "b"))
    return listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


def _regions_in_reach(queries: DataFrame, space: Space, pivots: np.ndarray, radii: dict[int, float]) -> DataFrame:
    """(q, block, region) of the subtrees that may hold a vector within the bound of (q, v, block, bound)."""
    lifted = space.lifted(pivots)
    known = np.array(sorted(radii), dtype=np.int64)
    radius = np.array([radii[r] for r in known.tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                d = space.between(space.asked(matrix(part.column(1), space.dim)), lifted[known])
                r, c = np.nonzero(d - radius[None] <= part.column(3).to_numpy()[:, None] + space.slack)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(r)), part.column(2).take(pa.array(r)), pa.array(known[c])],
                                                 names=["q", "block", "region"])

    return queries.select("q", "v", "block", "bound").mapInArrow(tidy(run), "q long, block long, region long")
