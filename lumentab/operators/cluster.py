"""Centre-based clustering, projections and cluster quality over array columns.

Every iteration is one aggregate over the rows; only k centres of d numbers travel to the
driver and back as literals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from lumentab.functions.columns import squared_distance
from lumentab.operators.distance import nearest_centre
from lumentab.operators.potential import row_potentials
from lumentab.session import cut_lineage, ship_code, shuffle_width

Centres = list[list[float]]
# Radii and ratios of subtractive clustering.
RADIUS, SUPPRESSION, ACCEPT_RATIO, REJECT_RATIO = 0.5, 1.5, 0.5, 0.15


def vectors(df: DataFrame, features: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(features).cast("array<double>")))


# ---------------------------------------------------------------- projection

@dataclass(frozen=True)
class Projection:
    mean: list[float]
    axes: list[list[float]]
    explained: list[float]

    def coordinate(self, vector: Column, i: int) -> Column:
        centred = F.zip_with(vector, F.lit(self.mean), lambda x, m: x - m)
        return F.aggregate(
            F.zip_with(centred, F.lit(self.axes[i]), lambda x, a: x * a), F.lit(0.0), lambda acc, x: acc + x)

    def transform(self, df: DataFrame, features: str) -> DataFrame:
        vector = F.col(features).cast("array<double>")
        return df.withColumns({f"pc{i + 1}": self.coordinate(vector, i) for i in range(len(self.axes))})


def fit_projection(df: DataFrame, features: str, k: int = 2) -> Projection:
    """Principal axes of the centred rows; the largest loading of each axis is made positive."""
    prepared = vectors(df, features)
    centred = StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=False).fit(prepared)
    model = PCA(k=k, inputCol="centred", outputCol="pc").fit(centred.transform(prepared))
    axes = model.pc.toArray().T
    axes = [a if a[np.argmax(np.abs(a))] > 0 else -a for a in axes]
    return Projection(
        [float(v) for v in centred.mean], [[float(v) for v in a] for a in axes],
        [float(v) for v in model.explainedVariance])


def centres_in_plane(plane: Projection, df: DataFrame, features: str, cluster: str) -> DataFrame:
    """(cluster, n, pc1, pc2, explained1, explained2): mean of each cluster's projected rows, with the axes' shares of the variance."""
    names = [f"pc{i + 1}" for i in range(len(plane.axes))]
    means = plane.transform(df, features).groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in names])
    return means.withColumns({f"explained{i + 1}": F.lit(v) for i, v in enumerate(plane.explained)})


# ---------------------------------------------------------------- k-means

# Rows that only choose first centres, cells of a block (rows times dimensions), and rows of a partition at least.
START_ROWS, BLOCK_CELLS, BLOCK_ROWS = 4096, 1 << 19, 20_000


def _start_rows(df: DataFrame, features: str) -> np.ndarray:
    vector = F.col(features).cast("array<double>")
    head = df.select(vector.alias("v")).where(F.col("v").isNotNull()).orderBy(F.xxhash64("v"), "v").limit(START_ROWS).collect()
    return np.array([r["v"] for r in head], dtype=float)


def _spread(x: np.ndarray, k: int, seed: int) -> Centres:
    """First centres: each next one is drawn by its squared distance to those chosen."""
    rng = np.random.default_rng(seed)
    chosen = [x[rng.integers(len(x))]]
    gap = ((x - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        at = rng.choice(len(x), p=gap / gap.sum()) if gap.sum() > 0 else rng.integers(len(x))
        chosen.append(x[at])
        gap = np.minimum(gap, ((x - x[at]) ** 2).sum(axis=1))
    return [[float(v) for v in c] for c in chosen]


def packed_vectors(df: DataFrame, features: str) -> DataFrame:
    """Blocks of vectors as bytes, for loops that pass over them many times; in as many partitions as the rows need."""
    ship_code(df.sparkSession)
    vector = df.select(F.col(features).cast("array<double>").alias("v")).where(F.col("v").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                step = max(1, BLOCK_CELLS // max(x.shape[1], 1))
                parts = [x[lo:lo + step] for lo in range(0, len(x), step)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(p) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["n", "x"])

    blocks = vector.mapInArrow(run, "n long, x binary")
    rows = vector.count()
    return cut_lineage(blocks.coalesce(max(1, min(blocks.rdd.getNumPartitions(), -(-rows // BLOCK_ROWS)))))


def advance(blocks: DataFrame, models: Mapping[int, Centres], costs: bool = True) -> dict[int, tuple[Centres, float, list[int]]]:
    """One step of all models in one pass: new centres (an empty cluster keeps its own), the cost before it, and sizes.

    Without ``costs`` the cost is 0: steps in between need none, and it takes as long as the step.  Blocks send a sum and a count per (model, cluster), which are added up by model; ties go to the lower cluster.
    """
    arrays = {m: np.array(c, dtype=float) for m, c in models.items()}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["x"]).reshape(row["n"], -1)
                square = (x * x).sum(axis=1)
                for m, c in arrays.items():
                    gap = square[:, None] + (c * c).sum(axis=1)[None] - 2 * (x @ c.T)
                    near = gap.argmin(axis=1)
                    hit = np.zeros((len(c), len(x)))
                    hit[near, np.arange(len(x))] = 1.0
                    cost = np.zeros(len(c))
                    if costs:
                        diff = x - c[near]
                        cost = hit @ (diff * diff).sum(axis=1)
                    own = np.concatenate((hit @ x, hit.sum(axis=1)[:, None], cost[:, None]), axis=1)
                    total[m] = total[m] + own if m in total else own
        yield from _packets(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["payload"]).reshape(arrays[row["model"]].shape[0], -1)
                total[row["model"]] = total[row["model"]] + own if row["model"] in total else own
        yield from _packets(total)

    pieces = blocks.mapInArrow(sums, "model int, payload binary")
    width = max(1, min(len(models), shuffle_width(blocks.sparkSession)))
    if blocks.rdd.getNumPartitions() > 1:
        pieces = pieces.repartition(width, "model").mapInArrow(added, "model int, payload binary")
    out = {}
    for row in pieces.toArrow().to_pylist():
        old = arrays[row["model"]]
        own = np.frombuffer(row["payload"]).reshape(len(old), -1)
        n = own[:, -2]
        mean = np.where(n[:, None] > 0, own[:, :-2] / np.maximum(n, 1)[:, None], old)
        out[row["model"]] = ([[float(v) for v in c] for c in mean], float(own[:, -1].sum()), [int(v) for v in n])
    return out


def _packets(total: Mapping[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["model", "payload"])


def fit_together(df: DataFrame, features: str, models: Sequence[Centres], max_iter: int = 300, tol: float = 1e-4) -> list[tuple[Centres, float]]:
    """K-means from each list of first centres, all models in one loop: (centres, inertia) of each.

    A model leaves the loop when none of its centres moves by more than ``tol``; so there are as many passes over
    the rows as the slowest model has steps, whatever the number of models.
    """
    blocks = packed_vectors(df, features)
    now = dict(enumerate(models))
    live, cost = set(now), {}
    for _ in range(max_iter):
        moved = advance(blocks, {m: now[m] for m in live}, costs=False)
        if not moved:
            break
        for m, (centres, _, _) in moved.items():
            if max(math.dist(a, b) for a, b in zip(centres, now[m])) <= tol:
                live.discard(m)
            now[m] = centres
        if not live:
            break
    for m, (_, c, _) in advance(blocks, now).items():
        cost[m] = c
    return [(now[m], cost.get(m, 0.0)) for m in range(len(models))]


def elbow(df: DataFrame, features: str, ks: Sequence[int], seeds: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Inertia and (squared Euclidean) silhouette of the best start per k; all starts of all k are fitted together."""
    kept = df.select(F.col(features).cast("array<double>").alias("v")).where(F.col("v").isNotNull()).persist()
    sample = _start_rows(kept, "v")
    wanted = [(k, seed) for k in ks for seed in (seeds if k > 1 else seeds[:1])]
    fitted = fit_together(kept, "v", [_spread(sample, k, seed) for k, seed in wanted])
    rows = []
    for k in ks:
        centres, cost = min((f for (own, _), f in zip(wanted, fitted) if own == k), key=lambda f: f[1])
        score = None
        if k > 1:
            told = squared_silhouette(kept.withColumn("cluster", nearest_centre(F.col("v"), centres)["cluster"]), "v", "cluster", None)
            score = told.agg(F.avg("silhouette")).first()[0]
        rows.append((k, cost, score))
    kept.unpersist()
    return df.sparkSession.createDataFrame(rows, "k long, inertia double, silhouette double")


def fit_kmeans(df: DataFrame, features: str, k: int, seeds: Sequence[int] = (1, 2, 3), max_iter: int = 300) -> tuple[SeededClusters, float]:
    """Best of several starts by inertia; the starts are fitted together."""
    sample = _start_rows(df, features)
    centres, cost = min(fit_together(df, features, [_spread(sample, k, seed) for seed in seeds], max_iter), key=lambda f: f[1])
    return SeededClusters(centres, [cost]), cost


def lloyd_step(df: DataFrame, features: str, centres: Centres) -> tuple[Centres, float]:
    """Assign to the nearest centre and average: new centres (an empty cluster keeps its own) and inertia."""
    near = nearest_centre(F.col(features).cast("array<double>"), centres)
    found = (
        df.select(array_to_vector(F.col(features).cast("array<double>")).alias("_v"), near.alias("near"))
        .groupBy("near.cluster").agg(Summarizer.mean(F.col("_v")).alias("mean"), F.sum("near.d2").alias("cost"))
        .collect()
    )
    new = {r["cluster"]: [float(x) for x in r["mean"]] for r in found}
    return [new.get(i, list(c)) for i, c in enumerate(centres)], float(sum(r["cost"] for r in found))


@dataclass
class SeededClusters:
    centres: Centres
    inertia: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, features: str, out: str = "cluster") -> DataFrame:
        return df.withColumn(out, nearest_centre(F.col(features).cast("array<double>"), self.centres)["cluster"])


def fit_seeded(df: DataFrame, features: str, centres: Centres, max_iter: int = 500, tol: float = 1e-4) -> SeededClusters:
    """K-means from given centres; stops when no centre moves by more than ``tol``."""
    result = SeededClusters([list(map(float, c)) for c in centres])
    for _ in range(max_iter):
        new, cost = lloyd_step(df, features, result.centres)
        shift = max(math.dist(a, b) for a, b in zip(new, result.centres))
        result.centres = new
        result.inertia.append(cost)
        if shift <= tol:
            break
    return result


# ---------------------------------------------------------------- fuzzy c-means

def with_memberships(df: DataFrame, features: str, centres: Centres, m: float = 2.0, mark: str = "") -> DataFrame:
    """Adds ``_gaps<mark>`` (squared distances) and ``_u<mark>`` (memberships); gaps below 1e-12 count as 1e-12.

    The distances are a column of their own, so that they are computed once per row.
    """
    vector = F.col(features).cast("array<double>")
    gaps = F.array(*[squared_distance(vector, F.lit([float(x) for x in c])) for c in centres])
    power = F.lit(-1.0 / (m - 1.0))
    return (
        df.withColumn(f"_gaps{mark}", gaps)
        .withColumn(f"_near{mark}", F.transform(f"_gaps{mark}", lambda g: F.pow(F.greatest(g, F.lit(1e-12)), power)))
        .withColumn(f"_sum{mark}", F.aggregate(f"_near{mark}", F.lit(0.0), lambda a, x: a + x))
        .withColumn(f"_u{mark}", F.transform(f"_near{mark}", lambda x: x / F.col(f"_sum{mark}")))
        .drop(f"_near{mark}", f"_sum{mark}")
    )


@dataclass
class FuzzyClusters:
    centres: Centres
    m: float
    objective: list[float] = field(default_factory=list)
    partition: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, features: str) -> DataFrame:
        """Adds ``membership`` (array), ``certainty`` (largest membership) and ``cluster``."""
        found = with_memberships(df, features, self.centres, self.m).drop("_gaps").withColumnRenamed("_u", "membership")
        return found.withColumns({
            "certainty": F.array_max("membership"),
            "cluster": (F.array_position("membership", F.array_max("membership")) - 1).cast("int"),
        })


def hashed_start(df: DataFrame, features: str, key: str, c: int, m: float = 2.0, seed: int = 42) -> Centres:
    """Centres of pseudo-random memberships drawn from the hash of the key: repeatable on any cluster."""
    raw = [F.pmod(F.xxhash64(F.col(key), F.lit(seed * 1000 + i)), F.lit(10_007)) + 1.0 for i in range(c)]
    total = sum(raw[1:], raw[0])
    v = array_to_vector(F.col(features).cast("array<double>"))
    rows = df.select(v.alias("_v"), *[F.pow(r / total, F.lit(m)).alias(f"w{i}") for i, r in enumerate(raw)])
    row = rows.agg(*[Summarizer.mean(F.col("_v"), F.col(f"w{i}")).alias(f"c{i}") for i in range(c)]).first()
    return [[float(x) for x in row[f"c{i}"]] for i in range(c)]


def fuzzy_step(df: DataFrame, features: str, centres: Centres, m: float = 2.0,
               before: Centres | None = None) -> dict:
    """One pass: weighted centres, objective, partition coefficient and squared membership change."""
    k = range(len(centres))
    rows = with_memberships(df.select(features), features, centres, m)
    moved = F.lit(float("inf"))
    if before is not None:
        rows = with_memberships(rows, features, before, m, "_before")
        moved = squared_distance(F.col("_u"), F.col("_u_before"))
    rows = rows.select(
        array_to_vector(F.col(features).cast("array<double>")).alias("_v"), "_u", "_gaps", moved.alias("_moved"),
        *[F.pow(F.get("_u", F.lit(i)), F.lit(m)).alias(f"_w{i}") for i in k])
    terms = [F.col(f"_w{i}") * F.get("_gaps", F.lit(i)) for i in k]
    row = rows.agg(
        *[Summarizer.mean(F.col("_v"), F.col(f"_w{i}")).alias(f"c{i}") for i in k],
        F.sum(sum(terms[1:], terms[0])).alias("objective"),
        F.avg(F.aggregate("_u", F.lit(0.0), lambda a, x: a + x * x)).alias("partition"),
        F.sum("_moved").alias("moved"),
    ).first()
    return {
        "centres": [[float(x) for x in row[f"c{i}"]] for i in range(len(centres))],
        "objective": row["objective"], "partition": row["partition"], "moved": row["moved"],
    }


def fit_fuzzy(df: DataFrame, features: str, centres: Centres, m: float = 2.0, max_iter: int = 300,
              tol: float = 1e-6) -> FuzzyClusters:
    """Fuzzy c-means; stops when the memberships change by less than ``tol`` (Frobenius norm)."""
    result, before = FuzzyClusters([list(map(float, c)) for c in centres], m), None
    for _ in range(max_iter):
        step = fuzzy_step(df, features, result.centres, m, before)
        result.objective.append(step["objective"])
        result.partition.append(step["partition"])
        if math.sqrt(step["moved"]) < tol:
            break
        before, result.centres = result.centres, step["centres"]
    return result


def partition_sweep(df: DataFrame, features: str, key: str, cs: Sequence[int] = (2, 3, 4, 5, 6), m: float = 2.0,
                    max_iter: int = 1000, tol: float = 0.005) -> DataFrame:
    """Fuzzy partition coefficient and final objective per number of clusters."""
    rows = []
    for c in cs:
        fit = fit_fuzzy(df, features, hashed_start(df, features, key, c, m), m, max_iter, tol)
        rows.append((c, fit.partition[-1], fit.objective[-1], len(fit.objective)))
    return df.sparkSession.createDataFrame(rows, "c long, partition double, objective double, iterations long")


# ---------------------------------------------------------------- subtractive clustering

def _axes(dims: int) -> list[str]:
    return [f"i{k}" for k in range(dims)]


def with_cells(df: DataFrame, features: str, dims: int, width: float) -> DataFrame:
    """Rows of [0, 1]^dims with the numbers ``i0, i1, ...`` of their lattice cell; rows with a NULL coordinate have none."""
    last = _lattice_size(width) - 1
    vector = F.col(features).cast("array<double>")
    return df.withColumns({
        c: F.least(F.floor(F.get(vector, F.lit(k)) / F.lit(width)), F.lit(last)).cast("int") for k, c in enumerate(_axes(dims))})


def _lattice_size(width: float) -> int:
    """Cells along an axis."""
    return max(1, math.ceil(1 / width - 1e-9))


def cell_centre(dims: int, width: float) -> Column:
    return F.array(*[(F.col(c) + F.lit(0.5)) * F.lit(width) for c in _axes(dims)])


def lattice(df: DataFrame, features: str, dims: int, width: float) -> DataFrame:
    """(i0, i1, ..., weight): the filled cells and their rows.  The caller states the width; it never adapts to the data."""
    axes = _axes(dims)
    return with_cells(df, features, dims, width).dropna(subset=axes).groupBy(*axes).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def potentials(cells: DataFrame, dims: int, width: float, ra: float = RADIUS) -> DataFrame:
    """``cells`` with ``potential``: the sum of weight * exp(-4 d^2 / ra^2) over all cells, d between cell centres.

    The kernel is a product over the axes, so the sum is one pass per axis: each row spreads along the axis and
    what arrives at a place is added up.  After a pass only places that some filled cell has are kept.  A pass has
    at most (lattice places) x (cells of an axis) terms, whatever the number of rows.
    """
    axes = _axes(dims)
    filled = cut_lineage(cells)
    spread = filled.select(*axes, F.col("weight").alias("sum"))
    scale = 4.0 * width * width / (ra * ra)
    for k, axis in enumerate(axes):
        to = F.explode(F.sequence(F.lit(0), F.lit(_lattice_size(width) - 1)))
        moved = spread.withColumn("to", to).withColumn("gap", (F.col("to") - F.col(axis)).cast("double"))
        share = F.col("sum") * F.exp(F.col("gap") * F.col("gap") * F.lit(-scale))
        spread = moved.select(*[F.col("to").alias(c) if c == axis else F.col(c) for c in axes], share.alias("sum")).groupBy(
            *axes).agg(F.sum("sum").alias("sum"))
        spread = spread.join(filled.select(*axes[:k + 1]).distinct(), axes[:k + 1], "left_semi")
    return filled.join(spread.withColumnRenamed("sum", "potential"), axes)


def subtractive_centres(df: DataFrame, features: str, dims: int, width: float, ra: float = RADIUS, suppression: float = SUPPRESSION,
                        accept: float = ACCEPT_RATIO, reject: float = REJECT_RATIO, max_centres: int | None = None,
                        strict: bool = False) -> tuple[Centres, list[float]]:
    """Cell centres and their potentials, for rows of [0, 1]^dims on a lattice of the given width.

    A cell may become a centre if its share of the first potential is above ``accept``, or above ``reject`` and far
    enough from every centre for the sum of share and distance (in radii) to reach 1.  Both only shrink as centres
    come, so a cell that may not is never looked at again; the strongest cell that may is one aggregate, and the
    potentials after it are one projection.  ``strict`` uses > and < at the two limits instead of >= and <=.
    """
    table = cut_lineage(potentials(lattice(df, features, dims, width), dims, width, ra).withColumn("point", cell_centre(dims, width)))
    return _search(table, ra, suppression, accept, reject, max_centres, strict)


def subtractive_rows(df: DataFrame, features: str, dims: int, ra: float = RADIUS, suppression: float = SUPPRESSION, accept: float = ACCEPT_RATIO,
                     reject: float = REJECT_RATIO, max_centres: int | None = None, strict: bool = False) -> tuple[Centres, list[float]]:
    """Rows that become centres, and their potentials: as ``subtractive_centres``, with the sums over rows themselves.

    Boxes only place the work of the sums.  Equal rows are one candidate; among equal potentials the smaller point comes first.
    """
    told = row_potentials(df.select(F.col(features).alias("v")), "v", dims, ra).where(F.col("potential").isNotNull())
    table = told.select(F.slice(F.col("v").cast("array<double>"), 1, dims).alias("point"), "potential").groupBy("point").agg(F.max("potential").alias("potential"))
    return _search(cut_lineage(table), ra, suppression, accept, reject, max_centres, strict)


def _search(table: DataFrame, ra: float, suppression: float, accept: float, reject: float, max_centres: int | None,
            strict: bool) -> tuple[Centres, list[float]]:
    """The rounds of the search over candidates (point, potential)."""
    beta = 4.0 / (ra * suppression) ** 2
    # The strongest candidate; among equals the smallest point.
    strongest = F.max(F.struct(F.col("potential").alias("potential"), F.transform("point", lambda x: -x).alias("place"), F.col("point").alias("point")))
    found = table.agg(strongest.alias("best")).first()["best"]
    centres: Centres = []
    strength: list[float] = []
    while found is not None and found["potential"] > 0 and (max_centres is None or len(centres) < max_centres):
        centre = [float(v) for v in found["point"]]
        centres.append(centre)
        strength.append(float(found["potential"]))
        gap = squared_distance(F.col("point"), F.lit(centre))
        table = table.withColumn("potential", F.when(gap == 0, 0.0).otherwise(
            F.greatest(F.col("potential") - F.lit(strength[-1]) * F.exp(gap * F.lit(-beta)), F.lit(0.0))))
        if len(centres) % 8 == 0:
            table = cut_lineage(table)
        share = F.col("potential") / F.lit(strength[0])
        nearest = F.least(*[F.sqrt(squared_distance(F.col("point"), F.lit(c))) for c in centres], F.lit(math.inf))
        high, low = (share > accept, share >= reject) if strict else (share >= accept, share > reject)
        found = table.where(high | (low & (nearest / F.lit(ra) + share >= 1.0))).agg(strongest.alias("best")).first()["best"]
    return centres, strength


# ---------------------------------------------------------------- quality and profiles

def _cluster_sums(df: DataFrame, features: str, cluster: str) -> dict[int, tuple[int, np.ndarray]]:
    v = array_to_vector(F.col(features).cast("array<double>"))
    rows = df.select(v.alias("_v"), cluster).groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("_v")).alias("mean")).collect()
    return {r[cluster]: (r["n"], np.array(r["mean"].toArray())) for r in sorted(rows, key=lambda r: r[cluster])}


def separation(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """Davies-Bouldin and Calinski-Harabasz, noise (-1) left out; NULL with fewer than two clusters."""
    rows = df.where(F.col(cluster) != -1)
    sums = _cluster_sums(rows, features, cluster)
    labels, k = list(sums), len(sums)
    schema = "n_clusters long, davies_bouldin double, calinski_harabasz double"
    if k < 2:
        return df.sparkSession.createDataFrame([(k, None, None)], schema)
    vector = F.col(features).cast("array<double>")
    centre = F.coalesce(*[F.when(F.col(cluster) == c, F.lit([float(v) for v in sums[c][1]])) for c in labels])
    gap = squared_distance(vector, centre)
    spread = {
        r[cluster]: (r["s"], r["w"]) for r in rows.select(cluster, gap.alias("g")).groupBy(cluster).agg(
            F.avg(F.sqrt("g")).alias("s"), F.sum("g").alias("w")).collect()
    }
    means = np.array([sums[c][1] for c in labels])
    sizes = np.array([sums[c][0] for c in labels])
    s = np.array([spread[c][0] for c in labels])
    between = np.linalg.norm(means[:, None] - means[None], axis=2)
    np.fill_diagonal(between, np.inf)
    db = float(((s[:, None] + s[None]) / between).max(axis=1).mean())
    overall = (means * sizes[:, None]).sum(axis=0) / sizes.sum()
    b = float((sizes * ((means - overall) ** 2).sum(axis=1)).sum())
    w = float(sum(spread[c][1] for c in labels))
    n = int(sizes.sum())
    return df.sparkSession.createDataFrame([(k, db, (b / (k - 1)) / (w / (n - k)))], schema)


def squared_silhouette(df: DataFrame, features: str, cluster: str, noise: int | None = -1) -> DataFrame:
    """Rows with ``silhouette`` under the squared Euclidean distance, in linear time.

    The mean squared distance to a cluster follows from its size, mean and mean squared norm, taken about the mean
    of all rows.  Rows of the cluster ``noise`` and of no cluster are no cluster and get NULL.
    """
    inside = df.where(F.col(cluster).isNotNull() & (F.lit(True) if noise is None else F.col(cluster) != noise))
    centre = inside.select(Summarizer.mean(array_to_vector(F.col(features).cast("array<double>")))).first()[0]
    if centre is None or not len(centre):
        return df.withColumn("silhouette", F.lit(None).cast("double"))
    vector = F.zip_with(F.col(features).cast("array<double>"), F.lit([float(x) for x in centre]), lambda x, m: x - m)
    norm = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x)
    rows = inside.select(
        array_to_vector(vector).alias("_v"), norm.alias("q"), cluster).groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("_v")).alias("mean"), F.avg("q").alias("q")).collect()
    stats = {r[cluster]: (r["n"], [float(x) for x in r["mean"]], r["q"]) for r in rows}

    def to_cluster(c) -> Column:
        n, mean, q = stats[c]
        dot = F.aggregate(F.zip_with(vector, F.lit(mean), lambda x, m: x * m), F.lit(0.0), lambda a, x: a + x)
        return norm - 2.0 * dot + F.lit(float(q))

    def own_factor(c) -> float:
        n = stats[c][0]
        return n / (n - 1) if n > 1 else 0.0

    a = F.coalesce(*[F.when(F.col(cluster) == c, to_cluster(c) * own_factor(c)) for c in stats])
    b = F.least(*[F.when(F.col(cluster) != c, to_cluster(c)) for c in stats], F.lit(float("inf")))
    alone = [c for c in stats if stats[c][0] == 1]
    single = F.col(cluster).isin(*alone) if alone else F.lit(False)
    score = F.when(single, 0.0).otherwise(F.coalesce((F.col("_b") - F.col("_a")) / F.nullif(F.greatest("_a", "_b"), F.lit(0.0)), F.lit(0.0)))
    member = F.col(cluster).isNotNull() & (F.lit(True) if noise is None else F.col(cluster) != noise)
    return df.withColumns({"_a": a, "_b": b}).withColumn("silhouette", F.when(member, score)).drop("_a", "_b")


def cluster_profile(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each (standardised) column per cluster, with the size."""
    from lumentab.operators.profile import stats_by_column

    return stats_by_column(df, cols, {"n": F.count, "mean": F.avg, "sd": F.stddev_pop}, [cluster])


def composition(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Label counts and shares inside each cluster."""
    from lumentab.operators.profile import value_counts

    return value_counts(df, label, by=[cluster])
