import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumentab.operators import audit, cluster, density, distance


def points(seed, n=160, spread=0.06):
    rng = np.random.default_rng(seed)
    centres = rng.random((4, 2))
    xy = np.concatenate([centres[i % 4] + rng.normal(0, spread, 2) for i in range(n)]).reshape(n, 2)
    xy[: n // 5] = xy[0]  # a group of copies
    return xy


def brute_dbscan(xy, eps, min_pts):
    gaps = ((xy[:, None] - xy[None]) ** 2).sum(axis=2) <= eps * eps
    core = gaps.sum(axis=1) >= min_pts
    label = np.where(core, np.arange(len(xy)), -1)
    changed = True
    while changed:
        changed = False
        for i in np.flatnonzero(core):
            low = label[gaps[i] & core].min()
            if low < label[i]:
                label[i], changed = low, True
    for i in np.flatnonzero(~core):
        near = label[gaps[i] & core]
        label[i] = near.min() if len(near) else -1
    return label, core


def frame(spark, xy):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(xy)), "x": xy[:, 0], "y": xy[:, 1]}))


@pytest.mark.parametrize("seed,eps,min_pts", [(1, 0.05, 4), (3, 0.08, 12), (4, 0.02, 2)])
def test_dbscan_equals_brute_force(spark, salted, seed, eps, min_pts):
    xy = points(seed)
    got = density.dbscan(frame(spark, xy), "id", ["x", "y"], eps, min_pts).toPandas().sort_values("id")
    label, core = brute_dbscan(xy, eps, min_pts)
    assert list(got["id"]) == list(range(len(xy)))
    assert list(got["cluster"]) == list(label)
    assert list(got["is_core"]) == list(core)


def test_dbscan_in_three_dimensions(spark):
    rng = np.random.default_rng(8)
    xyz = rng.random((90, 3)) * 0.4
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(90), "x": xyz[:, 0], "y": xyz[:, 1], "z": xyz[:, 2]}))
    got = density.dbscan(df, "id", ["x", "y", "z"], 0.07, 4).toPandas().sort_values("id")
    assert list(got["cluster"]) == list(brute_dbscan(xyz, 0.07, 4)[0])


def test_many_dimensions_and_gaps(spark):
    """Six dimensions block on three; a row with a gap is noise."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(c, 0.15, (40, 6)) for c in (0.0, 1.0)] + [rng.uniform(-3, 3, (30, 6))])
    dims = [f"d{i}" for i in range(6)]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)] + [(500, None, *[0.0] * 5)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{d} double" for d in dims))
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= 0.45 ** 2
    core = near.sum(axis=1) >= 4
    label = np.where(core, np.arange(len(x)), len(x))
    for _ in range(len(x)):
        label = np.where(core, np.where(near & core[None], label[None], len(x)).min(axis=1), len(x))
    border = np.where(near & core[None], label[None], len(x)).min(axis=1)
    want = {i: (int(border[i]) if border[i] < len(x) else -1, bool(core[i])) for i in range(len(x))} | {500: (-1, False)}
    assert {r["id"]: (r["cluster"], r["is_core"]) for r in density.dbscan(df, "id", dims, 0.45, 4).collect()} == want
    got = distance.with_neighbour_counts(df, dims, 0.45).collect()
    assert {r["id"]: r["neighbours"] for r in got} == {i: int(n) for i, n in enumerate(near.sum(axis=1))} | {500: None}
    out, eps = density.dbscan_sweep(df, "id", dims, (0.01, 0.45, 9.0), 4)
    assert eps == 0.45 and out.count() == len(rows)


def test_forest_of_many_blocks_serves_every_radius(spark, monkeypatch):
    """Clumps of unlike density, copies and far rows in blocks of 32: clusters equal brute force at each radius."""
    from lumentab.operators import blocks

    monkeypatch.setattr(blocks, "BLOCK", 32)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, s, (50, 5)) for c, s in ((0.0, 0.1), (1.0, 0.3), (-1.5, 0.2))] + [rng.uniform(-3, 3, (20, 5))])
    x[:6] = x[0]
    dims = [f"d{i}" for i in range(5)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{d} double" for d in dims)).persist()
    reach = density.reachability(df, "id", dims, 1.6, 4)
    for eps in (0.25, 0.9):
        label, core = brute_dbscan(x, eps, 4)
        got = reach.clusters(eps).toPandas().sort_values("id")
        assert list(got["cluster"]) == list(label) and list(got["is_core"]) == list(core)
    df.unpersist()


def test_forest_weighs_as_little_as_that_of_all_pairs(spark, monkeypatch):
    """At a radius that holds all pairs, few of them are kept and none is joined by grid cells."""
    from lumentab.operators import blocks

    monkeypatch.setattr(blocks, "BLOCK", 64)
    monkeypatch.setattr(density, "cell_join", None)
    x = np.random.default_rng(6).normal(0, 1, (600, 4))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double, d double").persist()
    kept = density.reachability(df, "id", ["a", "b", "c", "d"], 20.0, 4).forest.collect()
    a, b, far2 = (np.array(c) for c in zip(*[(r["a"], r["b"], r["far2"]) for r in kept]))
    gaps = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    core = np.sort(gaps, axis=1)[:, 3]
    far = np.maximum(np.maximum(gaps, core[:, None]), core[None])
    i, j = np.triu_indices(600, 1)
    assert math.isclose(far2[density.least_forest(a, b, far2)].sum(), far[i, j][density.least_forest(i, j, far[i, j])].sum(), rel_tol=1e-9)
    df.unpersist()


def test_dense_cells_far_and_near(spark):
    """Dense cells whose points are just within or just beyond the radius."""
    eps = 1.0
    left = np.stack([np.linspace(0, 0.1, 30), np.zeros(30)], axis=1)
    for gap, clusters in ((1.0, 1), (1.0001, 2)):
        xy = np.concatenate([left, left + [0.1 + gap, 0]])
        got = density.dbscan(frame(spark, xy), "id", ["x", "y"], eps, 5)
        assert got.select("cluster").distinct().count() == clusters


def test_components_of_a_long_chain(spark):
    nodes = spark.range(200).withColumnRenamed("id", "node")
    edges = spark.range(199).where("id <> 120").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r["node"]: r["component"] for r in density.connected_components(nodes, edges).collect()}
    assert all(c == (0 if n <= 120 else 121) for n, c in got.items()) and len(got) == 200


def test_neighbour_counts_and_pairs(spark, salted):
    xy = points(5)
    gaps = ((xy[:, None] - xy[None]) ** 2).sum(axis=2) <= 0.05 ** 2
    df = frame(spark, xy)
    got = distance.with_neighbour_counts(df, ["x", "y"], 0.05).toPandas().sort_values("id")
    assert list(got["neighbours"]) == list(gaps.sum(axis=1))
    assert distance.neighbour_pairs(df, "id", ["x", "y"], 0.05).count() == (gaps.sum() - len(xy)) // 2


def test_no_nested_loop_join(spark):
    df = distance.neighbour_counts(frame(spark, points(6)), ["x", "y"], 0.05)
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [1, 3, 40])
def test_kth_distance(spark, k):
    xy = points(7, 100)
    got = frame(spark, xy).join(distance.kth_distance(frame(spark, xy), ["x", "y"], k), ["x", "y"]).toPandas().sort_values("id")
    gaps = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2))
    np.testing.assert_allclose(got["kth"], np.sort(gaps, axis=1)[:, k], atol=1e-12)


def test_label_check(spark, salted):
    xy = points(9, 120)
    labels = np.random.default_rng(1).integers(0, 3, 120)
    df = frame(spark, xy).withColumn("label", F.get(F.array(*[F.lit(int(v)) for v in labels]), F.col("id").cast("int")))
    got = distance.check_labels(df, ["x", "y"], "label", 0.06).toPandas().sort_values("id")["status"].tolist()
    gaps = ((xy[:, None] - xy[None]) ** 2).sum(axis=2)
    for i, status in enumerate(got):
        near = labels[(gaps[i] <= 0.06 ** 2) & (gaps[i] > 0)]
        if len(near) == 0:
            assert status == distance.ALONE
        else:
            assert status == (distance.CONSISTENT if np.bincount(near).argmax() == labels[i] else distance.SUSPICIOUS)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(21)
    x = np.concatenate([rng.normal(c, 0.3, (60, 3)) for c in (0.0, 2.0, 4.0)])
    df = spark.createDataFrame([(i, [float(v) for v in row], i // 60) for i, row in enumerate(x)], "id long, v array<double>, c int")
    return x, df.persist()


def test_projection_is_orthonormal_and_centred(blobs):
    x, df = blobs
    p = cluster.fit_projection(df, "v")
    np.testing.assert_allclose(np.array(p.axes) @ np.array(p.axes).T, np.eye(2), atol=1e-9)
    got = p.transform(df, "v").orderBy("id").select("pc1", "pc2").toPandas().to_numpy()
    c = x - x.mean(axis=0)
    want = c @ np.linalg.svd(c, full_matrices=False)[2][:2].T
    np.testing.assert_allclose(np.abs(got), np.abs(want), atol=1e-8)
    assert sum(p.explained) <= 1 + 1e-9


def test_seeded_kmeans_inertia_never_rises(blobs):
    x, df = blobs
    fit = cluster.fit_seeded(df, "v", [[0.0] * 3, [1.0] * 3, [5.0] * 3])
    assert all(b <= a + 1e-9 for a, b in zip(fit.inertia, fit.inertia[1:]))
    sizes = [r["count"] for r in fit.transform(df, "v").groupBy("cluster").count().collect()]
    assert sorted(sizes) == [60, 60, 60]


def test_fuzzy_objective_never_rises_and_memberships_sum_to_one(blobs):
    _, df = blobs
    fit = cluster.fit_fuzzy(df, "v", cluster.hashed_start(df, "v", "id", 3), max_iter=25)
    assert all(b <= a + 1e-9 for a, b in zip(fit.objective, fit.objective[1:]))
    row = fit.transform(df, "v").agg(F.max(F.abs(F.aggregate("membership", F.lit(-1.0), lambda a, x: a + x)))).first()
    assert row[0] < 1e-9 and fit.partition[-1] > 0.8


def unit_rows(blobs):
    x, df = blobs
    unit = (x - x.min(axis=0)) / (x.max(axis=0) - x.min(axis=0))
    return unit, df.sparkSession.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(unit)], "id long, v array<double>")


@pytest.mark.parametrize("width", [1 / 8, 0.03])
def test_potentials_equal_direct_sums_over_cells(blobs, width):
    unit, scaled = unit_rows(blobs)
    last = int(np.ceil(1 / width - 1e-9)) - 1
    cells, weight = np.unique(np.minimum(np.floor(unit / width), last), axis=0, return_counts=True)
    gaps = ((cells[:, None] - cells[None]) ** 2).sum(axis=2) * width * width
    want = {tuple(int(v) for v in c): p for c, p in zip(cells, np.exp(-16 * gaps) @ weight)}
    got = {(r["i0"], r["i1"], r["i2"]): r["potential"] for r in cluster.potentials(cluster.lattice(scaled, "v", 3, width), 3, width).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_subtractive_centres_are_the_blobs(blobs):
    unit, scaled = unit_rows(blobs)
    centres, strength = cluster.subtractive_centres(scaled, "v", 3, 1 / 32)
    assert len(centres) == 3 and strength == sorted(strength, reverse=True)
    near = ((unit[:, None] - np.array(centres)[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert sorted(np.bincount(near)) == [60, 60, 60]
    assert len(cluster.subtractive_centres(scaled, "v", 3, 1 / 32, max_centres=2)[0]) == 2
    assert cluster.subtractive_centres(scaled.limit(0), "v", 3, 1 / 32) == ([], [])


def test_every_row_has_a_cell(spark):
    rng = np.random.default_rng(0)
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rng.random((4000, 3)))], "id long, v array<double>")
    placed = cluster.with_cells(rows, "v", 3, 1 / 16)
    found = cluster.potentials(cluster.lattice(rows, "v", 3, 1 / 16), 3, 1 / 16)
    assert placed.join(found, ["i0", "i1", "i2"]).count() == 4000
    assert found.agg(F.sum("weight")).first()[0] == 4000


def test_silhouette_leaves_noise_out(blobs):
    _, df = blobs
    far = df.withColumn("v", F.transform("v", lambda x: x + 1e7))
    plain = cluster.squared_silhouette(df, "v", "c").orderBy("id").toPandas()["silhouette"]
    np.testing.assert_allclose(cluster.squared_silhouette(far, "v", "c").orderBy("id").toPandas()["silhouette"], plain, atol=1e-6)
    noisy = df.unionByName(df.limit(5).withColumns({"id": F.col("id") + 1000, "c": F.lit(-1).cast(df.schema["c"].dataType)}))
    got = cluster.squared_silhouette(noisy, "v", "c").orderBy("id").toPandas()["silhouette"]
    np.testing.assert_allclose(got[:180], plain)
    assert got[180:].isna().all()


def test_separation_and_silhouette(blobs):
    x, df = blobs
    labels = np.arange(180) // 60
    got = cluster.separation(df, "v", "c").first()
    means = np.array([x[labels == k].mean(axis=0) for k in range(3)])
    s = np.array([np.linalg.norm(x[labels == k] - means[k], axis=1).mean() for k in range(3)])
    db = np.mean([max((s[i] + s[j]) / np.linalg.norm(means[i] - means[j]) for j in range(3) if j != i) for i in range(3)])
    within = sum(((x[labels == k] - means[k]) ** 2).sum() for k in range(3))
    between = sum(60 * ((means[k] - x.mean(axis=0)) ** 2).sum() for k in range(3))
    assert got["davies_bouldin"] == pytest.approx(db)
    assert got["calinski_harabasz"] == pytest.approx((between / 2) / (within / 177))
    assert cluster.separation(df.where("c = 0"), "v", "c").first()["davies_bouldin"] is None
    d2 = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    want = []
    for i in range(180):
        a = d2[i][labels == labels[i]].sum() / 59
        b = min(d2[i][labels == k].mean() for k in range(3) if k != labels[i])
        want.append((b - a) / max(a, b))
    sil = cluster.squared_silhouette(df, "v", "c").orderBy("id").toPandas()["silhouette"]
    np.testing.assert_allclose(sil, want)


def test_votes_and_naming(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", "b", "b"), ("c", "b", "c")], "x string, y string, z string")
    assert [r[0] for r in df.select(audit.majority_vote(["x", "y", "z"])).collect()] == ["a", "b", "c"]
    rows = [(k, float(k)) for k in (0, 1, 2, 3, -1) for _ in range(2)]
    df = spark.createDataFrame(rows, "cluster int, score double")
    named = {r["cluster"]: r["level"] for r in audit.named_rows(df, "cluster", "score", "level").collect()}
    assert named == {0: "bajo", 1: "medio", 2: "alto", 3: "medio", -1: "medio"}
    few = {r["cluster"]: r["level"] for r in audit.cluster_names(df.where("cluster in (1, 3)"), "cluster", "score").collect()}
    assert few == {1: "bajo", 3: "medio"}


def test_budgeted_correction(spark, path):
    rows = [(i, "bajo", "alto" if i % 2 else "bajo", float(i % 10) / 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, label string, vote string, gap double")
    out = audit.correct_labels(df, "id", "label", "vote", "gap").toPandas()
    candidates = sorted(((-g, i) for i, l, v, g in rows if l != v))[:30]
    assert set(out.loc[out["label"] != out["corrected"], "id"]) == {i for _, i in candidates}
    assert len(out) == 100
    counts = {r["label"]: (r["original"], r["corrected"]) for r in audit.before_after(
        audit.correct_labels(df, "id", "label", "vote", "gap"), "label", "corrected").collect()}
    assert counts == {"bajo": (100, 70), "alto": (0, 30)}
    none = audit.correct_labels(df, "id", "label", "vote", "gap", votes=F.lit(2), min_votes=3)
    assert none.where("label <> corrected").count() == 0


def test_models_fitted_together_equal_separate_loops(spark, monkeypatch):
    monkeypatch.setattr(cluster, "BLOCK_ROWS", 100)
    monkeypatch.setattr(cluster, "BLOCK_CELLS", 64)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.4, size=(70, 3)) for c in ((0, 0, 0), (3, 0, 1), (0, 4, 2))])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(999, None)], "id long, v array<double>").repartition(4)
    starts = [[list(map(float, x[i])) for i in own] for own in ((0, 1), (0, 80, 150), (3, 4, 5, 6, 7))]
    for (got, cost), start in zip(cluster.fit_together(df, "v", starts), starts):
        want = cluster.fit_seeded(df.where("v IS NOT NULL"), "v", start, 300)
        np.testing.assert_allclose(got, want.centres, atol=1e-9)
        near = ((x[:, None] - np.array(got)[None]) ** 2).sum(axis=2).min(axis=1)
        assert math.isclose(cost, near.sum(), rel_tol=1e-9)
    # A centre far from all rows keeps its place.
    moved = cluster.advance(cluster.packed_vectors(df, "v"), {0: [[0.0, 0.0, 0.0], [1e6, 0.0, 0.0]]})
    assert moved[0][0][1] == [1e6, 0.0, 0.0] and moved[0][2] == [210, 0]


def test_elbow_finds_three_groups(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.2, size=(40, 2)) for c in ((0, 0), (5, 0), (0, 5))])
    df = spark.createDataFrame([([float(v) for v in r],) for r in x], "v array<double>")
    rows = {r["k"]: r for r in cluster.elbow(df, "v", range(1, 6), range(1, 4)).collect()}
    assert rows[1]["silhouette"] is None and math.isclose(rows[1]["inertia"], ((x - x.mean(axis=0)) ** 2).sum(), rel_tol=1e-6)
    assert max(range(2, 6), key=lambda k: rows[k]["silhouette"]) == 3
    assert all(rows[k + 1]["inertia"] < rows[k]["inertia"] for k in range(1, 5))


def test_kth_distance_of_a_far_point_and_copies(spark):
    rng = np.random.default_rng(7)
    xy = np.concatenate([rng.random((300, 2)), [[50.0, 50.0]], np.repeat([[0.5, 0.5]], 9, axis=0)])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in xy], "x double, y double").repartition(5)
    got = {(r["x"], r["y"]): r["kth"] for r in distance.kth_distance(df, ["x", "y"], 4).collect()}
    d = np.sort(np.linalg.norm(xy[:, None] - xy[None], axis=2), axis=1)[:, 4]
    for i, (a, b) in enumerate(xy):
        assert math.isclose(got[float(a), float(b)], d[i], abs_tol=1e-12)


def plain_dbscan(x, eps, min_pts):
    """Labels by the smallest core key; border points join the adjacent cluster with the smallest key."""
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= min_pts
    label = np.full(len(x), -1)
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            todo, label[i] = [i], i
            while todo:
                for j in np.flatnonzero(near[todo.pop()] & core):
                    if label[j] < 0:
                        label[j] = i
                        todo.append(j)
    for i in np.flatnonzero(~core):
        own = label[near[i] & core]
        label[i] = own.min() if len(own) else -1
    return label, core


def test_one_forest_gives_the_clusters_of_every_radius(spark, monkeypatch):
    monkeypatch.setattr(density, "_HELD_EDGES", 50)
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(c, 0.35, size=(45, 5)) for c in (0.0, 1.6, 4.0)] + [rng.uniform(-2, 6, size=(25, 5)), np.zeros((6, 5))]).round(2)
    dims = [f"d{i}" for i in range(5)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{d} double" for d in dims)).repartition(5)
    reach = density.reachability(df, "id", dims, 1.5, 5)
    assert reach.forest.count() < 5 * len(x)
    for eps in (0.5, 0.8, 1.1, 1.5):
        label, core = plain_dbscan(x, eps, 5)
        got = {r["id"]: (r["cluster"], r["is_core"]) for r in reach.clusters(eps).collect()}
        assert got == {i: (label[i], core[i]) for i in range(len(x))}
        one = {r["id"]: (r["cluster"], r["is_core"]) for r in density.dbscan(df, "id", dims, eps, 5).collect()}
        assert one == got


def test_least_forest_has_least_weight():
    rng = np.random.default_rng(1)
    for n, m in ((1, 0), (5, 4), (40, 300), (60, 50)):
        a, b, w = rng.integers(0, n, m), rng.integers(0, n, m), rng.integers(0, 9, m).astype(float)
        keep = density.least_forest(a, b, w)
        parent = list(range(n))

        def root(v):
            while parent[v] != v:
                v = parent[v]
            return v

        total = count = 0
        for i in np.argsort(w, kind="stable"):
            if root(a[i]) != root(b[i]):
                parent[root(a[i])] = root(b[i])
                total, count = total + w[i], count + 1
        assert len(keep) == count and w[keep].sum() == total
        joined = list(range(n))
        parent, seen = joined, set()
        for i in keep:
            assert root(a[i]) != root(b[i])
            parent[root(a[i])] = root(b[i])


@pytest.mark.parametrize("dims,ra", [(1, 0.5), (2, 0.3), (3, 0.5), (3, 2.0)])
def test_row_potentials_equal_all_pairs(spark, dims, ra):
    from lumentab.operators import potential

    rng = np.random.default_rng(dims)
    x = np.concatenate([rng.random((300, 3)), np.repeat([[0.0, 1.0, 0.5]], 4, axis=0), [[1.0, 1.0, 1.0]]])
    rows = [(i, [float(v) for v in r], "x") for i, r in enumerate(x)] + [(900, None, "n"), (901, [0.5, None, 0.5] if dims > 1 else [None], "n")]
    df = spark.createDataFrame(rows, "id long, v array<double>, potential_ string").repartition(4)
    got = {r["id"]: r["potential"] for r in potential.row_potentials(df, "v", dims, ra).collect()}
    own = x[:, :dims]
    want = np.exp(-4 / ra ** 2 * ((own[:, None] - own[None]) ** 2).sum(axis=2)).sum(axis=1)
    np.testing.assert_allclose([got[i] for i in range(len(x))], want, atol=1e-9)
    assert got[900] is None and got[901] is None
    assert potential.row_potentials(df.limit(0), "v", dims, ra).count() == 0


def test_subtractive_rows_follow_the_rules(blobs):
    unit, scaled = unit_rows(blobs)
    centres, strength = cluster.subtractive_rows(scaled, "v", 3)
    p = np.exp(-16 * ((unit[:, None] - unit[None]) ** 2).sum(axis=2)).sum(axis=1)
    want, found = [], []
    first = p.max()
    while True:
        gap = np.array([min([np.linalg.norm(u - c) for c in want], default=math.inf) for u in unit])
        may = np.flatnonzero((p / first >= 0.5) | ((p / first > 0.15) & (gap / 0.5 + p / first >= 1)))
        if not len(may) or p[may].max() <= 0:
            break
        i = may[np.argmax(p[may])]
        want.append(unit[i])
        found.append(p[i])
        p = np.maximum(p - p[i] * np.exp(-4 / 0.75 ** 2 * ((unit - unit[i]) ** 2).sum(axis=1)), 0)
        p[i] = 0
    np.testing.assert_allclose(centres, want, atol=1e-9)
    np.testing.assert_allclose(strength, found, rtol=1e-7)


@pytest.mark.parametrize("limit", [density.HUB_EDGES, 3])
def test_components_with_hubs(spark, monkeypatch, limit):
    monkeypatch.setattr(density, "HUB_EDGES", limit)
    rng = np.random.default_rng(8)
    edges = [(500, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 160)] + [(700, 701), (59, 100)]
    edges += [tuple(map(int, rng.integers(200, 300, 2))) for _ in range(60)]
    parent = list(range(800))

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    nodes = spark.range(800).withColumnRenamed("id", "node")
    got = density.connected_components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {v: root(v) for v in range(800)}


@pytest.mark.parametrize("hot", [20_000, 1])
def test_neighbours_in_the_plane_are_counted_without_pairs(spark, monkeypatch, hot):
    def no_pairs(*_):
        raise AssertionError("near pairs were made")

    monkeypatch.setattr(distance, "HOT_CELL", hot)
    monkeypatch.setattr(distance, "cell_join", no_pairs)
    rng = np.random.default_rng(5)
    made = [(float(a), float(b), (None, "p", "q")[i % 3]) for i, (a, b) in enumerate(zip(rng.normal(size=300), np.round(rng.normal(size=300), 1)))]
    made += made[:20] + [(0.0, 0.0, "p"), (0.1, 0.0, "q"), (None, 0.0, "p"), (float("nan"), 0.0, "q")]
    df = spark.createDataFrame(made, "x double, y double, l string")
    whole = [r for r in made if r[0] is not None and r[0] == r[0]]
    eps = 0.1

    def gap(a, b):
        return (a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1])

    counts = {(r["x"], r["y"]): (r["copies"], r["neighbours"]) for r in distance.neighbour_counts(df, ["x", "y"], eps).collect()}
    assert counts == {a[:2]: (sum(b[:2] == a[:2] for b in whole), sum(gap(a, b) <= eps * eps for b in whole)) for a in whole}
    told = {(r["x"], r["y"]): r["majority"] for r in distance.neighbour_labels(df, ["x", "y"], "l", eps).collect()}
    want = {}
    for a in whole:
        votes = [b[2] for b in whole if 0 < gap(a, b) <= eps * eps]
        if votes:
            want[a[:2]] = min(set(votes), key=lambda v: (-votes.count(v), v is not None, v or ""))
    assert told == want


def test_steps_of_kmeans_compute_no_costs(spark, monkeypatch):
    asked, advance = [], cluster.advance

    def told(blocks, models, costs=True):
        out = advance(blocks, models, costs)
        asked.append((costs, {m: (c, n) for m, (c, _, n) in out.items()}, advance(blocks, models), [cost for _, cost, _ in out.values()]))
        return out

    monkeypatch.setattr(cluster, "advance", told)
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([([float(v) for v in r],) for r in rng.normal(size=(120, 4))], "v array<double>")
    head = [[float(v) for v in r] for r in rng.normal(size=(3, 4))]
    (centres, cost), = cluster.fit_together(df, "v", [head])
    assert [a[0] for a in asked[:-1]] == [False] * (len(asked) - 1) and asked[-1][0] and cost > 0
    for _, moved, whole, costs in asked[:-1]:
        assert moved == {m: (c, n) for m, (c, _, n) in whole.items()} and costs == [0.0]
