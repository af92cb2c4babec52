"""Distance joins, clustering and label auditing."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumentab.operators import audit, cluster, density, distance, potential, prepare
from lumentab.plans.registry import as_long, query, rounded, table
from lumentab.session import cut_lineage

EPS, MIN_PTS = 0.01, 5
POINTS_SQL = """p AS (SELECT o_orderkey, o_orderstatus, o_totalprice / 500000 AS x,
        date_diff('day', DATE '1995-01-01', o_orderdate::DATE) / 2400.0::DOUBLE AS y FROM orders)"""
NEAR_SQL = f"""n AS (SELECT a.o_orderkey, b.o_orderstatus AS other, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2
        FROM p a JOIN p b ON b.x BETWEEN a.x - {2 * EPS} AND a.x + {2 * EPS} AND b.y BETWEEN a.y - {2 * EPS} AND a.y + {2 * EPS}
        WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS}::DOUBLE * {EPS}::DOUBLE)"""


def order_points(spark, sf):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", (F.col("o_totalprice") / 500000).alias("x"), (days / 2400.0).alias("y"))


def vec(spark, sf):
    return table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))


def vec_dims(spark, sf, d):
    return vec(spark, sf).select("vec_id", "label", *[F.get("embedding", F.lit(i)).alias(f"x{i}") for i in range(d)])


@query("eps_pairs", f"""
    WITH {POINTS_SQL}, {NEAR_SQL} SELECT o_orderkey, COUNT(*)::BIGINT AS neighbours FROM n GROUP BY 1
""")
def eps_pairs(spark, sf):
    return distance.with_neighbour_counts(order_points(spark, sf), ["x", "y"], EPS).select("o_orderkey", "neighbours")


@query("dbscan_core", f"""
    WITH {POINTS_SQL}, {NEAR_SQL}
    SELECT o_orderkey, (COUNT(*) >= {MIN_PTS})::BIGINT AS is_core FROM n GROUP BY 1
""")
def dbscan_core(spark, sf):
    points = order_points(spark, sf)
    core = density.core_points(points, ["x", "y"], EPS, MIN_PTS)
    return points.join(core, ["x", "y"]).select("o_orderkey", F.col("is_core").cast("long").alias("is_core"))


@query("dbscan", """
    WITH RECURSIVE p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
    n AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM p a, p b
        WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.02::DOUBLE * 0.02::DOUBLE),
    core AS MATERIALIZED (SELECT a FROM n GROUP BY 1 HAVING COUNT(*) >= 4),
    e AS MATERIALIZED (SELECT a, b FROM n WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
    reach AS (SELECT a, a AS b FROM core UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
    comp AS (SELECT b AS vec_id, MIN(a) AS cluster FROM reach GROUP BY 1),
    border AS (SELECT n.a AS vec_id, MIN(c.cluster) AS cluster FROM n JOIN comp c ON c.vec_id = n.b GROUP BY 1)
    SELECT p.vec_id, COALESCE(c.cluster, b.cluster, -1)::BIGINT AS cluster, (c.cluster IS NOT NULL)::BIGINT AS is_core
    FROM p LEFT JOIN comp c USING (vec_id) LEFT JOIN border b USING (vec_id)
""")
def dbscan(spark, sf):
    out = density.dbscan(vec_dims(spark, sf, 2), "vec_id", ["x0", "x1"], 0.02, 4)
    return out.withColumn("is_core", F.col("is_core").cast("long"))


@query("dbscan_orders")
def dbscan_orders(spark, sf):
    return density.dbscan(order_points(spark, sf), "o_orderkey", ["x", "y"], EPS, MIN_PTS)


# Eight standardised dimensions, one of them with gaps, as the survey answers have them.
Z_SQL = ", ".join(f"(e{i} - AVG(e{i}) OVER ()) / stddev_pop(e{i}) OVER () AS z{i}" for i in range(8))
Z_GAP = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(8))


def standard_vectors(spark, sf):
    dims = [f"e{i}" for i in range(8)]
    rows = vec(spark, sf).select("vec_id", *[
        (F.when(F.col("vec_id") % 40 != 0, F.get("embedding", F.lit(0))) if i == 0 else F.get("embedding", F.lit(i))).alias(d) for i, d in enumerate(dims)])
    return prepare.fit_standard(rows, dims).transform(rows), dims


@query("dbscan_8d", f"""
    WITH RECURSIVE e AS (SELECT vec_id, CASE WHEN vec_id % 40 <> 0 THEN embedding[1]::DOUBLE END AS e0, {", ".join(f"embedding[{i + 1}]::DOUBLE AS e{i}" for i in range(1, 8))} FROM embeddings),
    p AS MATERIALIZED (SELECT vec_id, {Z_SQL} FROM e),
    n AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM p a, p b WHERE {Z_GAP} <= 2.0::DOUBLE * 2.0::DOUBLE),
    core AS MATERIALIZED (SELECT a FROM n GROUP BY 1 HAVING COUNT(*) >= 4),
    e2 AS MATERIALIZED (SELECT a, b FROM n WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
    reach AS (SELECT a, a AS b FROM core UNION SELECT least(r.a, e2.a), e2.b FROM reach r JOIN e2 ON r.b = e2.a),
    comp AS (SELECT b AS vec_id, MIN(a) AS cluster FROM reach GROUP BY 1),
    border AS (SELECT n.a AS vec_id, MIN(c.cluster) AS cluster FROM n JOIN comp c ON c.vec_id = n.b GROUP BY 1)
    SELECT p.vec_id, COALESCE(c.cluster, b.cluster, -1)::BIGINT AS cluster, (c.cluster IS NOT NULL)::BIGINT AS is_core
    FROM p LEFT JOIN comp c USING (vec_id) LEFT JOIN border b USING (vec_id)
""")
def dbscan_8d(spark, sf):
    rows, dims = standard_vectors(spark, sf)
    return density.dbscan(rows, "vec_id", dims, 2.0, 4).withColumn("is_core", F.col("is_core").cast("long"))


def _sweep_sql(name, eps):
    """The clusters c<name> (vec_id, cluster) at one radius, from the pairs d (a, b, d2)."""
    return f"""n{name} AS MATERIALIZED (SELECT a, b FROM d WHERE d2 <= {eps}::DOUBLE * {eps}::DOUBLE),
    core{name} AS MATERIALIZED (SELECT a FROM n{name} GROUP BY 1 HAVING COUNT(*) >= 5),
    e{name} AS MATERIALIZED (SELECT a, b FROM n{name} WHERE a IN (SELECT a FROM core{name}) AND b IN (SELECT a FROM core{name})),
    reach{name} AS (SELECT a, a AS b FROM core{name} UNION SELECT least(r.a, e.a), e.b FROM reach{name} r JOIN e{name} e ON r.b = e.a),
    comp{name} AS (SELECT b AS vec_id, MIN(a) AS cluster FROM reach{name} GROUP BY 1),
    border{name} AS (SELECT n.a AS vec_id, MIN(c.cluster) AS cluster FROM n{name} n JOIN comp{name} c ON c.vec_id = n.b GROUP BY 1),
    c{name} AS MATERIALIZED (SELECT p.vec_id, COALESCE(c.cluster, b.cluster, -1)::BIGINT AS cluster, {eps}::DOUBLE AS eps
        FROM p LEFT JOIN comp{name} c USING (vec_id) LEFT JOIN border{name} b USING (vec_id)),
    ok{name} AS (SELECT COUNT(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) >= 2 AND AVG((cluster = -1)::DOUBLE) < 0.4 AS ok FROM c{name})"""


@query("dbscan_sweep", f"""
    WITH RECURSIVE e AS (SELECT vec_id, CASE WHEN vec_id % 40 <> 0 THEN embedding[1]::DOUBLE END AS e0, {", ".join(f"embedding[{i + 1}]::DOUBLE AS e{i}" for i in range(1, 8))} FROM embeddings),
    p AS MATERIALIZED (SELECT vec_id, {Z_SQL} FROM e),
    d AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, {Z_GAP} AS d2 FROM p a, p b WHERE {Z_GAP} <= 2.5::DOUBLE * 2.5::DOUBLE),
    {_sweep_sql(1, 1.5)}, {_sweep_sql(2, 2.0)}, {_sweep_sql(3, 2.5)}
    SELECT * FROM c1 WHERE (SELECT ok FROM ok1) UNION ALL SELECT * FROM c2 WHERE NOT (SELECT ok FROM ok1) AND (SELECT ok FROM ok2)
    UNION ALL SELECT * FROM c3 WHERE NOT (SELECT ok FROM ok1) AND NOT (SELECT ok FROM ok2)
""")
def dbscan_sweep(spark, sf):
    rows, dims = standard_vectors(spark, sf)
    out, eps = density.dbscan_sweep(rows, "vec_id", dims, (1.5, 2.0, 2.5), 5)
    return out.select("vec_id", "cluster", F.lit(eps).alias("eps"))


@query("knn_kdist", """
    WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
    r AS (SELECT a.vec_id, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) AS d2,
                 row_number() OVER (PARTITION BY a.vec_id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS k
          FROM p a JOIN p b ON a.vec_id <> b.vec_id)
    SELECT vec_id, ROUND(sqrt(d2), 9) AS kth FROM r WHERE k = 3
""")
def knn_kdist(spark, sf):
    points = vec_dims(spark, sf, 3)
    found = distance.kth_distance(points, ["x0", "x1", "x2"], 3).drop("copies")
    return rounded(points.join(found, ["x0", "x1", "x2"]).select("vec_id", "kth"), 9)


CENTRE_SQL = """v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    m AS (SELECT label AS c, i, AVG(x) AS m FROM v GROUP BY 1, 2),
    g AS (SELECT vec_id, c, SUM((x - m) * (x - m)) AS d2 FROM v JOIN m USING (i) GROUP BY 1, 2)"""


def label_centres(spark, sf, rows=None):
    from lumentab.operators.cluster import _cluster_sums

    sums = _cluster_sums(vec(spark, sf) if rows is None else rows, "embedding", "label")
    return [[float(x) for x in mean] for _, mean in sums.values()]


@query("assign_nearest", f"""
    WITH {CENTRE_SQL} SELECT vec_id, arg_min(c, d2)::BIGINT AS cluster, ROUND(MIN(d2), 9) AS d2 FROM g GROUP BY 1
""")
def assign_nearest(spark, sf):
    near = distance.nearest_centre(F.col("embedding"), label_centres(spark, sf))
    return as_long(rounded(vec(spark, sf).select("vec_id", near.alias("near")).select("vec_id", "near.cluster", "near.d2"), 9))


@query("lloyd_step", f"""
    WITH {CENTRE_SQL}, a AS (SELECT vec_id, arg_min(c, d2) AS cluster FROM g GROUP BY 1)
    SELECT cluster::BIGINT AS cluster, (i - 1)::BIGINT AS dim, ROUND(AVG(x), 9) + 0.0 AS centre FROM v JOIN a USING (vec_id) GROUP BY 1, 2
""")
def lloyd_step(spark, sf):
    centres, _ = cluster.lloyd_step(vec(spark, sf), "embedding", label_centres(spark, sf))
    return rounded(_centre_table(spark, centres), 9)


def _centre_table(spark, centres):
    return spark.createDataFrame(
        [(i, j, x) for i, c in enumerate(centres) for j, x in enumerate(c)], "cluster long, dim long, centre double")


@query("fcm_step", f"""
    WITH {CENTRE_SQL}, h AS (SELECT vec_id, c, 1 / greatest(d2, 1e-12) AS w FROM g),
    u AS (SELECT vec_id, c, pow(w / SUM(w) OVER (PARTITION BY vec_id), 2) AS um FROM h)
    SELECT c::BIGINT AS cluster, (i - 1)::BIGINT AS dim, ROUND(SUM(um * x) / SUM(um), 9) + 0.0 AS centre
    FROM u JOIN v USING (vec_id) GROUP BY 1, 2
""")
def fcm_step(spark, sf):
    step = cluster.fuzzy_step(vec(spark, sf), "embedding", label_centres(spark, sf))
    return rounded(_centre_table(spark, step["centres"]), 9)


@query("fcm")
def fcm(spark, sf):
    rows = vec(spark, sf).persist()
    fit = cluster.fit_fuzzy(rows, "embedding", cluster.hashed_start(rows, "embedding", "vec_id", 3))
    return rounded(fit.transform(rows, "embedding").select("vec_id", "cluster", "certainty"), 6)


@query("fcm_partition_sweep")
def fcm_partition_sweep(spark, sf):
    rows = vec(spark, sf).persist()
    return rounded(cluster.partition_sweep(rows, "embedding", "vec_id"), 6)


UNIT_SQL = "s AS (SELECT vec_id, " + ", ".join(
    f"(embedding[{i}]::DOUBLE - (SELECT MIN(embedding[{i}]::DOUBLE) FROM embeddings)) / "
    f"(SELECT MAX(embedding[{i}]::DOUBLE) - MIN(embedding[{i}]::DOUBLE) FROM embeddings) AS x{i - 1}" for i in (1, 2, 3)
) + " FROM embeddings)"


def unit_vectors(spark, sf, d=3):
    dims = [f"x{i}" for i in range(d)]
    rows = vec_dims(spark, sf, d)
    return prepare.fit_minmax(rows, dims).transform(rows).select("vec_id", F.array(*dims).alias("point"))


# Lattice width of the registered subtractive jobs.
CELL = 1 / 32
CELL_SQL = f"""{UNIT_SQL}, k AS (SELECT vec_id, """ + ", ".join(f"least(floor(x{i} / {CELL}), 31)::INT AS i{i}" for i in range(3)) + """ FROM s),
    w AS (SELECT i0, i1, i2, COUNT(*)::DOUBLE AS weight FROM k GROUP BY ALL),
    p AS (SELECT a.i0, a.i1, a.i2, SUM(b.weight * exp(-16 * ((a.i0 - b.i0) ** 2 + (a.i1 - b.i1) ** 2 + (a.i2 - b.i2) ** 2) / 1024.0::DOUBLE)) AS potential
          FROM w a, w b GROUP BY ALL)"""


@query("potential_init", f"WITH {CELL_SQL} SELECT vec_id, ROUND(potential, 6) AS potential FROM k JOIN p USING (i0, i1, i2)")
def potential_init(spark, sf):
    rows = cluster.with_cells(unit_vectors(spark, sf), "point", 3, CELL)
    found = cluster.potentials(cluster.lattice(rows, "point", 3, CELL), 3, CELL).drop("weight")
    return rounded(rows.join(found, ["i0", "i1", "i2"]).select("vec_id", "potential"), 6)


@query("potential_rows", f"""
    WITH {UNIT_SQL} SELECT a.vec_id, ROUND(SUM(exp(-16 * ((a.x0 - b.x0) ** 2 + (a.x1 - b.x1) ** 2 + (a.x2 - b.x2) ** 2))), 6) AS potential
    FROM s a, s b GROUP BY 1
""")
def potential_rows(spark, sf):
    return rounded(potential.row_potentials(unit_vectors(spark, sf), "point", 3, cluster.RADIUS).select("vec_id", "potential"), 6)


# The two first centres: the strongest row, and the strongest after its part is taken off.
@query("subtractive_first", f"""
    WITH {UNIT_SQL}, p AS MATERIALIZED (SELECT a.vec_id, a.x0, a.x1, a.x2, SUM(exp(-16 * ((a.x0 - b.x0) ** 2 + (a.x1 - b.x1) ** 2 + (a.x2 - b.x2) ** 2))) AS potential
        FROM s a, s b GROUP BY ALL),
    c AS (SELECT * FROM p ORDER BY potential DESC, x0, x1, x2 LIMIT 1),
    d AS (SELECT p.*, greatest(p.potential - c.potential * exp(-4 / 0.5625::DOUBLE * ((p.x0 - c.x0) ** 2 + (p.x1 - c.x1) ** 2 + (p.x2 - c.x2) ** 2)), 0) AS left_,
                 sqrt((p.x0 - c.x0) ** 2 + (p.x1 - c.x1) ** 2 + (p.x2 - c.x2) ** 2) AS gap, c.potential AS top FROM p, c),
    e AS (SELECT * FROM d WHERE left_ / top >= 0.5 OR (left_ / top > 0.15 AND gap / 0.5 + left_ / top >= 1) ORDER BY left_ DESC, x0, x1, x2 LIMIT 1)
    SELECT 0::BIGINT AS cluster, ROUND(x0, 6) AS x0, ROUND(x1, 6) AS x1, ROUND(x2, 6) AS x2, ROUND(potential, 5) AS potential FROM c
    UNION ALL SELECT 1::BIGINT, ROUND(x0, 6), ROUND(x1, 6), ROUND(x2, 6), ROUND(left_, 5) FROM e
""")
def subtractive_first(spark, sf):
    return rounded(_centres_found(spark, *cluster.subtractive_rows(unit_vectors(spark, sf), "point", 3, max_centres=2)), 5, "potential")


def _centres_found(spark, centres, strength):
    rows = [(i, *c, s) for i, (c, s) in enumerate(zip(centres, strength))]
    return rounded(spark.createDataFrame(rows, "cluster long, x0 double, x1 double, x2 double, potential double"), 6, "x0", "x1", "x2")


@query("subtractive")
def subtractive(spark, sf):
    return rounded(_centres_found(spark, *cluster.subtractive_rows(unit_vectors(spark, sf), "point", 3, max_centres=10)), 6)


@query("kmeans_seeded")
def kmeans_seeded(spark, sf):
    dims = ["x0", "x1", "x2"]
    rows = vec_dims(spark, sf, 3)
    unit, standard = prepare.fit_minmax(rows, dims), prepare.fit_standard(rows, dims)
    centres, _ = cluster.subtractive_rows(unit.transform(rows).select(F.array(*dims).alias("point")), "point", 3, max_centres=10)
    scaled = standard.transform(rows).select("vec_id", F.array(*dims).alias("point"))
    # Centres go back to raw values and on to z, in which the rows are clustered.
    seeds = [standard.point(unit.restored_point(c)) for c in centres]
    if len(seeds) < 2:
        seeds = cluster.fit_kmeans(scaled, "point", 3)[0].centres
    fit = cluster.fit_seeded(scaled, "point", seeds, max_iter=500)
    return fit.transform(scaled, "point").select("vec_id", "cluster")


def _starts(rows, ks):
    """The first k vectors by id, for each k."""
    head = [[float(x) for x in r["embedding"]] for r in rows.orderBy("vec_id").limit(max(ks)).collect()]
    return {k: head[:k] for k in ks}


# Two models of three and five centres, one step on.
@query("kmeans_step_together", """
    WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    r AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n FROM embeddings),
    c AS (SELECT k, n - 1 AS c, i, x AS m FROM v JOIN r USING (vec_id), (VALUES (3), (5)) AS s(k) WHERE n <= k),
    g AS (SELECT k, vec_id, c, SUM((x - m) * (x - m)) AS d2 FROM v JOIN c USING (i) GROUP BY ALL),
    a AS (SELECT k, vec_id, arg_min(c, (d2, c)) AS c, MIN(d2) AS d2 FROM g GROUP BY ALL),
    t AS (SELECT k, c, COUNT(*)::BIGINT AS n FROM a GROUP BY ALL),
    i AS (SELECT k, SUM(d2) AS cost FROM a GROUP BY ALL)
    SELECT k::BIGINT AS k, c::BIGINT AS cluster, (i - 1)::BIGINT AS dim, ROUND(AVG(x), 9) + 0.0 AS centre, ANY_VALUE(t.n) AS n, ROUND(ANY_VALUE(cost), 6) AS inertia
    FROM v JOIN a USING (vec_id) JOIN t USING (k, c) JOIN i USING (k) GROUP BY ALL
""")
def kmeans_step_together(spark, sf):
    rows = vec(spark, sf)
    moved = cluster.advance(cluster.packed_vectors(rows, "embedding"), _starts(rows, (3, 5)))
    out = [(k, c, d, x, n[c], cost) for k, (centres, cost, n) in moved.items() for c, centre in enumerate(centres) for d, x in enumerate(centre)]
    return rounded(rounded(spark.createDataFrame(out, "k long, cluster long, dim long, centre double, n long, inertia double"), 9, "centre"), 6, "inertia")


@query("kmeans_elbow")
def kmeans_elbow(spark, sf):
    return rounded(cluster.elbow(vec(spark, sf), "embedding", range(1, 11), seeds=range(1, 11)), 6)


@query("pca_2d")
def pca_2d(spark, sf):
    rows = vec(spark, sf)
    return rounded(cluster.fit_projection(rows, "embedding").transform(rows, "embedding").select("vec_id", "pc1", "pc2"), 6)


@query("pca_pair", f"""
    WITH {POINTS_SQL}, s AS (SELECT AVG(x) AS mx, AVG(y) AS my, 0.5::DOUBLE * atan2(2 * covar_samp(x, y), var_samp(x) - var_samp(y)) AS t FROM p),
    a AS (SELECT mx, my, cos(t) * CASE WHEN abs(cos(t)) >= abs(sin(t)) THEN sign(cos(t)) ELSE sign(sin(t)) END AS ax,
                 sin(t) * CASE WHEN abs(cos(t)) >= abs(sin(t)) THEN sign(cos(t)) ELSE sign(sin(t)) END AS ay,
                 -sin(t) * CASE WHEN abs(sin(t)) >= abs(cos(t)) THEN sign(-sin(t)) ELSE sign(cos(t)) END AS bx,
                 cos(t) * CASE WHEN abs(sin(t)) >= abs(cos(t)) THEN sign(-sin(t)) ELSE sign(cos(t)) END AS "by" FROM s)
    SELECT o_orderkey, ROUND((x - mx) * ax + (y - my) * ay, 6) + 0.0 AS pc1, ROUND((x - mx) * bx + (y - my) * "by", 6) + 0.0 AS pc2 FROM p, a
""")
def pca_pair(spark, sf):
    rows = order_points(spark, sf).withColumn("v", F.array("x", "y"))
    return rounded(cluster.fit_projection(rows, "v").transform(rows, "v").select("o_orderkey", "pc1", "pc2"), 6)


# Projection fitted on the fitting rows (keys that 5 does not divide) and applied to all; centres of the two groups in the plane.
@query("pca_centres", f"""
    WITH {POINTS_SQL}, f AS (SELECT * FROM p WHERE o_orderkey % 5 <> 0),
    s AS (SELECT AVG(x) AS mx, AVG(y) AS my, 0.5::DOUBLE * atan2(2 * covar_samp(x, y), var_samp(x) - var_samp(y)) AS t,
                 (var_samp(x) + var_samp(y)) / 2.0::DOUBLE AS h, sqrt(pow((var_samp(x) - var_samp(y)) / 2.0::DOUBLE, 2) + pow(covar_samp(x, y), 2)) AS r FROM f),
    a AS (SELECT mx, my, (h + r) / (2 * h) AS e1, (h - r) / (2 * h) AS e2, cos(t) * CASE WHEN abs(cos(t)) >= abs(sin(t)) THEN sign(cos(t)) ELSE sign(sin(t)) END AS ax,
                 sin(t) * CASE WHEN abs(cos(t)) >= abs(sin(t)) THEN sign(cos(t)) ELSE sign(sin(t)) END AS ay,
                 -sin(t) * CASE WHEN abs(sin(t)) >= abs(cos(t)) THEN sign(-sin(t)) ELSE sign(cos(t)) END AS bx,
                 cos(t) * CASE WHEN abs(sin(t)) >= abs(cos(t)) THEN sign(-sin(t)) ELSE sign(cos(t)) END AS "by" FROM s),
    k AS (SELECT p.*, (o_orderkey % 3)::BIGINT AS cluster FROM p)
    SELECT cluster, COUNT(*)::BIGINT AS n, ROUND(AVG((x - mx) * ax + (y - my) * ay), 6) + 0.0 AS pc1, ROUND(AVG((x - mx) * bx + (y - my) * "by"), 6) + 0.0 AS pc2,
           ROUND(ANY_VALUE(e1), 6) AS explained1, ROUND(ANY_VALUE(e2), 6) AS explained2 FROM k, a GROUP BY 1
""")
def pca_centres(spark, sf):
    rows = order_points(spark, sf).select("o_orderkey", F.array("x", "y").alias("v"), (F.col("o_orderkey") % 3).alias("cluster"))
    plane = cluster.fit_projection(rows.where("o_orderkey % 5 <> 0"), "v")
    return rounded(cluster.centres_in_plane(plane, rows, "v", "cluster"), 6)


@query("db_ch_index", f"""
    WITH {CENTRE_SQL}, own AS (SELECT e.label AS c, g.d2 FROM embeddings e JOIN g ON g.vec_id = e.vec_id AND g.c = e.label),
    s AS (SELECT c, AVG(sqrt(d2)) AS s, SUM(d2) AS w, COUNT(*) AS n FROM own GROUP BY 1),
    pairs AS (SELECT a.c AS a, b.c AS b, sqrt(SUM((a.m - b.m) * (a.m - b.m))) AS d FROM m a JOIN m b ON a.i = b.i AND a.c <> b.c GROUP BY 1, 2),
    worst AS (SELECT a, MAX((x.s + y.s) / d) AS r FROM pairs JOIN s x ON x.c = a JOIN s y ON y.c = b GROUP BY 1),
    o AS (SELECT i, AVG(x) AS o FROM v GROUP BY 1),
    bt AS (SELECT SUM(n * (m - o) * (m - o)) AS b FROM m JOIN o USING (i) JOIN s USING (c))
    SELECT (SELECT COUNT(*) FROM s)::BIGINT AS n_clusters, ROUND((SELECT AVG(r) FROM worst), 6) AS davies_bouldin,
           ROUND(((SELECT b FROM bt) / ((SELECT COUNT(*) FROM s) - 1)) / ((SELECT SUM(w) FROM s) / ((SELECT SUM(n) FROM s) - (SELECT COUNT(*) FROM s)))::DOUBLE, 6) AS calinski_harabasz
""")
def db_ch_index(spark, sf):
    return rounded(cluster.separation(vec(spark, sf), "embedding", "label"), 6)


@query("silhouette_squared", """
    WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    d AS (SELECT a.vec_id AS a, b.vec_id AS b, SUM((a.x - b.x) * (a.x - b.x)) AS d2 FROM v a JOIN v b ON a.i = b.i GROUP BY 1, 2),
    t AS (SELECT d.a, ea.label AS own, eb.label AS c, SUM(d2) AS total, COUNT(*) AS n
          FROM d JOIN embeddings ea ON ea.vec_id = d.a JOIN embeddings eb ON eb.vec_id = d.b GROUP BY 1, 2, 3),
    ab AS (SELECT a AS vec_id, MAX(CASE WHEN own = c THEN total / (n - 1) END) AS a, MIN(CASE WHEN own <> c THEN total / n END) AS b FROM t GROUP BY 1)
    SELECT vec_id, ROUND((b - a) / greatest(a, b), 6) + 0.0 AS silhouette FROM ab
""")
def silhouette_squared(spark, sf):
    return rounded(cluster.squared_silhouette(vec(spark, sf), "embedding", "label").select("vec_id", "silhouette"), 6)


@query("cluster_metrics")
def cluster_metrics(spark, sf):
    rows = vec(spark, sf).select("vec_id", "embedding").persist()
    model, _ = cluster.fit_kmeans(rows, "embedding", 3, seeds=range(1, 21))
    labelled = model.transform(rows, "embedding")
    score = cluster.squared_silhouette(labelled, "embedding", "cluster").agg(F.avg("silhouette").alias("silhouette"))
    return rounded(cluster.separation(labelled, "embedding", "cluster").withColumn("silhouette", score.scalar()), 6)


@query("cluster_profile", " UNION ALL ".join(f"""
    SELECT label::BIGINT AS label, 'x{i}' AS "column", COUNT(*)::BIGINT AS n, ROUND(AVG(z), 6) + 0.0 AS mean, ROUND(stddev_pop(z), 6) AS sd
    FROM (SELECT label, (embedding[{i + 1}]::DOUBLE - AVG(embedding[{i + 1}]::DOUBLE) OVER ()) / stddev_pop(embedding[{i + 1}]::DOUBLE) OVER () AS z
          FROM embeddings) GROUP BY 1""" for i in range(4)))
def cluster_profile(spark, sf):
    dims = [f"x{i}" for i in range(4)]
    rows = vec_dims(spark, sf, 4)
    return as_long(rounded(cluster.cluster_profile(prepare.fit_standard(rows, dims).transform(rows), "label", dims), 6))


@query("cluster_composition", """
    SELECT cluster, kind, n, ROUND(n / SUM(n) OVER (PARTITION BY cluster)::DOUBLE, 6) AS share
    FROM (SELECT label::BIGINT AS cluster, (vec_id % 3)::BIGINT AS kind, COUNT(*)::BIGINT AS n FROM embeddings GROUP BY 1, 2)
""")
def cluster_composition(spark, sf):
    rows = vec(spark, sf).select(F.col("label").cast("long").alias("cluster"), (F.col("vec_id") % 3).alias("kind"))
    return rounded(cluster.composition(rows, "cluster", "kind"), 6)


LABEL_SQL = f"""WITH {POINTS_SQL}, {NEAR_SQL},
    c AS (SELECT o_orderkey, other, COUNT(*) AS k FROM n WHERE d2 > 0 GROUP BY 1, 2),
    m AS (SELECT o_orderkey, other AS majority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY k DESC, other) AS r FROM c) WHERE r = 1),
    t AS (SELECT p.o_orderkey, p.o_orderstatus, CASE WHEN majority IS NULL THEN 'sin_vecinos' WHEN majority = o_orderstatus THEN 'consistente'
          ELSE 'sospechoso' END AS status FROM p LEFT JOIN m USING (o_orderkey))"""


@query("label_neighbours", LABEL_SQL + "SELECT * FROM t")
def label_neighbours(spark, sf):
    checked = distance.check_labels(order_points(spark, sf), ["x", "y"], "o_orderstatus", EPS)
    return checked.select("o_orderkey", "o_orderstatus", "status")


@query("label_check_summary", LABEL_SQL + """
    SELECT o_orderstatus, COUNT(*)::BIGINT AS n, count(*) FILTER (status = 'consistente')::BIGINT AS consistent,
           count(*) FILTER (status = 'sospechoso')::BIGINT AS suspicious, count(*) FILTER (status = 'sin_vecinos')::BIGINT AS alone,
           ROUND(count(*) FILTER (status = 'consistente') * 100.0::DOUBLE / COUNT(*), 6) AS consistent_pct,
           ROUND(count(*) FILTER (status = 'sospechoso') * 100.0::DOUBLE / COUNT(*), 6) AS suspicious_pct,
           ROUND(count(*) FILTER (status = 'sin_vecinos') * 100.0::DOUBLE / COUNT(*), 6) AS alone_pct FROM t GROUP BY 1
""")
def label_check_summary(spark, sf):
    checked = distance.check_labels(order_points(spark, sf), ["x", "y"], "o_orderstatus", EPS)
    return rounded(distance.check_summary(checked, "o_orderstatus"), 6)


# Eight answers from 1 to 5 per order, derived from the key and the price.
ANSWERS = [f"a{i}" for i in range(8)]
ANSWER_SQL = "q AS (SELECT o_orderkey, " + ", ".join(
    f"(o_orderkey * {i + 3} + floor(o_totalprice)::BIGINT // {2 * i + 1}) % 5 + 1 AS a{i}" for i in range(8)) + " FROM orders)"
SCORE_SQL = f"""{ANSWER_SQL},
    z AS (SELECT *, ((a4 + a5 + a6 + a7) / 4.0::DOUBLE + ((6 - a0) + (6 - a1) + (6 - a2) + (6 - a3)) / 4.0::DOUBLE) / 2 AS score FROM q),
    l AS (SELECT *, CASE WHEN score <= 2.33 THEN 'bajo' WHEN score <= 3.67 THEN 'medio' ELSE 'alto' END AS label,
                 CASE a0 WHEN 1 THEN 'bajo' WHEN 2 THEN 'medio' ELSE 'alto' END AS v1, CASE WHEN a1 < 3 THEN 'bajo' ELSE 'medio' END AS v2,
                 CASE WHEN a2 = 5 THEN 'alto' WHEN a2 = 1 THEN 'bajo' ELSE 'medio' END AS v3 FROM z),
    w AS (SELECT *, CASE WHEN v1 = v2 OR v1 = v3 THEN v1 WHEN v2 = v3 THEN v2 ELSE v1 END AS vote,
                 abs(score - CASE label WHEN 'bajo' THEN 1.5::DOUBLE WHEN 'medio' THEN 3.0::DOUBLE ELSE 4.5::DOUBLE END) AS gap FROM l)"""


def answers(spark, sf):
    price = F.floor("o_totalprice")
    a = {f"a{i}": (F.col("o_orderkey") * (i + 3) + F.floor(price / (2 * i + 1))) % 5 + 1 for i in range(8)}
    rows = table(spark, sf, "orders").select("o_orderkey", *[e.alias(n) for n, e in a.items()])
    return rows.withColumn("score", audit.composite_score(ANSWERS[4:], ANSWERS[:4]))


def voted(spark, sf):
    return answers(spark, sf).select(
        "o_orderkey", "score", audit.level_of("score").alias("label"),
        F.when(F.col("a0") == 1, "bajo").when(F.col("a0") == 2, "medio").otherwise("alto").alias("v1"),
        F.when(F.col("a1") < 3, "bajo").otherwise("medio").alias("v2"),
        F.when(F.col("a2") == 5, "alto").when(F.col("a2") == 1, "bajo").otherwise("medio").alias("v3"),
    ).withColumns({"vote": audit.majority_vote(["v1", "v2", "v3"]), "gap": audit.class_gap("score", "label")})


@query("score_label", f"WITH {SCORE_SQL} SELECT o_orderkey, ROUND(score, 3) AS score, label FROM l")
def score_label(spark, sf):
    return rounded(answers(spark, sf).select("o_orderkey", "score", audit.level_of("score").alias("label")), 3)


@query("cluster_naming", f"""
    WITH {SCORE_SQL}, k AS (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN -1 ELSE a0 END AS cluster FROM l),
    m AS (SELECT cluster, AVG(score) AS s, row_number() OVER (ORDER BY AVG(score), cluster) AS r FROM k WHERE cluster <> -1 GROUP BY 1)
    SELECT o_orderkey, cluster::BIGINT AS cluster, COALESCE(CASE r WHEN 1 THEN 'bajo' WHEN 2 THEN 'medio' WHEN 3 THEN 'alto' END, 'medio') AS level
    FROM k LEFT JOIN m USING (cluster)
""")
def cluster_naming(spark, sf):
    rows = answers(spark, sf).withColumn("cluster", F.when(F.col("o_orderkey") % 10 == 0, -1).otherwise(F.col("a0")))
    return audit.named_rows(rows, "cluster", "score", "level").select("o_orderkey", "cluster", "level")


@query("majority_vote", f"""
    WITH {SCORE_SQL} SELECT o_orderkey, vote, CASE WHEN v1 = v2 AND v2 = v3 THEN 3 WHEN v1 = v2 OR v1 = v3 OR v2 = v3 THEN 2 ELSE 1 END::BIGINT AS agreeing FROM w
""")
def majority_vote(spark, sf):
    return as_long(voted(spark, sf).select("o_orderkey", "vote", audit.vote_size(["v1", "v2", "v3"]).alias("agreeing")))


@query("inconsistency_rate", f"""
    WITH {SCORE_SQL} SELECT ROUND(AVG((label <> v1)::DOUBLE) * 100, 6) AS inconsistent_pct FROM w
""")
def inconsistency_rate(spark, sf):
    return rounded(voted(spark, sf).agg(audit.inconsistency_pct("label", "v1").alias("inconsistent_pct")), 6)


CORRECT_SQL = f"""WITH {SCORE_SQL},
    r AS (SELECT o_orderkey, row_number() OVER (ORDER BY gap DESC, o_orderkey) AS place FROM w WHERE label <> vote),
    f AS (SELECT o_orderkey, label, CASE WHEN place <= floor(0.3::DOUBLE * (SELECT COUNT(*) FROM w)) THEN vote ELSE label END AS corrected
          FROM w LEFT JOIN r USING (o_orderkey))"""


@query("label_correct", CORRECT_SQL + "SELECT * FROM f")
def label_correct(spark, sf):
    return audit.correct_labels(cut_lineage(voted(spark, sf)), "o_orderkey", "label", "vote", "gap").select("o_orderkey", "label", "corrected")


@query("label_correct_counts", CORRECT_SQL + """
    SELECT label, SUM(o)::BIGINT AS original, SUM(c)::BIGINT AS corrected
    FROM (SELECT label, 1 AS o, 0 AS c FROM f UNION ALL SELECT corrected, 0, 1 FROM f) GROUP BY 1
""")
def label_correct_counts(spark, sf):
    fixed = audit.correct_labels(cut_lineage(voted(spark, sf)), "o_orderkey", "label", "vote", "gap")
    return audit.before_after(fixed, "label", "corrected")
