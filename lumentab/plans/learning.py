"""Spark ML jobs over the driver tables."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lumentab.operators import boosting, evaluate as ev, models, split
from lumentab.plans.registry import as_long, query, rounded, table

FEATURES = ("n_orders", "price", "closed", "first_year")
PARTS = ((0.7, 0.15, 0.15), ("train", "valid", "test"))


def risk_rows(spark, sf):
    """One row per ordering customer: order features and a low-balance label, split 70/15/15."""
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"), F.avg("o_totalprice").alias("price"),
        F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("closed"),
        F.year(F.min("o_orderdate")).cast("double").alias("first_year"))
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", (F.col("c_acctbal") < 3000).cast("double").alias("label"),
        (F.col("c_custkey") % 3).cast("double").alias("level"))
    rows = o.join(c, "c_custkey").withColumn("price", F.col("price") / 100000)
    return split.hash_split(rows, "c_custkey", *PARTS, by=["label"])


def ready(spark, sf):
    return models.assemble(risk_rows(spark, sf), FEATURES).persist()


def embedded(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return split.hash_split(rows, "vec_id", *PARTS).persist()


def part(df, name):
    return df.where(F.col("split") == name)


@query("ml_logreg_multi")
def ml_logreg_multi(spark, sf):
    rows = embedded(spark, sf)
    model = models.logistic(part(rows, "train"), "label", 1.0, multinomial=True)
    return rounded(ev.class_report(model.transform(part(rows, "test")), "label", "prediction"), 6)


@query("ml_logreg_bin")
def ml_logreg_bin(spark, sf):
    rows = ready(spark, sf)
    out = None
    for penalty in ("l2", "l1"):
        model = models.logistic(part(rows, "train"), "label", 1.0, penalty)
        scored = models.scored_rows(model, rows, ["c_custkey", "split"], "label")
        metrics = ev.metrics_by_split(scored, "split", "y_true", "prob", 0.5).withColumn("penalty", F.lit(penalty))
        out = metrics if out is None else out.unionByName(metrics)
    return rounded(out, 6)


@query("ml_ridge_lasso")
def ml_ridge_lasso(spark, sf):
    rows = ready(spark, sf)
    out = None
    for penalty, alpha in (("ridge", 10.0), ("lasso", 0.001)):
        model = models.linear(part(rows, "train"), "c_acctbal", alpha, penalty)
        metrics = model.transform(part(rows, "test")).agg(
            *[e.alias(n) for n, e in ev.regression_metrics("c_acctbal", "prediction").items()]).withColumn("penalty", F.lit(penalty))
        out = metrics if out is None else out.unionByName(metrics)
    return rounded(out, 6)


# One feature: the fits have a closed form.
RISK_SQL = """o AS (SELECT o_custkey, AVG(o_totalprice) / 100000 AS price FROM orders GROUP BY 1),
    r AS (SELECT c_custkey, c_acctbal AS y, (c_custkey % 3)::DOUBLE AS level, (c_acctbal < 3000)::INT AS label, price AS x FROM o JOIN customer ON o_custkey = c_custkey)"""


@query("ridge_lasso_one", f"""
    WITH {RISK_SQL}, s AS (SELECT COUNT(*) AS n, AVG(x) AS mx, AVG(y) AS my, covar_pop(x, y) AS xy, var_pop(x) AS xx FROM r),
    b AS (SELECT 'ridge' AS penalty, xy * n / (xx * n + 10) AS slope FROM s UNION ALL
          SELECT 'lasso', sign(xy) * greatest(abs(xy) - 5, 0) / xx FROM s)
    SELECT penalty, ROUND(slope, 3) + 0.0 AS slope, ROUND(my - slope * mx, 3) + 0.0 AS intercept FROM b, s
""")
def ridge_lasso_one(spark, sf):
    rows = models.assemble(risk_rows(spark, sf), ["price"]).persist()
    fits = [(p, models.linear(rows, "c_acctbal", a, p)) for p, a in (("ridge", 10.0), ("lasso", 5.0))]
    out = [(p, float(m.coefficients[0]), float(m.intercept)) for p, m in fits]
    rows.unpersist()
    return rounded(spark.createDataFrame(out, "penalty string, slope double, intercept double"), 3)


@query("ols_ordinal_one", f"""
    WITH {RISK_SQL}, f AS (SELECT regr_slope(level, x) AS b, regr_intercept(level, x) AS a FROM r),
    p AS (SELECT level, greatest(0, least(2, round_even(a + b * x, 0))) AS class FROM r, f)
    SELECT class::BIGINT AS class, COUNT(*)::BIGINT AS n, count(*) FILTER (class = level)::BIGINT AS hits FROM p GROUP BY 1
""")
def ols_ordinal_one(spark, sf):
    rows = models.assemble(risk_rows(spark, sf), ["price"]).persist()
    told = models.linear_classes(rows, "level").transform(rows).select("level", F.col("prediction").cast("long").alias("class"))
    return told.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("class") == F.col("level")).alias("hits"))


# Isotonic values are the largest of the least means of all stretches around a row.
@query("isotonic_one", f"""
    WITH {RISK_SQL}, v AS (SELECT x, label, row_number() OVER (ORDER BY x) AS i, SUM(label) OVER (ORDER BY x) AS c FROM r WHERE c_custkey % 7 = 0),
    m AS (SELECT a.i AS j, b.i AS k, (b.c - a.c + a.label) / (b.i - a.i + 1)::DOUBLE AS mean FROM v a JOIN v b ON a.i <= b.i),
    t AS (SELECT v.i, m.j, MIN(m.mean) AS least FROM v JOIN m ON m.j <= v.i AND m.k >= v.i GROUP BY ALL)
    SELECT ROUND(x, 9) AS price, ROUND(MAX(least), 6) AS calibrated FROM t JOIN v USING (i) GROUP BY x
""")
def isotonic_one(spark, sf):
    rows = risk_rows(spark, sf).where("c_custkey % 7 = 0").select("label", "price").persist()
    out = models.isotonic(rows, "label", "price").transform(rows)
    return rounded(rounded(out.select("price", "calibrated"), 9, "price"), 6, "calibrated")


@query("ml_ols_ordinal")
def ml_ols_ordinal(spark, sf):
    rows = ready(spark, sf)
    model = models.linear(part(rows, "train"), "level")
    predicted = model.transform(part(rows, "test")).withColumn("class", models.ordinal_prediction("prediction", 3))
    fit = ev.regression_metrics("level", "prediction")["r2"]
    summary = ev.summary_report(ev.class_report(predicted, "level", "class")).select("accuracy", "weighted_f1")
    return rounded(summary.withColumn("r2", predicted.agg(fit).scalar()), 6)


@query("ml_tree")
def ml_tree(spark, sf):
    rows = embedded(spark, sf)
    predicted = models.tree(part(rows, "train"), "label").transform(part(rows, "test"))
    return rounded(ev.summary_report(ev.class_report(predicted, "label", "prediction")), 6)


@query("ml_forest")
def ml_forest(spark, sf):
    rows = embedded(spark, sf)
    predicted = models.forest(part(rows, "train"), "label", 100, 5, 3).transform(part(rows, "test"))
    return rounded(ev.summary_report(ev.class_report(predicted, "label", "prediction")), 6)


@query("ml_gbt_multi")
def ml_gbt_multi(spark, sf):
    rows = risk_rows(spark, sf).persist()
    model = boosting.fit(part(rows, "train"), FEATURES, "level", boosting.Setting(50, None, 0.1, 0.0, 3, 3), 3)
    return rounded(ev.summary_report(ev.class_report(model.transform(part(rows, "test")), "level", "prediction")), 6)


@query("ml_gbt_bin")
def ml_gbt_bin(spark, sf):
    rows = risk_rows(spark, sf).withColumn("price", F.when(F.col("c_custkey") % 9 != 0, F.col("price"))).persist()
    model = boosting.fit(part(rows, "train"), FEATURES, "label", boosting.Setting(100, 15, 0.1, 0.1, 5))
    scored = model.transform(rows).select("split", F.col("label").cast("long").alias("y_true"), F.col("probability")[1].alias("prob"))
    return rounded(ev.metrics_by_split(scored, "split", "y_true", "prob", 0.5), 6)


@query("ml_grid_cv")
def ml_grid_cv(spark, sf):
    rows = split.fold_numbers(part(ready(spark, sf), "train"), "c_custkey", 3, "label").persist()
    forest = RandomForestClassifier(labelCol="label", seed=models.SEED)
    a = models.cross_validate(rows, forest, models.grid(**models.FOREST_GRID), models.accuracy("label"), 3, "fold", 8)[1]
    # The same points for boosting, whose trees are its rounds.
    points = models.grid(**models.FOREST_GRID)
    settings = [boosting.Setting(s["numTrees"], None, 0.1, 0.0, s["minInstancesPerNode"], s["maxDepth"]) for s in points]
    found = models.cross_validate_boosting(rows, FEATURES, "label", "fold", 3, settings)
    boosted = spark.createDataFrame([(i, *[float(v) for v in s.values()], x) for i, (s, x) in enumerate(zip(points, found))], a.schema)
    logistic = LogisticRegression(labelCol="label", standardization=False, maxIter=1000)
    n = rows.count() * 2 / 3  # a fold's training rows
    settings = [{"regParam": 1.0 / (c * n)} for c in models.LOGISTIC_C]
    b = models.cross_validate(rows, logistic, settings, models.accuracy("label"), 3, "fold", 8)[1]
    out = a.withColumn("job", F.lit("forest"))
    for found, job in ((boosted, "boosting"), (b, "logistic")):
        out = out.unionByName(found.withColumn("job", F.lit(job)), allowMissingColumns=True)
    rows.unpersist()
    return rounded(out, 6)


@query("ml_random_cv")
def ml_random_cv(spark, sf):
    rows = split.fold_numbers(part(ready(spark, sf), "train"), "c_custkey", 5).persist()
    n = rows.count() * 4 / 5  # a fold's training rows
    sd = rows.agg(F.stddev_pop("c_acctbal")).first()[0]
    logistic = LogisticRegression(labelCol="label", standardization=False, maxIter=1000)
    settings = [{"regParam": 1.0 / (c * n), "elasticNetParam": float(i % 2)} for i, c in enumerate(models.log_uniform(50))]
    a = models.cross_validate(rows, logistic, settings, models.accuracy("label"), 5, "fold", 8)[1].withColumn("job", F.lit("classify"))
    # Ridge and lasso draw their own alphas; the ridge term is scaled as in models.linear.
    alphas = [("ridge", x) for x in models.log_uniform(25, 1e-3, 1e3)] + [("lasso", x) for x in models.log_uniform(25, 1e-4, 1e2)]
    settings = [{"regParam": x * sd / n if kind == "ridge" else x, "elasticNetParam": float(kind == "lasso")} for kind, x in alphas]
    regression = LinearRegression(labelCol="c_acctbal", standardization=False, maxIter=1000, solver="normal")
    b = models.cross_validate(rows, regression, settings, models.r_squared("c_acctbal"), 5, "fold", 8)[1].withColumn("job", F.lit("regress"))
    rows.unpersist()
    return rounded(a.unionByName(b), 6)


@query("ml_holdout_grid")
def ml_holdout_grid(spark, sf):
    place = F.when(F.col("split") == "train", 0).when(F.col("split") == "valid", 1)
    rows = risk_rows(spark, sf).withColumn("place", place)
    settings = [boosting.Setting(**s) for s in models.grid(**models.BOOSTING_GRID)]
    return models.holdout_search(rows, FEATURES, "label", "place", settings)[0]


@query("ml_isotonic")
def ml_isotonic(spark, sf):
    rows = ready(spark, sf)
    model = models.logistic(part(rows, "train"), "label")
    scored = models.scored_rows(model, rows, ["c_custkey", "split"], "label").withColumn("label", F.col("y_true").cast("double"))
    calibrated = models.isotonic(part(scored, "valid"), "label", "prob").transform(part(scored, "test"))
    raw = calibrated.agg(*[e.alias(f"raw_{n}") for n, e in ev.probability_metrics("y_true", "prob").items()],
                         *[e.alias(f"calibrated_{n}") for n, e in ev.probability_metrics("y_true", "calibrated").items()])
    return rounded(raw, 6)


@query("ml_importance")
def ml_importance(spark, sf):
    rows = ready(spark, sf)
    return as_long(rounded(models.importance_table(models.forest(part(rows, "train"), "label", 100, 4, 3), FEATURES, rows), 6))


@query("ml_label_versions")
def ml_label_versions(spark, sf):
    rows = ready(spark, sf).withColumn(
        "corrected", F.when((F.col("n_orders") > 12) & (F.col("c_custkey") % 2 == 0), 1.0).otherwise(F.col("label")))
    learners = {"tree": models.tree, "logistic": models.logistic, "linear": models.linear_classes}
    return rounded(models.compare_label_versions(rows, "split", {"original": "label", "corrected": "corrected"}, learners), 6)


@query("ml_score_table")
def ml_score_table(spark, sf):
    rows = ready(spark, sf)
    model = models.logistic(part(rows, "train"), "label")
    return rounded(models.scored_rows(model, part(rows, "test"), ["c_custkey"], "label"), 6)


@query("probability_histogram")
def probability_histogram(spark, sf):
    from lumentab.operators import profile

    rows = ready(spark, sf)
    scored = models.scored_rows(models.logistic(part(rows, "train"), "label"), rows, ["c_custkey"], "label")
    return as_long(rounded(profile.histogram(scored, "prob", 25, ["y_true"], (0.0, 1.0)), 6))
