import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumentab.operators import evaluate, models, split


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    n = 240
    x = rng.normal(size=(n, 3))
    pdf = pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})
    pdf["y"] = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(0, 0.5, n)
    pdf["label"] = (pdf["y"] > 0).astype(float)
    pdf["level"] = np.digitize(pdf["y"], [-1.5, 1.5]).astype(float)
    df = split.hash_split(models.assemble(spark.createDataFrame(pdf), ["a", "b", "c"]), "id", (0.7, 0.3), ("train", "test")).persist()
    return pdf, x, df


def test_ridge_equals_closed_form(rows):
    pdf, x, df = rows
    model = models.linear(df, "y", 7.0, "ridge")
    centred, y = x - x.mean(axis=0), pdf["y"] - pdf["y"].mean()
    want = np.linalg.solve(centred.T @ centred + 7.0 * np.eye(3), centred.T @ y)
    np.testing.assert_allclose(model.coefficients.toArray(), want, rtol=1e-6)


def test_logistic_satisfies_its_optimality_condition(rows):
    pdf, x, df = rows
    c = 0.5
    model = models.logistic(df, "label", c)
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    np.testing.assert_allclose(w + c * x.T @ (p - pdf["label"]), 0, atol=1e-2)


def test_lasso_is_sparse(rows):
    _, _, df = rows
    assert models.linear(df, "y", 2.5, "lasso").coefficients.numNonzeros() < 3


def test_ordinal_prediction_rounds_and_clips(spark):
    df = spark.createDataFrame([(-0.7,), (0.5,), (1.5,), (9.0,)], "p double")
    assert [r[0] for r in df.select(models.ordinal_prediction("p", 3)).collect()] == [0.0, 0.0, 2.0, 2.0]


def test_cross_validation_uses_given_folds(rows):
    from pyspark.ml.classification import LogisticRegression

    _, _, df = rows
    folded = split.fold_numbers(df, "id", 3, "label")
    settings = [{"regParam": 1 / (c * 240)} for c in models.LOGISTIC_C]
    _, table = models.cross_validate(folded, LogisticRegression(labelCol="label"), settings, models.accuracy("label"), 3, "fold")
    assert table.count() == 4 and table.where("score between 0.5 and 1").count() == 4


def test_draws_are_repeatable():
    draws = models.log_uniform(50)
    assert draws == models.log_uniform(50) and all(1e-3 <= d <= 1e3 for d in draws)
    assert len(models.grid(**models.BOOSTING_GRID)) == 243 and len(models.grid(**models.FOREST_GRID)) == 18


def test_importance(rows):
    _, _, df = rows
    table = models.importance_table(models.forest(df, "label", 10, 3), ["a", "b", "c"], df).collect()
    assert table[0]["feature"] == "a" and math.isclose(sum(r["importance"] for r in table), 1, rel_tol=1e-6)


def test_isotonic_is_monotone(rows):
    _, _, df = rows
    scored = models.scored_rows(models.logistic(df, "label"), df, ["id"], "label").withColumn("y", F.col("y_true").cast("double"))
    out = models.isotonic(scored, "y", "prob").transform(scored).orderBy("prob").toPandas()["calibrated"]
    assert out.is_monotonic_increasing


def test_label_versions(rows):
    _, _, df = rows
    table = models.compare_label_versions(
        df.withColumn("other", 1 - F.col("label")), "split", {"original": "label", "other": "other"}, {"tree": models.tree}).collect()
    assert {r["version"]: r["f1_change"] for r in table}["original"] == 0


def test_search_queries_run_their_whole_grids(spark, monkeypatch):
    """The real searches, on a short table and with few rounds; every point of the grids has its row."""
    from lumentab.plans import PLANS

    monkeypatch.setitem(models.BOOSTING_GRID, "rounds", (1, 2, 3))
    monkeypatch.setitem(models.FOREST_GRID, "numTrees", (1, 2))
    found = PLANS["ml_holdout_grid"](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 243 and sum(r["best"] for r in found) == 1
    assert {tuple(r[n] for n in models.BOOSTING_GRID) for r in found} == {tuple(map(float, s.values())) for s in models.grid(**models.BOOSTING_GRID)}
    got = PLANS["ml_grid_cv"](spark, "/root/testdata/sf0.001").collect()
    points = sorted(tuple(map(float, s.values())) for s in models.grid(**models.FOREST_GRID))
    for job in ("forest", "boosting"):
        assert sorted((r.numTrees, r.maxDepth, r.minInstancesPerNode) for r in got if r.job == job) == points
    assert sum(r.job == "logistic" for r in got) == 4 and len(got) == 40


def test_fits_run_no_more_tasks_than_there_are_slots(spark, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 10)
    rows = spark.range(1000, numPartitions=40)
    slots = spark.sparkContext.defaultParallelism
    assert models.dealt(rows).rdd.getNumPartitions() == slots
    monkeypatch.setattr(models, "MOST_TASK_ROWS", 50)
    assert models.dealt(rows).rdd.getNumPartitions() == 20
    assert models.dealt(rows).count() == 1000
