import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumentab.operators import order


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "id": np.arange(3000),
        "g": np.where(np.arange(3000) % 3 == 0, "hot", np.array(["a", "b", "c", "d"])[np.arange(3000) % 4]),
        "x": np.round(rng.lognormal(size=3000), 2),
        "y": rng.integers(0, 5, 3000).astype(float),
    })
    pdf.loc[::17, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    return pdf, df


def test_quantiles_match_linear_interpolation(values, path):
    pdf, df = values
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    found = order.fit_quantiles(df, ["x", "y"], probs)
    for c in ("x", "y"):
        assert found[c] == pytest.approx(list(pdf[c].quantile(probs)))


def test_group_quantiles(values, path):
    pdf, df = values
    got = {r["g"]: (r["n"], r["q0"]) for r in order.quantiles(df, ["x"], (0.5,), ["g"]).collect()}
    want = pdf.groupby("g")["x"]
    assert set(got) == set(pdf["g"])
    for g, (n, q) in got.items():
        assert n == want.count()[g]
        assert q == pytest.approx(want.median()[g])


def test_average_ranks(values, path):
    pdf, df = values
    got = order.average_ranks(df, "x").toPandas().set_index("x")["rank"]
    want = pdf.dropna().assign(r=lambda d: d["x"].rank()).groupby("x")["r"].first()
    pd.testing.assert_series_equal(got.sort_index(), want, check_names=False)


def test_running_totals_descending_by_group(values, path):
    pdf, df = values
    got = order.running_totals(df, "y", {"n": F.count(F.lit(1))}, ["g"], descending=True).toPandas()
    for row in got.itertuples():
        part = pdf[pdf["g"] == row.g]
        assert row.n_before == (part["y"] > row.y).sum()
        assert row.n_total == len(part)


def test_dense_index_numbers_and_texts(values, path):
    _, df = values
    got = order.dense_index(df.select("id"), "id").collect()
    assert all(r["id"] == r["idx"] for r in got)
    texts = df.select(F.md5(F.col("id").cast("string")).alias("t"))
    got = sorted((r["t"], r["idx"]) for r in order.dense_index(texts, "t").collect())
    assert [i for _, i in got] == list(range(3000))


def test_modes_take_smallest_on_ties(spark):
    df = spark.createDataFrame([(2.0, "b"), (1.0, "a"), (1.0, "b"), (2.0, "a"), (None, None)], "x double, t string")
    assert {r["column"]: r["mode"] for r in order.modes(df, ["x"]).collect()} == {"x": 1.0}
    assert order.modes(df, ["t"], dtype="string").first()["mode"] == "a"


def test_empty_and_all_null_columns(spark, path):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0)], "x double, y double")
    assert order.fit_quantiles(df, ["x", "y"], (0.5,)) == {"x": [None], "y": [1.0]}
    assert order.fit_quantiles(df.limit(0), ["y"], (0.5,)) == {"y": [None]}


def test_no_single_task_window_over_rows(values, monkeypatch):
    monkeypatch.setattr(order, "SMALL_ROWS", 0)
    monkeypatch.setattr(order, "SAMPLE_STEP", 1)
    _, df = values
    plan = order.average_ranks(df, "x")._jdf.queryExecution().executedPlan().toString()
    # The only ungrouped window runs over one row per cut.
    singles = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(singles) <= 1
