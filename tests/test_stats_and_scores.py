import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumentab.operators import evaluate, panel, profile, split, stats


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    n = 500
    x = rng.integers(0, 40, n).astype(float)
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "y": x * 2 + rng.normal(0, 10, n), "z": rng.normal(size=n),
                        "label": rng.integers(0, 2, n)})
    return pdf, spark.createDataFrame(pdf).persist()


def test_correlations(frame, path):
    pdf, df = frame
    cols = ["x", "y", "z"]
    for pairs, method in ((stats.pearson_pairs(df, cols), "pearson"), (stats.spearman_pairs(df, cols), "spearman")):
        for r in pairs.collect():
            want = pdf[r["a"]].corr(pdf[r["b"]]) if method == "pearson" else pdf[r["a"]].rank().corr(pdf[r["b"]].rank())
            assert r["r"] == pytest.approx(want)


def test_mann_whitney_against_definition(frame, path):
    pdf, df = frame
    got = stats.mann_whitney(df, ["x"], "label").first()
    a, b = pdf.loc[pdf["label"] == 0, "x"].to_numpy(), pdf.loc[pdf["label"] == 1, "x"].to_numpy()
    u = (a[:, None] > b[None]).sum() + 0.5 * (a[:, None] == b[None]).sum()
    n0, n1, n = len(a), len(b), len(pdf)
    ties = sum(t ** 3 - t for t in pdf["x"].value_counts())
    sd = math.sqrt(n0 * n1 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = math.copysign(max(abs(u - n0 * n1 / 2) - 0.5, 0), u - n0 * n1 / 2) / sd
    assert got["u"] == pytest.approx(u)
    assert got["z"] == pytest.approx(z)
    assert got["p"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=2e-7)


def test_variance_inflation_against_regressions(frame):
    pdf, df = frame
    cols = ["x", "y", "z"]
    for r in stats.variance_inflation(df, cols).collect():
        others = pdf[[c for c in cols if c != r["column"]]].to_numpy()
        target = pdf[r["column"]].to_numpy()
        rest = target - others @ np.linalg.lstsq(others, target, rcond=None)[0]
        assert r["vif"] == pytest.approx((target @ target) / (rest @ rest))


def test_auc_and_average_precision(frame, path):
    pdf, df = frame
    got = evaluate.ranking_metrics(df, "label", "x").first()
    pos, neg = pdf.loc[pdf["label"] == 1, "x"].to_numpy(), pdf.loc[pdf["label"] == 0, "x"].to_numpy()
    auc = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    ap, seen = 0.0, 0
    for s in sorted(set(pdf["x"]), reverse=True):
        called, hits = (pdf["x"] >= s).sum(), (pos >= s).sum()
        ap += (hits - seen) / len(pos) * hits / called
        seen = hits
    assert got["auc"] == pytest.approx(auc)
    assert got["ap"] == pytest.approx(ap)


def test_auc_is_null_with_one_class(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, p double")
    assert evaluate.ranking_metrics(df, "y", "p").first()["auc"] is None


def test_class_report_zero_division(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "y string, p string")
    rows = {r["class"]: r for r in evaluate.class_report(df, "y", "p").collect()}
    assert rows["a"]["precision"] == 0.5 and rows["a"]["recall"] == 0.5
    assert rows["b"]["recall"] == 0 and rows["c"]["f1"] == 0 and rows["c"]["support"] == 1
    assert evaluate.summary_report(evaluate.class_report(df, "y", "p")).first()["accuracy"] == pytest.approx(1 / 3)


def test_threshold_choice_prefers_recall_then_f1_then_height(spark):
    rows = [(0.2, 0.99, 0.4, 0.5), (0.3, 0.96, 0.5, 0.7), (0.4, 0.96, 0.5, 0.7), (0.5, 0.5, 0.9, 0.9)]
    sweep = spark.createDataFrame(rows, "threshold double, recall double, precision double, f1 double")
    assert evaluate.best_threshold(sweep).first()["threshold"] == 0.4


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.5)], "y int, p double")
    got = df.agg(evaluate.probability_metrics("y", "p")["log_loss"]).first()[0]
    assert got == pytest.approx((-math.log(evaluate.PROBABILITY_EPS) + math.log(2)) / 2)


def test_describe(frame, path):
    pdf, df = frame
    got = profile.describe(df, ["x", "y"]).toPandas().set_index("column")
    want = pdf[["x", "y"]].describe().T
    for mine, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("max", "max")):
        np.testing.assert_allclose(got[mine].astype(float), want[theirs])


def test_box_stats_and_histogram(frame, path):
    pdf, df = frame
    box = profile.box_stats(df, "y").first()
    q1, q3 = pdf["y"].quantile([0.25, 0.75])
    inside = pdf["y"].between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert box["whisker_low"] == pytest.approx(pdf.loc[inside, "y"].min()) and box["outliers"] == (~inside).sum()
    counts = {r["bin"]: r["n"] for r in profile.histogram(df, "x", 10).collect()}
    want, _ = np.histogram(pdf["x"], bins=10)
    assert [counts.get(i, 0) for i in range(10)] == list(want)


def test_splits_are_exact_and_disjoint(frame):
    _, df = frame
    out = split.stratified_split(df, "id", "label", (0.7, 0.15, 0.15), ("train", "valid", "test"))
    assert out.count() == 500 and out.select("id").distinct().count() == 500
    sizes = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    for label in (0, 1):
        n = sum(v for (k, _), v in sizes.items() if k == label)
        assert sizes[(label, "train")] == math.floor(0.7 * n)
        assert sizes[(label, "train")] + sizes[(label, "valid")] == math.floor(0.85 * n)


def test_split_keeps_rows_of_a_missing_class(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)], "id int, c string")
    assert split.hash_split(df, "id", (0.5, 0.5), ("l", "r"), ["c"]).groupBy("split").count().where("count = 20").count() == 2


def test_split_falls_back_without_strata(spark):
    df = spark.createDataFrame([(i, "rare" if i == 0 else "a") for i in range(20)], "id int, c string")
    out = split.stratified_split(df, "id", "c", (0.8, 0.2), ("train", "test"))
    assert out.where("split = 'train'").count() == 16


def test_folds_are_balanced(frame):
    _, df = frame
    sizes = [r["count"] for r in split.fold_numbers(df, "id", 5, "label").groupBy("label", "fold").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 20


@pytest.mark.parametrize("n", [2, 7, 499, 500, 900])
def test_strided_sample(frame, n, path):
    _, df = frame
    got = sorted(r["id"] for r in split.strided_sample(df, "id", n).collect())
    want = sorted(set(i * 499 // (n - 1) for i in range(n)))
    assert got == want


def test_returns_carry_over_periods(spark):
    rows = [(u, f"2024-{m:02d}-{d:02d} 00:00:00", float(10 * m + d)) for u in (1, 2) for m in (1, 3, 4) for d in (1, 9)]
    df = spark.createDataFrame(rows, "u int, t string, p double").withColumn("t", F.to_timestamp("t"))
    got = panel.with_returns(df, ["u"], "t", ["p"]).toPandas().sort_values(["u", "t"])
    want = got.groupby("u")["p"].pct_change().fillna(0.0)
    np.testing.assert_allclose(got["p_ret"], want)
    np.testing.assert_allclose(got["p_logret"], np.log1p(want))


def test_returns_keep_rows_without_time_or_identifier(spark):
    rows = [(1, "2024-01-01 00:00:00", 2.0), (1, None, 4.0), (None, "2024-01-01 00:00:00", 8.0)]
    df = spark.createDataFrame(rows, "u int, t string, p double").withColumn("t", F.to_timestamp("t"))
    assert panel.with_returns(df, ["u"], "t", ["p"]).count() == 3


def test_two_period_rule(spark):
    df = spark.createDataFrame([(1, 1, -1.0), (1, 2, -2.0), (1, 3, None), (1, 4, -1.0), (1, 5, 9.0)], "u int, y int, v double")
    got = panel.two_period_rule(df, ["u"], "y", "v", [F.col("v") > 5]).orderBy("y").collect()
    assert [r["rule"] for r in got] == [0, 1, 0, 0, 1]


def test_ranking_small_panel(spark):
    rows = [("a", y, v, w, 1) for y, v, w in ((1, 1.0, 9.0), (2, None, 8.0), (3, 3.0, 7.0))]
    rows += [("b", y, v, w, 0) for y, v, w in ((1, 5.0, 1.0), (2, 6.0, 2.0))] + [("c", 1, None, 5.0, 0)]
    df = spark.createDataFrame(rows, "unit string, yr int, good double, bad double, label int")
    indicators = [panel.Indicator("good", 0.6), panel.Indicator("bad", 0.4, False)]
    got = panel.rank_units(panel.score_rows(df, "unit", indicators), "unit", "yr", "label").toPandas().set_index("unit")
    pdf = df.toPandas()
    pdf["good"] = pdf["good"].fillna(pdf.groupby("unit")["good"].transform("median"))
    pdf["good"] = pdf["good"].fillna(pdf["good"].median())
    unit = lambda s: (s - s.min()) / (s.max() - s.min())
    pdf["score"] = 0.6 * unit(pdf["good"]) + 0.4 * (1 - unit(pdf["bad"]))
    means = pdf.groupby("unit")["score"].mean()
    np.testing.assert_allclose(got["score_mean"].sort_index(), means)
    assert list(got.sort_values("ranking").index) == list(means.sort_values().index)
    assert got.loc["c", "trend"] == 0 and got.loc["a", "label_1_pct"] == 100


def test_spearman_is_pairwise_complete(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 1.0, None), (3.0, 4.0, 3.0), (4.0, 3.0, None), (5.0, 5.0, 1.0), (5.0, 7.0, 1.0)]
    pdf = pd.DataFrame(rows, columns=["a", "b", "c"])
    want = {(x, y): pdf[[x, y]].dropna().rank().corr().iloc[0, 1] for x, y in (("a", "b"), ("a", "c"), ("b", "c"))}
    got = {(r["a"], r["b"]): r["r"] for r in stats.spearman_pairs(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_small_p_values_are_exact(spark):
    rows = [(0, float(i)) for i in range(200)] + [(1, float(i + 150)) for i in range(200)]
    row = stats.mann_whitney(spark.createDataFrame(rows, "y int, x double"), ["x"], "y").first()
    assert row["p"] == pytest.approx(math.erfc(abs(row["z"]) / math.sqrt(2)), rel=1e-12) and 0 < row["p"] < 1e-20


def test_collinear_and_empty_columns_inflate_without_end(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 0.0, float(i * i % 7)) for i in range(30)], "a double, b double, z double, c double")
    got = {r["column"]: r["vif"] for r in stats.variance_inflation(df, ["a", "b", "z", "c"]).collect()}
    assert got["a"] == got["b"] == got["z"] == math.inf and got["c"] < 10


def test_density_without_spread_and_counts_outside_the_domain(spark):
    from lumentab.operators import profile

    assert [r["density"] for r in profile.density_curve(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x", [0.0, 1.0]).collect()] == [None, None]
    got = {r["v"]: (r["n"], r["share"]) for r in profile.value_counts(spark.createDataFrame([("x",), ("x",), ("z",)], "v string"), "v", ["x", "y"]).collect()}
    assert got == {"x": (2, pytest.approx(2 / 3)), "y": (0, 0.0), "z": (1, pytest.approx(1 / 3))}


def test_split_widths_change_no_result(spark, monkeypatch):
    from lumentab.operators import split

    df = spark.range(3000).withColumn("y", F.col("id") % 3)
    one = {r["id"]: r["split"] for r in split.hash_split(df, "id", (0.7, 0.3), ("a", "b"), ["y"]).collect()}
    folds = {r["id"]: r["fold"] for r in split.fold_numbers(df, "id", 5, "y").collect()}
    monkeypatch.setattr(split, "SLOT_ROWS", 1 / 16**4)
    assert split._prefix_digits(3000) > 3
    assert {r["id"]: r["split"] for r in split.hash_split(df, "id", (0.7, 0.3), ("a", "b"), ["y"]).collect()} == one
    assert {r["id"]: r["fold"] for r in split.fold_numbers(df, "id", 5, "y").collect()} == folds


def test_returns_of_one_series_over_cuts(spark, monkeypatch):
    """Without identifiers the series is cut at time quantiles; the first value of a cut follows the last of the one before."""
    import datetime as dt

    from lumentab.operators import order

    monkeypatch.setattr(order, "SMALL_ROWS", 0)
    monkeypatch.setattr(order, "SAMPLE_STEP", 1)
    rng = np.random.default_rng(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(seconds=int(rng.integers(0, 400))), float(rng.integers(1, 50))) for i in range(500)] + [(900, None, 7.0), (901, None, 9.0)]
    for kind in ("timestamp", "date", "long"):
        as_kind = {"timestamp": lambda t: t, "date": lambda t: start.date() + dt.timedelta(days=(t - start).seconds), "long": lambda t: (t - start).seconds}[kind]
        own = [(i, None if t is None else as_kind(t), p) for i, t, p in rows]
        df = spark.createDataFrame(own, f"id long, t {kind}, p double").repartition(3)
        got = {r["id"]: r["_prev"] for r in panel.previous_value(df, [], "t", "p", "_prev", ["id"]).collect()}
        line = sorted(own, key=lambda r: (r[1] is not None, r[1] or as_kind(start), r[0]))
        assert got == {b[0]: (a[2] if a else None) for a, b in zip([None, *line], line)}
