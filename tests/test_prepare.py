import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumentab.functions import columns as fn
from lumentab.operators import prepare, profile


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    n = 600
    pdf = pd.DataFrame({
        "id": np.arange(n), "unit": np.array(["north", "south", "east"])[np.arange(n) % 3],
        "a": rng.normal(10, 3, n), "b": rng.lognormal(0, 1, n), "flat": 4.0,
    })
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[pdf["unit"] == "east", "b"] = np.nan
    df = spark.createDataFrame(pdf)
    return pdf, df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("a", "b")}).persist()


def sorted_pandas(df):
    return df.orderBy("id").toPandas().reset_index(drop=True)


def test_group_median_fill_with_fallback(frame, path):
    pdf, df = frame
    got = sorted_pandas(prepare.fill_from_groups(df, ["unit"], ["a", "b"]))
    for c in ("a", "b"):
        want = pdf[c].fillna(pdf.groupby("unit")[c].transform("median")).fillna(pdf[c].median())
        np.testing.assert_allclose(got[c], want)


@pytest.mark.parametrize("ddof", [0, 1])
def test_standard_scaling(frame, ddof):
    pdf, df = frame
    got = sorted_pandas(prepare.fit_standard(df, ["a", "flat"], ddof).transform(df))
    np.testing.assert_allclose(got["a"], (pdf["a"] - pdf["a"].mean()) / pdf["a"].std(ddof=ddof))
    assert (got["flat"] == 0).all()


def test_robust_and_minmax_on_training_rows_only(frame, path):
    pdf, df = frame
    train = pdf[pdf["id"] < 400]
    got = sorted_pandas(prepare.fit_robust(df.where("id < 400"), ["a"]).transform(df))
    q1, q2, q3 = train["a"].quantile([0.25, 0.5, 0.75])
    np.testing.assert_allclose(got["a"], (pdf["a"] - q2) / (q3 - q1))
    model = prepare.fit_minmax(df, ["a", "flat"])
    scaled = sorted_pandas(model.transform(df))
    assert scaled["a"].min() == 0 and scaled["a"].max() == pytest.approx(1) and (scaled["flat"] == 0).all()
    np.testing.assert_allclose(sorted_pandas(model.inverse(model.transform(df)))["a"], pdf["a"])


def test_winsorize_keeps_missing_cells(frame, path):
    pdf, df = frame
    got = sorted_pandas(prepare.winsorize(df, ["a"], 0.05, 0.95))
    np.testing.assert_allclose(got["a"], pdf["a"].clip(*pdf["a"].quantile([0.05, 0.95])))


def test_iqr_filter_and_report(frame, path):
    pdf, df = frame
    q1, q3 = pdf["b"].quantile([0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    keep = pdf["b"].between(low, high) | pdf["b"].isna()
    assert prepare.iqr_filter(df, ["b", "flat"]).count() == keep.sum()
    report = {r["column"]: r for r in prepare.iqr_report(df, ["b", "flat"]).collect()}
    assert report["b"]["outliers"] == (~keep).sum() and report["flat"]["low"] == report["flat"]["high"]
    skipped = {r["column"]: r for r in prepare.iqr_report(df, ["flat"], skip_flat=True).collect()}
    assert skipped["flat"]["low"] is None and skipped["flat"]["outliers"] == 0


def test_a_column_without_spread_counts_what_differs(spark):
    df = spark.createDataFrame([(1.0,)] * 20 + [(9.0,)], "x double")
    assert prepare.iqr_report(df, ["x"]).first()["outliers"] == 1


def test_long_encodings_have_no_limit(spark):
    df = spark.createDataFrame([(i, f"v{i}", "a, b,a" if i % 2 else None) for i in range(3000)], "id long, t string, m string")
    assert prepare.hot_cells(df, "id", ["t", "m"]).count() == 4500
    tokens = prepare.hot_tokens(df, "m", "id", ",")
    assert tokens.count() == 3000 and {r["token"] for r in tokens.select("token").distinct().collect()} == {"a", "b"}


def test_shipping_looks_at_bytes(spark, monkeypatch):
    from lumentab.operators import ship

    texts = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "id long, t string")
    monkeypatch.setattr(ship, "SHIP_BYTES", 10_000)
    assert ship.ship_if_short(texts) is texts
    monkeypatch.setattr(ship, "SHIP_BYTES", 100_000)
    assert ship.ship_if_short(texts) is not texts


def test_one_hot_and_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id int, t string")
    levels = prepare.fit_levels(df, ["t"])
    assert levels == {"t": ["a", "b", "c"]}
    rows = {r["id"]: (r["t_b"], r["t_c"]) for r in prepare.one_hot(df, levels, drop_first=True).collect()}
    assert rows == {1: (1, 0), 2: (0, 0), 3: (0, 0), 4: (0, 1)}
    codes = prepare.level_codes(df.where("id < 4"), "t")
    coded = {r["id"]: r["code"] for r in prepare.encode_levels(df, codes, "t", unknown=-1).collect()}
    assert coded == {1: 1, 2: 0, 3: -1, 4: -1}
    with pytest.raises(ValueError):
        prepare.fit_levels(df, ["t"], limit=2)


def test_bit_codes_follow_first_appearance(spark, path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate("zyxzwzv")], "id long, t string")
    coded, bits = prepare.bit_codes(df, "t", "id", "t")
    want = {"z": 0, "y": 1, "x": 2, "w": 3, "v": 4}
    assert bits == 3
    for r in coded.collect():
        assert r["t_code"] == want[r["t"]]
        assert sum(r[f"t_bin_{b}"] << b for b in range(bits)) == want[r["t"]]


def test_rare_values(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate("aaabbc")], "id int, t string")
    assert sorted(r["t"] for r in prepare.fold_rare(df, "t", 3).collect()) == ["Rare"] * 3 + ["a"] * 3
    assert prepare.drop_rare(df, "t", 2).count() == 5


def test_preparation_leaves_no_gap(frame, path):
    _, df = frame
    rows = df.withColumn("flag", F.when(F.col("id") % 5 != 0, (F.col("id") % 2).cast("int")))
    model = prepare.fit_preparation(rows.where("id < 400"), ["a", "b"], ["flag"])
    out = model.transform(rows)
    profile.require_complete(out, ["a", "b", "flag"])
    with pytest.raises(ValueError):
        profile.require_complete(rows, ["flag"])


def test_log_only_when_skewed(frame):
    _, df = frame
    out, skew = prepare.log_if_skewed(df, ["a", "b"])
    assert "b_log1p" in out.columns and "a_log1p" not in out.columns and skew["b"] > 1


def test_text_functions(spark):
    df = spark.createDataFrame(
        [(" NA\t", "Perez, Dr. Ana", "70%"), ("x ", "no title", "?"), (None, None, None)], "t string, n string, p string")
    rows = df.select(fn.null_if_token("t").alias("t"), fn.title_of("n").alias("n"), fn.percent_number("p").alias("p")).collect()
    assert [tuple(r) for r in rows] == [(None, "Dr", 70.0), ("x", None, None), (None, None, None)]


def test_lookup_leaves_unmapped_null(spark):
    df = spark.createDataFrame([("Siempre",), ("Otro",), (None,)], "t string")
    assert [r[0] for r in df.select(fn.lookup("t", fn.LIKERT_CODES, "int")).collect()] == [5, None, None]


def test_row_mean_skips_missing(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 5.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(fn.row_mean(["a", "b"])).collect()] == [2.0, 5.0, None]
