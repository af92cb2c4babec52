"""Queries with SQL agree with it on the smallest tables; the others run (the long searches with fewer rounds, in test_models.py)."""

import importlib.util
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = Path("/root/testdata/sf0.001")
sys.path.insert(0, str(ROOT / "tools"))

import check_oracle  # noqa: E402
from lumentab.plans import ORACLES, PLANS  # noqa: E402

pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in check_oracle.TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in PLANS if n in ORACLES])
def test_query_agrees_with_sql(spark, con, name):
    text, _, ok = check_oracle.compare(spark, con, name, str(SF))
    assert ok, text


@pytest.mark.parametrize("name", [
    "dbscan_orders", "fcm", "fcm_partition_sweep", "kmeans_elbow", "ml_logreg_multi", "ml_forest", "ml_gbt_multi", "ml_gbt_bin", "subtractive", "kmeans_seeded", "cluster_metrics", "pca_2d", "vif", "ml_score_table", "ml_ols_ordinal",
    "ml_logreg_bin", "ml_ridge_lasso", "ml_tree", "ml_isotonic", "ml_importance", "ml_label_versions", "probability_histogram"])
def test_query_without_sql_gives_rows(spark, name):
    assert PLANS[name](spark, str(SF)).count() > 0


def test_entry_contract(spark):
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() > 0
    assert set(module.oracle_sql()) <= set(module.queries())
