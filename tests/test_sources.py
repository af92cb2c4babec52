import json

import pytest
from pyspark.sql import functions as F

from lumentab.operators import models, profile, split
from lumentab.sources import tables


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "id int, t string, x double")
    tables.write_csv(df, str(tmp_path / "out"))
    back = tables.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert sorted(back.collect(), key=lambda r: r["id"]) == sorted(df.collect(), key=lambda r: r["id"])


@pytest.mark.parametrize("encoding,expected", [("utf-8", "UTF-8"), ("latin-1", "ISO-8859-1")])
@pytest.mark.parametrize("sep", [",", ";"])
def test_dialect_is_detected(spark, tmp_path, encoding, expected, sep):
    path = tmp_path / "in.csv"
    path.write_bytes(f"id{sep}ciudad\n1{sep}Medellín\n2{sep}Bogotá\n".encode(encoding))
    assert tables.detect_dialect(spark, str(path)) == (expected, sep)
    assert {r["ciudad"] for r in tables.read_csv_any(spark, str(path)).collect()} == {"Medellín", "Bogotá"}


def test_byte_order_mark_is_dropped(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_bytes(b"\xef\xbb\xbfid,x\n1,2\n")
    assert tables.read_csv(spark, str(path)).columns == ["id", "x"]


def test_json_dictionary_becomes_metadata(spark, tmp_path):
    path = tmp_path / "d.json"
    text = json.dumps({"description": "d", "columns": {"x": "a number", "y": "a text"}}, indent=1)
    path.write_text(text)
    assert tables.read_json_dictionary(spark, str(path)).first()["description"] == "d"
    df = tables.describe_columns(spark.createDataFrame([(1, "a")], "x int, y string"), tables.notes_from_dictionary(text))
    assert df.schema["x"].metadata["comment"] == "a number"


def test_sample_table_round_trip(spark, tmp_path):
    rows = "\n".join(f"{i},{5 + i % 3},{3.5},{1.4},{0.2},{'ABC'[i % 3]}" for i in range(1, 16))
    (tmp_path / "flowers.csv").write_text("Id,SepalLengthCm,SepalWidthCm,PetalLengthCm,PetalWidthCm,Species\n" + rows)
    df = tables.read_csv(spark, str(tmp_path / "flowers.csv"))
    assert df.count() == 15 and profile.value_counts(df, "Species").where("n = 5").count() == 3


def test_cast_only_clean_columns(spark):
    df = spark.createDataFrame([("1", "x"), ("2.5", "3"), (None, None)], "a string, b string")
    assert dict(tables.cast_if_clean(df, ["a", "b"]).dtypes) == {"a": "double", "b": "string"}


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert tables.nan_to_null(df).where("x is null").count() == 1


def test_split_folders_and_manifest(spark, tmp_path):
    df = spark.range(50).withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")))
    parts = split.hash_split(df, "id", (0.8, 0.2), ("train", "test"))
    tables.write_splits(parts, str(tmp_path / "splits"), "id")
    back = spark.read.parquet(str(tmp_path / "splits")).where("split = 'test'")
    assert back.count() == 10
    assert "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().executedPlan().toString()
    tables.write_manifest(tables.manifest(df, "d", "2024-02-01"), str(tmp_path / "run"))
    row = spark.read.json(str(tmp_path / "run")).first()
    assert (row["n_rows"], row["train_rows"], row["test_rows"]) == (50, 31, 19)


def test_required_columns(spark):
    with pytest.raises(ValueError):
        profile.require_columns(spark.range(1), ["id", "missing"])


def test_model_store(spark, tmp_path):
    df = models.assemble(spark.range(40).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y")), ["x"])
    model = models.tree(df, "y")
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    assert again.transform(df).select("prediction").collect() == model.transform(df).select("prediction").collect()


def test_a_late_byte_decides_the_encoding(spark, tmp_path):
    path = tmp_path / "late.csv"
    path.write_bytes(b"a;b\n" + b"x;1\n" * 5000 + "Ni\u00f1o;2\n".encode("latin-1"))
    assert tables.detect_dialect(spark, str(path)) == ("ISO-8859-1", ";")
    assert tables.read_csv_any(spark, str(path)).where("b = 2").first()["a"] == "Ni\u00f1o"


def test_manifest_names_cut_off_features_and_undated_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2020-01-01'), (2, TIMESTAMP '2024-01-01'), (3, NULL) AS t(x, at)")
    row = tables.manifest(df, "at", "2023-01-01", ["x"]).first()
    assert (row["n_rows"], row["train_rows"], row["test_rows"], row["undated_rows"]) == (3, 1, 1, 1)
    assert (row["cut_off"], row["features"]) == ("2023-01-01", "x")
