"""Readers and writers: delimited files, JSON dictionaries, literal tables, manifests."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# The encodings and separators tried in this order.
ENCODINGS = ("UTF-8", "ISO-8859-1")
SEPARATORS = (",", ";")

# Six rows of country data, one duplicated, two cells missing.
COUNTRIES = [
    ("Brasil", "Brasilia", 8515767.0, 213000000.0),
    ("Rusia", "Moscu", 17098242.0, 146000000.0),
    ("India", "Nueva Delhi", None, 1380000000.0),
    ("China", "Beijing", 9596961.0, 1440000000.0),
    ("Sudafrica", "Pretoria", 1221037.0, None),
    ("Brasil", "Brasilia", 8515767.0, 213000000.0),
]


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRIES, "pais string, capital string, area double, population double")


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             sep: str = ",", encoding: str = "UTF-8", **options) -> DataFrame:
    """Header CSV; empty cells are NULL.  Pass a schema for large inputs: inference reads the data twice."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def detect_dialect(spark: SparkSession, path: str | Sequence[str]) -> tuple[str, str]:
    """(encoding, separator) of the whole input.

    Spark decodes bad bytes to U+FFFD instead of failing, so every line is searched for that
    character (the search ends at the first one); a separator is right when the header has
    more than one column.
    """
    encoding = ENCODINGS[-1]
    for candidate in ENCODINGS:
        lines = spark.read.option("encoding", candidate).option("header", False).option("sep", "\u0001").csv(path)
        text = F.col(lines.columns[0])
        if lines.where(text.contains("�")).isEmpty():
            encoding = candidate
            break
    for sep in SEPARATORS:
        if len(spark.read.option("header", True).option("encoding", encoding).option("sep", sep).csv(path).columns) > 1:
            return encoding, sep
    return encoding, SEPARATORS[0]


def read_csv_any(spark: SparkSession, path: str | Sequence[str], schema=None, **options) -> DataFrame:
    encoding, sep = detect_dialect(spark, path)
    return read_csv(spark, path, schema, sep, encoding, **options)


def read_json_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a multi-line JSON file."""
    return spark.read.option("multiLine", True).json(path)


def describe_columns(df: DataFrame, notes: Mapping[str, str]) -> DataFrame:
    """Attach dictionary texts as column metadata (kept by parquet and by projections)."""
    return df.select(*[
        F.col(c).alias(c, metadata={"comment": notes[c]}) if c in notes else F.col(c) for c in df.columns
    ])


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def cast_if_clean(df: DataFrame, cols: Sequence[str], dtype: str = "double") -> DataFrame:
    """Cast a text column only if every non-null value is a number; one aggregate for all columns."""
    bad = df.agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(dtype).isNull()).alias(c) for c in cols
    ]).first()
    return df.withColumns({c: F.col(c).cast(dtype) for c in cols if bad[c] == 0})


def month_start(c: Column) -> Column:
    """``yyyy-MM`` text to the first day of the month; unparsable text gives NULL."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM")).cast("date")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)


def write_splits(df: DataFrame, path: str, key: str, split: str = "split") -> None:
    """Rows with their key, one folder per split: a reader of one split prunes the others."""
    if key not in df.columns:
        raise ValueError(f"lineage needs the key column {key}")
    write_parquet(df, path, [split])


def manifest(df: DataFrame, date: str, limit: str, features: Sequence[str] = ()) -> DataFrame:
    """One row that documents a run: shape, columns, features, date range, cut-off, rows on both sides and without a date."""
    at = F.lit(limit).cast("timestamp")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.count_if(F.col(date) < at).alias("train_rows"),
        F.count_if(F.col(date) >= at).alias("test_rows"),
        F.count_if(F.col(date).isNull()).alias("undated_rows"),
        F.lit(limit).alias("cut_off"),
        F.lit(",".join(features)).alias("features"),
        F.date_format(F.min(date), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max(date), "yyyy-MM-dd").alias("last_date"),
        F.lit(",".join(sorted(df.columns))).alias("columns"),
    )


def write_manifest(manifest_df: DataFrame, path: str) -> None:
    manifest_df.write.mode("errorifexists").json(path)


def notes_from_dictionary(text: str) -> dict[str, str]:
    """Column notes of a data dictionary: the ``columns`` object of the JSON text."""
    return {k: str(v) for k, v in json.loads(text).get("columns", {}).items()}
