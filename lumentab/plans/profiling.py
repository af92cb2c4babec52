"""Selection, cleaning, scalar functions, profiles and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumentab.functions import columns as fn
from lumentab.operators import order, prepare, profile, split
from lumentab.plans.registry import as_long, null_every, query, rounded, table
from lumentab.sources import tables as src

LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("clean_names", """
    SELECT p_partkey AS "Part Key", p_name AS "Company (Maker)", p_retailprice AS "Rating Value"
    FROM part
""")
def clean_names(spark, sf):
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").alias(" Part\nKey "), F.col("p_name").alias("Company\n(Maker)"),
        F.col("p_retailprice").alias("Rating\nValue"),
    )
    return raw.toDF(*[fn.tidy_name(c) for c in raw.columns])


@query("select_cols", """
    SELECT p_partkey AS part_id, p_size::BIGINT AS size_scaled, p_retailprice AS price FROM part
""")
def select_cols(spark, sf):
    part = table(spark, sf, "part")
    positional = part.select(part.columns[0], *part.columns[4:])
    return as_long(
        positional.withColumnsRenamed({"p_partkey": "part_id", "p_size": "size_scaled", "p_retailprice": "price"})
        .drop("p_name", "not_there")
    )


@query("feature_ratios", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
           ROUND(l_extendedprice / NULLIF(l_quantity, 0), 8) AS unit_price,
           ROUND(l_tax / NULLIF(l_discount, 0), 6) AS tax_per_discount,
           ROUND(l_extendedprice / (l_quantity + 1e-9), 4) AS unit_price_offset,
           ROUND(l_discount * l_tax, 6) AS pressure,
           ROUND(1 - l_discount, 6) AS margin
    FROM lineitem
""")
def feature_ratios(spark, sf):
    li = table(spark, sf, "lineitem")
    return as_long(li.select(
        "l_orderkey", "l_linenumber",
        F.round(fn.ratio_or_null("l_extendedprice", "l_quantity"), 8).alias("unit_price"),
        F.round(fn.ratio_or_null("l_tax", "l_discount"), 6).alias("tax_per_discount"),
        F.round(fn.ratio_offset("l_extendedprice", "l_quantity"), 4).alias("unit_price_offset"),
        F.round(F.col("l_discount") * F.col("l_tax"), 6).alias("pressure"),
        F.round(1 - F.col("l_discount"), 6).alias("margin"),
    ))


@query("feature_flags", """
    WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS b, c_mktsegment FROM customer)
    SELECT c_custkey,
           COALESCE((b < 1000)::INT, 0)::BIGINT AS low_balance,
           COALESCE((b < 0)::INT, 0)::BIGINT AS negative,
           COALESCE((b > 4000)::INT, 0)::BIGINT AS dependent,
           (b IS NOT NULL)::BIGINT AS has_balance,
           (c_mktsegment = 'BUILDING')::BIGINT AS is_building
    FROM c
""")
def feature_flags(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", null_every("c_custkey", 11, "c_acctbal"))
    b = F.col("c_acctbal")
    return as_long(c.select(
        "c_custkey",
        fn.flag(b < 1000).alias("low_balance"), fn.flag(b < 0).alias("negative"),
        fn.flag(b > 4000).alias("dependent"), fn.flag(b.isNotNull()).alias("has_balance"),
        fn.flag(F.col("c_mktsegment") == "BUILDING").alias("is_building"),
    ))


@query("bin_quality", """
    WITH r AS (SELECT p_partkey, 1 + 4.0::DOUBLE * p_size / 50 AS rating FROM part)
    SELECT p_partkey,
           (CASE WHEN rating <= 2.5 THEN 1 WHEN rating <= 3.75 THEN 2 ELSE 3 END)::BIGINT AS quality,
           CASE WHEN rating <= 2.33 THEN 'bajo' WHEN rating <= 3.67 THEN 'medio' ELSE 'alto' END AS level
    FROM r
""")
def bin_quality(spark, sf):
    rating = table(spark, sf, "part").select("p_partkey", (1 + 4.0 * F.col("p_size") / 50).alias("rating"))
    return as_long(rating.select(
        "p_partkey",
        fn.cut("rating", (2.5, 3.75), (1, 2, 3)).alias("quality"),
        fn.cut("rating", (2.33, 3.67), ("bajo", "medio", "alto")).alias("level"),
    ))


@query("map_ordinal", """
    WITH a AS (
      SELECT o_orderkey, o_orderpriority,
             CASE o_orderkey % 6 WHEN 0 THEN ' Nunca' WHEN 1 THEN 'Rara vez' WHEN 2 THEN 'A veces '
               WHEN 3 THEN 'Frecuentemente' WHEN 4 THEN 'Siempre' ELSE 'Otro' END AS answer FROM orders),
    m AS (SELECT * FROM (VALUES ('1-URGENT',1),('2-HIGH',2),('3-MEDIUM',3),('5-LOW',5)) AS t(o_orderpriority, code))
    SELECT o_orderkey,
           CASE trim(answer) WHEN 'Nunca' THEN 1 WHEN 'Rara vez' THEN 2 WHEN 'A veces' THEN 3
             WHEN 'Frecuentemente' THEN 4 WHEN 'Siempre' THEN 5 END::BIGINT AS answer_code,
           code::BIGINT AS priority_code
    FROM a LEFT JOIN m USING (o_orderpriority)
""")
def map_ordinal(spark, sf):
    o = table(spark, sf, "orders")
    answers = F.get(
        F.array(*[F.lit(t) for t in (" Nunca", "Rara vez", "A veces ", "Frecuentemente", "Siempre", "Otro")]),
        (F.col("o_orderkey") % 6).cast("int"),
    )
    codes = spark.createDataFrame(
        [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("5-LOW", 5)], "o_orderpriority string, code long"
    )
    return prepare.encode_levels(o, codes, "o_orderpriority", "code").select(
        "o_orderkey",
        fn.lookup(fn.strip(answers), fn.LIKERT_CODES, "long").alias("answer_code"),
        F.col("code").alias("priority_code"),
    )


@query("range_validate", """
    SELECT COUNT(*)::BIGINT AS valid_rows, MIN(l_quantity) AS min_quantity, MAX(l_quantity) AS max_quantity,
           MIN(l_discount) AS min_discount, MAX(l_discount) AS max_discount,
           string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags
    FROM lineitem WHERE l_quantity BETWEEN 5 AND 45 AND l_discount >= 0.01 AND l_returnflag IN ('A','N','R')
""")
def range_validate(spark, sf):
    li = table(spark, sf, "lineitem")
    kept = li.where(
        F.col("l_quantity").between(5, 45) & (F.col("l_discount") >= 0.01) & F.col("l_returnflag").isin("A", "N", "R")
    )
    return kept.agg(
        F.count(F.lit(1)).alias("valid_rows"),
        F.min("l_quantity").alias("min_quantity"), F.max("l_quantity").alias("max_quantity"),
        F.min("l_discount").alias("min_discount"), F.max("l_discount").alias("max_discount"),
        F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"),
    )


@query("dropna_rows", """
    SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 7 <> 0
""")
def dropna_rows(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", null_every("c_custkey", 11, "c_acctbal"), null_every("c_custkey", 7, "c_mktsegment")
    )
    return c.dropna(subset=["c_acctbal", "c_mktsegment"])


@query("sentinel_null", """
    WITH raw AS (SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN ' NA ' WHEN 1 THEN 'N/A' WHEN 2 THEN '?'
                   WHEN 3 THEN '-999' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE ' ' || c_mktsegment END AS t FROM customer)
    SELECT c_custkey, CASE WHEN trim(t) IN ('NA','N/A','na','NaN','?','-999','') THEN NULL ELSE trim(t) END AS segment
    FROM raw
""")
def sentinel_null(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey") % 9
    raw = (
        F.when(k == 0, " NA ").when(k == 1, "N/A").when(k == 2, "?").when(k == 3, "-999")
        .when(k == 4, "").when(k > 5, F.concat(F.lit(" "), F.col("c_mktsegment")))
    )
    return c.select("c_custkey", fn.null_if_token(raw).alias("segment"))


@query("null_report", """
    WITH c AS (SELECT CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal,
                      CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment,
                      CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_name END AS c_name FROM customer)
    SELECT 'c_acctbal' AS "column", count(*) FILTER (c_acctbal IS NULL)::BIGINT AS nulls,
           ROUND(count(*) FILTER (c_acctbal IS NULL) * 100.0::DOUBLE / count(*), 6) AS null_pct, 0::BIGINT AS empty FROM c
    UNION ALL
    SELECT 'c_mktsegment', count(*) FILTER (c_mktsegment IS NULL),
           ROUND(count(*) FILTER (c_mktsegment IS NULL) * 100.0::DOUBLE / count(*), 6), 0 FROM c
    UNION ALL
    SELECT 'c_name', count(*) FILTER (c_name IS NULL), ROUND(count(*) FILTER (c_name IS NULL) * 100.0::DOUBLE / count(*), 6),
           count(*) FILTER (trim(c_name) = '') FROM c
""")
def null_report(spark, sf):
    c = table(spark, sf, "customer").select(
        null_every("c_custkey", 11, "c_acctbal"), null_every("c_custkey", 7, "c_mktsegment"),
        F.when(F.col("c_custkey") % 5 == 0, " ").otherwise(F.col("c_name")).alias("c_name"),
    )
    return rounded(profile.null_report(c, c.columns), 6, "null_pct")


@query("null_rows", """
    SELECT c_custkey, 'c_acctbal' AS "column" FROM customer WHERE c_custkey % 11 = 0
    UNION ALL SELECT c_custkey, 'c_mktsegment' FROM customer WHERE c_custkey % 7 = 0
""")
def null_rows(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", null_every("c_custkey", 11, "c_acctbal"), null_every("c_custkey", 7, "c_mktsegment")
    )
    return profile.null_rows(c, ["c_custkey"], ["c_acctbal", "c_mktsegment"])


@query("dup_count", """
    SELECT SUM(n)::BIGINT AS "rows", COUNT(*)::BIGINT AS distinct_rows, (SUM(n) - COUNT(*))::BIGINT AS duplicates
    FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_quantity, l_discount, l_tax, l_returnflag)
""")
def dup_count(spark, sf):
    return profile.duplicate_count(
        table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
    )


@query("dedup_key", """
    SELECT o_custkey, o_orderdate::VARCHAR AS first_date, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    WHERE rn = 1
""")
def dedup_key(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    first = profile.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("first_date"), "o_orderkey", "o_totalprice"
    )


@query("dedup_full", """
    SELECT DISTINCT lower(trim(p_brand)) AS brand, lower(trim(p_type)) AS kind FROM part
""")
def dedup_full(spark, sf):
    return table(spark, sf, "part").select(
        F.lower(fn.strip("p_brand")).alias("brand"), F.lower(fn.strip("p_type")).alias("kind")
    ).dropDuplicates()


@query("nunique_report", """
    SELECT 'l_orderkey' AS "column", COUNT(DISTINCT l_orderkey)::BIGINT AS n_unique FROM lineitem
    UNION ALL SELECT 'l_partkey', COUNT(DISTINCT l_partkey) FROM lineitem
    UNION ALL SELECT 'l_quantity', COUNT(DISTINCT l_quantity) FROM lineitem
    UNION ALL SELECT 'l_extendedprice', COUNT(DISTINCT l_extendedprice) FROM lineitem
    UNION ALL SELECT 'l_returnflag', COUNT(DISTINCT l_returnflag) FROM lineitem
""")
def nunique_report(spark, sf):
    return profile.distinct_counts(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    )


def _describe_sql(cols, source):
    return " UNION ALL ".join(f"""
      SELECT '{c}' AS "column", COUNT({c})::BIGINT AS "count", ROUND(AVG({c}), 4) AS mean,
             ROUND(stddev_samp({c}), 4) AS std, ROUND(MIN({c}), 4) AS "min",
             ROUND(quantile_cont({c}, 0.25), 4) AS p25, ROUND(quantile_cont({c}, 0.5), 4) AS p50,
             ROUND(quantile_cont({c}, 0.75), 4) AS p75, ROUND(MAX({c}), 4) AS "max" FROM {source}""" for c in cols)


@query("describe_all", _describe_sql(
    ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINE_NUMBERS),
    "(SELECT COLUMNS('l_(orderkey|partkey|suppkey|linenumber|quantity|extendedprice|discount|tax)')::DOUBLE FROM lineitem)"))
def describe_all(spark, sf):
    li = table(spark, sf, "lineitem")
    return rounded(profile.describe(li, profile.numeric_columns(li)), 4)


@query("describe_long", " UNION ALL ".join(f"""
    SELECT 'p_retailprice' AS "column", '{name}' AS stat, ROUND({expr}, 4)::DOUBLE AS value FROM part
    UNION ALL SELECT 'p_size', '{name}', ROUND({expr.replace('p_retailprice', 'p_size::DOUBLE')}, 4) FROM part"""
    for name, expr in {
        "count": "COUNT(p_retailprice)::DOUBLE", "mean": "AVG(p_retailprice)", "std": "stddev_samp(p_retailprice)",
        "min": "MIN(p_retailprice)", "p25": "quantile_cont(p_retailprice, 0.25)",
        "p50": "quantile_cont(p_retailprice, 0.5)", "p75": "quantile_cont(p_retailprice, 0.75)",
        "max": "MAX(p_retailprice)"}.items()))
def describe_long(spark, sf):
    wide = profile.describe(table(spark, sf, "part"), ["p_retailprice", "p_size"])
    return rounded(profile.to_long(wide, ["column"], wide.columns[1:]), 4)


@query("position_stats", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", ROUND(quantile_cont({c}, 0.10), 4) AS p10, ROUND(quantile_cont({c}, 0.90), 4) AS p90,
           ROUND(quantile_cont({c}, 0.95), 4) AS p95, ROUND(quantile_cont({c}, 0.99), 4) AS p99,
           ROUND(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr,
           ROUND(MAX({c}) - MIN({c}), 4) AS value_range, ROUND(var_samp({c}), 4) AS variance,
           (SELECT m.{c} FROM (SELECT {c}, COUNT(*) AS n FROM lineitem GROUP BY 1) m ORDER BY n DESC, {c} LIMIT 1) AS mode
    FROM lineitem""" for c in LINE_NUMBERS))
def position_stats(spark, sf):
    li = table(spark, sf, "lineitem")
    q = order.quantiles(li, LINE_NUMBERS, (0.10, 0.90, 0.95, 0.99, 0.25, 0.75)).select(
        "column", *[F.round(f"q{i}", 4).alias(n) for i, n in enumerate(("p10", "p90", "p95", "p99"))],
        F.round(F.col("q5") - F.col("q4"), 4).alias("iqr"),
    )
    spread = profile.stats_by_column(li, LINE_NUMBERS, {
        "value_range": lambda c: F.round(F.max(c) - F.min(c), 4), "variance": lambda c: F.round(F.var_samp(c), 4)})
    return q.join(spread, "column").join(order.modes(li, LINE_NUMBERS), "column")


@query("scalar_strings", """
    SELECT doc_id, lower(lang) AS lang_lower, replace(source, 'src', 'source ') AS source_text,
           trim('  ' || lang || ' ') AS lang_trimmed, length(text)::BIGINT AS n_text, doc_id::VARCHAR AS doc_text
    FROM documents
""")
def scalar_strings(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id", F.lower("lang").alias("lang_lower"),
        F.replace("source", F.lit("src"), F.lit("source ")).alias("source_text"),
        fn.strip(F.concat(F.lit("  "), F.col("lang"), F.lit(" "))).alias("lang_trimmed"),
        F.length("text").cast("long").alias("n_text"), F.col("doc_id").cast("string").alias("doc_text"),
    )


@query("scalar_casts", """
    SELECT p_partkey, TRY_CAST(replace(p_size::VARCHAR || '%', '%', '') AS DOUBLE) AS pct,
           TRY_CAST(CASE WHEN p_partkey % 5 = 0 THEN 'n/a' ELSE p_retailprice::VARCHAR END AS DOUBLE) AS price_or_null,
           trunc(p_retailprice)::BIGINT AS price_int,
           strftime(strptime('2025-' || lpad(((p_partkey % 12) + 1)::VARCHAR, 2, '0'), '%Y-%m'), '%Y-%m-%d') AS month_start,
           (strptime('2025-' || lpad(((p_partkey % 12) + 1)::VARCHAR, 2, '0'), '%Y-%m') < DATE '2025-09-01')::BIGINT AS before_limit
    FROM part
""")
def scalar_casts(spark, sf):
    p = table(spark, sf, "part")
    month = src.month_start(F.concat(F.lit("2025-"), F.lpad((F.col("p_partkey") % 12 + 1).cast("string"), 2, "0")))
    maybe = F.when(F.col("p_partkey") % 5 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    return p.select(
        "p_partkey", fn.percent_number(F.concat(F.col("p_size").cast("string"), F.lit("%"))).alias("pct"),
        fn.number_or_null(maybe).alias("price_or_null"),
        F.col("p_retailprice").cast("int").cast("long").alias("price_int"),
        F.date_format(month, "yyyy-MM-dd").alias("month_start"),
        fn.flag(month < F.lit("2025-09-01").cast("date")).cast("long").alias("before_limit"),
    )


@query("scalar_math", """
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, ROUND(ln(1 + l_extendedprice), 6) AS log_price,
           ROUND(abs(l_quantity - 25), 6) AS gap, ROUND(sqrt(l_quantity), 6) AS root, ROUND(exp(-l_discount), 6) AS decay,
           ROUND(pow(l_tax, 2), 6) AS squared, greatest(10, least(40, l_quantity)) AS clipped,
           round_even(l_quantity / 4, 0) AS half_even,
           ROUND((l_quantity + CASE WHEN l_orderkey % 3 <> 0 THEN l_tax END) / 2, 6) AS plain_mean,
           ROUND(CASE WHEN l_orderkey % 3 <> 0 THEN (l_quantity + l_tax) / 2 ELSE l_quantity END, 6) AS row_mean,
           6 - (l_linenumber % 5 + 1)::BIGINT AS reversed
    FROM lineitem
""")
def scalar_math(spark, sf):
    li = table(spark, sf, "lineitem")
    maybe = F.when(F.col("l_orderkey") % 3 != 0, F.col("l_tax"))
    return as_long(li.select(
        "l_orderkey", "l_linenumber", F.round(F.log1p("l_extendedprice"), 6).alias("log_price"),
        F.round(F.abs(F.col("l_quantity") - 25), 6).alias("gap"), F.round(F.sqrt("l_quantity"), 6).alias("root"),
        F.round(F.exp(-F.col("l_discount")), 6).alias("decay"), F.round(F.pow("l_tax", F.lit(2.0)), 6).alias("squared"),
        fn.clip("l_quantity", 10.0, 40.0).alias("clipped"), F.bround(F.col("l_quantity") / 4, 0).alias("half_even"),
        F.round((F.col("l_quantity") + maybe) / 2, 6).alias("plain_mean"),
        F.round(fn.row_mean(["l_quantity", maybe]), 6).alias("row_mean"),
        fn.reverse_scored(F.col("l_linenumber") % 5 + 1).alias("reversed"),
    ))


@query("title_extract", r"""
    WITH n AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name ELSE
        split_part(c_name, '#', 1) || ', ' || CASE c_custkey % 5 WHEN 1 THEN 'Mr' WHEN 2 THEN 'Mrs' WHEN 3 THEN 'Miss'
        ELSE 'the Countess' END || '. ' || split_part(c_name, '#', 2) END AS full_name FROM customer)
    SELECT c_custkey, NULLIF(trim(regexp_extract(full_name, ',\s*([^\.]+)\.', 1)), '') AS title FROM n
""")
def title_extract(spark, sf):
    k = F.col("c_custkey") % 5
    title = F.when(k == 1, "Mr").when(k == 2, "Mrs").when(k == 3, "Miss").otherwise("the Countess")
    full = F.when(k == 0, F.col("c_name")).otherwise(F.concat(
        F.split_part("c_name", F.lit("#"), F.lit(1)), F.lit(", "), title, F.lit(". "),
        F.split_part("c_name", F.lit("#"), F.lit(2))))
    return table(spark, sf, "customer").select("c_custkey", fn.title_of(full).alias("title"))


@query("run_manifest", """
    SELECT COUNT(*)::BIGINT AS n_rows, 6::BIGINT AS n_columns,
           count(*) FILTER (o_orderdate < TIMESTAMP '2000-01-01')::BIGINT AS train_rows,
           count(*) FILTER (o_orderdate >= TIMESTAMP '2000-01-01')::BIGINT AS test_rows,
           count(*) FILTER (o_orderdate IS NULL)::BIGINT AS undated_rows, '2000-01-01' AS cut_off, 'o_totalprice,o_orderpriority' AS features,
           strftime(MIN(o_orderdate), '%Y-%m-%d') AS first_date, strftime(MAX(o_orderdate), '%Y-%m-%d') AS last_date,
           'o_custkey,o_orderdate,o_orderkey,o_orderpriority,o_orderstatus,o_totalprice' AS columns
    FROM orders
""")
def run_manifest(spark, sf):
    o = table(spark, sf, "orders")
    profile.require_columns(o, ["o_orderkey", "o_orderdate"])
    return src.manifest(o, "o_orderdate", "2000-01-01", ["o_totalprice", "o_orderpriority"])


@query("strided_sample", """
    WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx,
                      COUNT(*) OVER () AS n FROM orders),
    wanted AS (SELECT DISTINCT (i * (n - 1) // 119) AS idx FROM range(120) t(i), (SELECT MAX(n) AS n FROM r))
    SELECT o_orderkey, o_totalprice FROM r WHERE idx IN (SELECT idx FROM wanted)
""")
def strided_sample(spark, sf):
    return split.strided_sample(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 120)
