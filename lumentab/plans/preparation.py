"""Fills, outliers, scalers, encoders, column-wise preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumentab.operators import prepare, split
from lumentab.plans.registry import as_long, null_every, query, rounded, table

CUSTOMER_SQL = """(SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal,
    CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer)"""
LINES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def gappy_customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", null_every("c_custkey", 11, "c_acctbal"), null_every("c_custkey", 7, "c_mktsegment")
    )


@query("fill_mean", f"""
    SELECT c_custkey, ROUND(COALESCE(c_acctbal, (SELECT AVG(c_acctbal) FROM {CUSTOMER_SQL})), 4) AS c_acctbal
    FROM {CUSTOMER_SQL}
""")
def fill_mean(spark, sf):
    c = gappy_customers(spark, sf).select("c_custkey", "c_acctbal")
    return rounded(prepare.fill(c, prepare.fit_means(c, ["c_acctbal"])), 4)


@query("fill_median", f"""
    SELECT c_custkey, ROUND(COALESCE(c_acctbal, (SELECT quantile_cont(c_acctbal, 0.5) FROM {CUSTOMER_SQL})), 4) AS c_acctbal
    FROM {CUSTOMER_SQL}
""")
def fill_median(spark, sf):
    c = gappy_customers(spark, sf).select("c_custkey", "c_acctbal")
    return rounded(prepare.fill(c, prepare.fit_medians(c, ["c_acctbal"])), 4)


@query("fill_mode", f"""
    SELECT c_custkey, COALESCE(c_mktsegment, (SELECT c_mktsegment FROM {CUSTOMER_SQL} WHERE c_mktsegment IS NOT NULL
        GROUP BY 1 ORDER BY COUNT(*) DESC, c_mktsegment LIMIT 1)) AS c_mktsegment FROM {CUSTOMER_SQL}
""")
def fill_mode(spark, sf):
    c = gappy_customers(spark, sf).select("c_custkey", "c_mktsegment")
    return prepare.fill(c, prepare.fit_modes(c, ["c_mktsegment"], "string"))


@query("fill_const", f"""
    SELECT c_custkey, COALESCE(c_acctbal, 0.0) AS c_acctbal, COALESCE(c_mktsegment, '__MISSING__') AS c_mktsegment
    FROM {CUSTOMER_SQL}
""")
def fill_const(spark, sf):
    c = gappy_customers(spark, sf).select("c_custkey", "c_acctbal", "c_mktsegment")
    return prepare.fill(c, {"c_acctbal": 0.0, "c_mktsegment": "__MISSING__"})


@query("fill_group_median", f"""
    WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS c_acctbal FROM {CUSTOMER_SQL}),
    g AS (SELECT c_nationkey, quantile_cont(c_acctbal, 0.5) AS m FROM c GROUP BY 1)
    SELECT c_custkey, c_nationkey::BIGINT AS c_nationkey,
           ROUND(COALESCE(c_acctbal, m, (SELECT quantile_cont(c_acctbal, 0.5) FROM c)), 4) AS c_acctbal
    FROM c JOIN g USING (c_nationkey)
""")
def fill_group_median(spark, sf):
    c = gappy_customers(spark, sf).select(
        "c_custkey", "c_nationkey", F.when(F.col("c_nationkey") != 3, F.col("c_acctbal")).alias("c_acctbal")
    )
    return as_long(rounded(prepare.fill_from_groups(c, ["c_nationkey"], ["c_acctbal"]), 4))


def _limits_sql(c, source):
    return f"""SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
        quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM {source}"""


@query("iqr_report", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", ROUND(MAX(lo), 6) AS low, ROUND(MAX(hi), 6) AS high,
           count(*) FILTER ({c} < lo OR {c} > hi)::BIGINT AS outliers
    FROM {t}, ({_limits_sql(c, t)})""" for t, c in (
        ("events", "value"), ("(SELECT *, CASE WHEN event_id % 50 = 0 THEN 9 ELSE 1 END::DOUBLE AS flat FROM events)", "flat"))) + " UNION ALL " + " UNION ALL ".join(f"""
    SELECT '{c}', ROUND(MAX(lo), 6), ROUND(MAX(hi), 6), count(*) FILTER ({c} < lo OR {c} > hi)
    FROM lineitem, ({_limits_sql(c, 'lineitem')})""" for c in LINES))
def iqr_report(spark, sf):
    flat = F.when(F.col("event_id") % 50 == 0, 9.0).otherwise(1.0)
    events = prepare.iqr_report(table(spark, sf, "events").withColumn("flat", flat), ["value", "flat"])
    return rounded(events.unionByName(prepare.iqr_report(table(spark, sf, "lineitem"), LINES)), 6)


@query("iqr_filter", f"""
    WITH e AS (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN value END AS value, length(props)::DOUBLE AS n FROM events),
    a AS ({_limits_sql('value', 'e')}), b AS ({_limits_sql('n', 'e')}),
    f AS (SELECT quantile_cont(n, 0.75) - quantile_cont(n, 0.25) = 0 AS flat FROM e)
    SELECT event_id, value FROM e, a, b, f
    WHERE (value IS NULL OR value BETWEEN a.lo AND a.hi) AND (flat OR n BETWEEN b.lo AND b.hi)
""")
def iqr_filter(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", null_every("event_id", 13, "value"), F.length("props").cast("double").alias("n")
    )
    return prepare.iqr_filter(e, ["value", "n"]).select("event_id", "value")


@query("zscore_outliers", """
    WITH z AS (SELECT event_id, abs((value - AVG(value) OVER ()) / stddev_pop(value) OVER ()) > 3 AS v,
        abs((length(props) - AVG(length(props)) OVER ()) / stddev_pop(length(props)) OVER ()) > 3 AS n FROM events)
    SELECT event_id, v::BIGINT AS value_out, n::BIGINT AS n_out, (v OR n)::BIGINT AS any_out FROM z
""")
def zscore_outliers(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value", F.length("props").alias("n"))
    return as_long(prepare.zscore_flags(e, ["value", "n"]).select("event_id", "value_out", "n_out", "any_out"))


@query("winsorize", """
    WITH e AS (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN value END AS value FROM events),
    q AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM e)
    SELECT event_id, ROUND(CASE WHEN value IS NOT NULL THEN least(greatest(value, lo), hi) END, 6) AS value FROM e, q
""")
def winsorize(spark, sf):
    e = table(spark, sf, "events").select("event_id", null_every("event_id", 13, "value"))
    return rounded(prepare.winsorize(e, ["value"]), 6)


@query("skew_log", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", ROUND(skewness({e}), 5) AS skew, (abs(skewness({e})) > 1)::BIGINT AS logged,
           ROUND(CASE WHEN abs(skewness({e})) > 1 THEN skewness(ln(1 + {e})) END, 5) AS skew_after FROM {t}"""
    for c, e, t in (("value", "value", "events"), ("l_extendedprice", "l_extendedprice", "lineitem"),
                    ("n_chars", "n_chars::DOUBLE", "documents"))))
def skew_log(spark, sf):
    parts = None
    for c, t in (("value", "events"), ("l_extendedprice", "lineitem"), ("n_chars", "documents")):
        df, skew = prepare.log_if_skewed(table(spark, sf, t), [c])
        logged = f"{c}_log1p" in df.columns
        after = prepare.unbiased_skewness(f"{c}_log1p") if logged else F.lit(None).cast("double")
        row = df.agg(after.alias("skew_after")).select(
            F.lit(c).alias("column"), F.lit(skew[c]).alias("skew"), F.lit(int(logged)).cast("long").alias("logged"), "skew_after")
        parts = row if parts is None else parts.unionByName(row)
    return rounded(parts, 5)


@query("scale_standard", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, " + ", ".join(
    f"ROUND(({c} - (SELECT AVG({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 6) + 0.0 AS {c}" for c in LINES
) + " FROM lineitem")
def scale_standard(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINES)
    return as_long(rounded(prepare.fit_standard(li, LINES, ddof=0).transform(li), 6))


ORDER_YEARS_SQL = """(SELECT o_custkey, year(o_orderdate) AS yr, COUNT(*)::DOUBLE AS n_orders, AVG(o_totalprice) AS price,
    MAX(o_orderpriority) AS top FROM orders GROUP BY 1, 2)"""


@query("zscore_panel", f"""
    WITH p AS (SELECT * FROM {ORDER_YEARS_SQL})
    SELECT o_custkey, ROUND((yr - (SELECT AVG(yr) FROM p)) / (SELECT stddev_samp(yr) FROM p), 6) + 0.0 AS yr_scaled,
           ROUND((n_orders - (SELECT AVG(n_orders) FROM p)) / (SELECT stddev_samp(n_orders) FROM p), 6) + 0.0 AS n_orders_scaled,
           ROUND((price - (SELECT AVG(price) FROM p)) / (SELECT stddev_samp(price) FROM p), 6) + 0.0 AS price_scaled,
           {", ".join(f'''(top = '{v}')::BIGINT AS "top_{v}"''' for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))}
    FROM p
""")
def zscore_panel(spark, sf):
    o = table(spark, sf, "orders")
    panel = o.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"), F.avg("o_totalprice").alias("price"),
        F.max("o_orderpriority").alias("top"))
    scaled = prepare.fit_standard(panel, ["yr", "n_orders", "price"], ddof=1).transform(panel, "_scaled")
    levels = prepare.fit_levels(panel, ["top"])
    return as_long(rounded(prepare.one_hot(scaled, levels).drop("yr", "n_orders", "price"), 6))


@query("scale_minmax", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, " + ", ".join(
    f"ROUND(({c} - (SELECT MIN({c}) FROM lineitem)) / (SELECT MAX({c}) - MIN({c}) FROM lineitem), 6) AS {c}" for c in LINES
) + ", 0.0::DOUBLE AS flat FROM lineitem")
def scale_minmax(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINES, F.lit(7.0).alias("flat"))
    return as_long(rounded(prepare.fit_minmax(li, [*LINES, "flat"]).transform(li), 6))


@query("scale_robust", "WITH t AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01') SELECT l_orderkey, "
       "l_linenumber::BIGINT AS l_linenumber, " + ", ".join(
    f"""ROUND(({c} - (SELECT quantile_cont({c}, 0.5) FROM t)) /
        (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM t), 6) + 0.0 AS {c}""" for c in LINES
) + " FROM lineitem")
def scale_robust(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", *LINES)
    train = li.where(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp"))
    return as_long(rounded(prepare.fit_robust(train, LINES).transform(li).drop("l_shipdate"), 6))


@query("scale_roundtrip", """
    SELECT p_partkey, ROUND(p_retailprice, 6) AS restored,
           ROUND((p_retailprice - (SELECT AVG(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part), 6) + 0.0 AS z
    FROM part
""")
def scale_roundtrip(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    unit = prepare.fit_minmax(p, ["p_retailprice"])
    back = unit.inverse(unit.transform(p)).withColumnRenamed("p_retailprice", "restored")
    z = prepare.fit_standard(p.withColumnRenamed("p_retailprice", "restored"), ["restored"])
    return rounded(back.withColumn("z", z.scaled("restored")), 6)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("onehot_dropfirst", f"""SELECT c_custkey, {", ".join(
    f"COALESCE((c_mktsegment = '{s}')::INT, 0)::BIGINT AS c_mktsegment_{s}" for s in SEGMENTS[1:])} FROM {CUSTOMER_SQL}""")
def onehot_dropfirst(spark, sf):
    c = gappy_customers(spark, sf).select("c_custkey", "c_mktsegment")
    return as_long(prepare.one_hot(c, prepare.fit_levels(c, ["c_mktsegment"]), drop_first=True))


@query("onehot_full", f"""SELECT c_custkey, {", ".join(
    f"COALESCE((c_mktsegment = '{s}')::INT, 0)::BIGINT AS c_mktsegment_{s}" for s in SEGMENTS)} FROM {CUSTOMER_SQL}""")
def onehot_full(spark, sf):
    c = gappy_customers(spark, sf).select("c_custkey", "c_mktsegment")
    return as_long(prepare.one_hot(c, prepare.fit_levels(c, ["c_mktsegment"])))


@query("label_encode", """
    SELECT p_partkey, p_name, (dense_rank() OVER (ORDER BY p_name) - 1)::BIGINT AS name_code,
           (dense_rank() OVER (ORDER BY p_size::VARCHAR) - 1)::BIGINT AS size_code FROM part
""")
def label_encode(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", F.col("p_size").cast("string").alias("p_size"))
    named = prepare.encode_levels(p, prepare.level_codes(p, "p_name", "name_code"), "p_name", "name_code")
    return prepare.encode_levels(
        named, prepare.level_codes(p, "p_size", "size_code"), "p_size", "size_code"
    ).drop("p_size")


@query("ordinal_unknown", """
    WITH k AS (SELECT c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code
               FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment <> 'FURNITURE' AND c_custkey % 2 = 0))
    SELECT c_custkey, COALESCE(code, -1)::BIGINT AS segment_code FROM customer LEFT JOIN k USING (c_mktsegment)
""")
def ordinal_unknown(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    train = c.where((F.col("c_custkey") % 2 == 0) & (F.col("c_mktsegment") != "FURNITURE"))
    codes = prepare.level_codes(train, "c_mktsegment", "segment_code")
    return prepare.encode_levels(c, codes, "c_mktsegment", "segment_code", unknown=-1).drop("c_mktsegment")


@query("binary_encode", """
    WITH k AS (SELECT p_name, row_number() OVER (ORDER BY MIN(p_partkey)) - 1 AS code FROM part GROUP BY 1),
    b AS (SELECT p_partkey, code FROM part JOIN k USING (p_name))
    SELECT p_partkey, code::BIGINT AS name_code, string_agg((code >> i) & 1, '' ORDER BY i) AS bits
    FROM b, range((SELECT ceil(log2(MAX(code) + 1))::BIGINT FROM b)) t(i) GROUP BY 1, 2
""")
def binary_encode(spark, sf):
    coded, bits = prepare.bit_codes(table(spark, sf, "part"), "p_name", "p_partkey", "name")
    return coded.select(
        "p_partkey", "name_code",
        F.concat(*[F.col(f"name_bin_{b}").cast("string") for b in range(bits)]).alias("bits"),
    )


@query("multihot_tokens", """
    SELECT DISTINCT p_partkey, trim(unnest(string_split(p_name || ', ' || p_type, ','))) AS token FROM part
""")
def multihot_tokens(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(", "), "p_type").alias("answers"))
    return prepare.hot_tokens(p, "answers", "p_partkey", ",")


@query("rare_class_drop", """
    WITH d AS (SELECT doc_id, n_chars // 400 AS size_class FROM documents)
    SELECT doc_id, size_class FROM d WHERE size_class IN (SELECT size_class FROM d GROUP BY 1 HAVING COUNT(*) >= 2)
""")
def rare_class_drop(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.floor(F.col("n_chars") / 400).alias("size_class"))
    return prepare.drop_rare(d, "size_class").select("doc_id", "size_class")


@query("rare_fold", """
    WITH d AS (SELECT p_partkey, p_name, COUNT(*) OVER (PARTITION BY p_name) AS n FROM part)
    SELECT p_partkey, CASE WHEN n < 85 THEN 'Rare' ELSE p_name END AS p_name FROM d
""")
def rare_fold(spark, sf):
    return prepare.fold_rare(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", 85)


@query("prep_columnwise", """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS price,
                      CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderstatus = 'F')::INT END AS closed,
                      o_orderdate < TIMESTAMP '2000-01-01' AS train FROM orders),
    m AS (SELECT quantile_cont(price, 0.5) AS med FROM o WHERE train),
    f AS (SELECT o.*, COALESCE(price, med) AS filled FROM o, m),
    q AS (SELECT quantile_cont(filled, 0.5) AS med, quantile_cont(filled, 0.75) - quantile_cont(filled, 0.25) AS iqr FROM f WHERE train),
    k AS (SELECT closed AS mode FROM o WHERE train AND closed IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, closed LIMIT 1)
    SELECT o_orderkey, ROUND((filled - q.med) / iqr, 6) + 0.0 AS price, COALESCE(closed, mode)::BIGINT AS closed,
           CASE WHEN train THEN 'train' ELSE 'test' END AS split FROM f, q, k
""")
def prep_columnwise(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 13 != 0, (F.col("o_orderstatus") == "F").cast("int")).alias("closed"), "o_orderdate")
    o = split.time_split(o, "o_orderdate", [F.lit("2000-01-01").cast("timestamp")], ["train", "test"]).drop("o_orderdate")
    model = prepare.fit_preparation(o.where("split = 'train'"), ["price"], ["closed"])
    return as_long(rounded(model.transform(o), 6))


@query("join_left_encoded", """
    SELECT o_orderkey, (o_orderstatus = 'O')::BIGINT AS "o_orderstatus_O", (o_orderstatus = 'P')::BIGINT AS "o_orderstatus_P",
           (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::BIGINT AS priority_code, c_mktsegment
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 3 <> 0
""")
def join_left_encoded(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    hot = prepare.one_hot(o, prepare.fit_levels(o, ["o_orderstatus"]), drop_first=True)
    coded = prepare.encode_levels(
        hot, prepare.level_codes(o, "o_orderpriority", "priority_code"), "o_orderpriority", "priority_code")
    c = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return as_long(coded.join(c, "o_custkey", "left").drop("o_custkey", "o_orderpriority"))
