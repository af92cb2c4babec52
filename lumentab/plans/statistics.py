"""Group statistics, chart tables, correlation, rank tests, simple regression."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from lumentab.operators import order, profile, stats
from lumentab.plans.registry import as_long, query, rounded, table

LINES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATUSES = ("F", "O", "P")


@query("group_mean", """
    SELECT c_mktsegment, ROUND(AVG(o_totalprice), 4) AS mean_price
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def group_mean(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return rounded(o.join(c, o.o_custkey == c.c_custkey).groupBy("c_mktsegment").agg(
        F.avg("o_totalprice").alias("mean_price")), 4)


@query("group_multi", """
    SELECT o_orderpriority, ROUND(AVG(o_totalprice), 4) AS price_mean, ROUND(stddev_samp(o_totalprice), 4) AS price_std,
           COUNT(o_totalprice)::BIGINT AS price_count, ROUND(AVG((o_orderstatus = 'F')::DOUBLE) * 100, 4) AS closed_pct,
           ROUND(AVG((o_orderstatus = 'O')::DOUBLE) * 100, 4) AS open_pct
    FROM orders GROUP BY 1
""")
def group_multi(spark, sf):
    return rounded(profile.group_summary(table(spark, sf, "orders"), ["o_orderpriority"], {
        "price_mean": F.avg("o_totalprice"), "price_std": F.stddev_samp("o_totalprice"),
        "price_count": F.count("o_totalprice"),
        "closed_pct": profile.share_pct(F.col("o_orderstatus") == "F"),
        "open_pct": profile.share_pct(F.col("o_orderstatus") == "O"),
    }), 4)


@query("pivot_mean", "SELECT o_orderpriority, " + ", ".join(
    f"ROUND(AVG(o_totalprice) FILTER (o_orderstatus = '{s}'), 4) AS \"{s}\"" for s in STATUSES) + " FROM orders GROUP BY 1")
def pivot_mean(spark, sf):
    return rounded(profile.pivot_mean(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "o_totalprice", STATUSES), 4)


@query("value_counts", """
    WITH d AS (SELECT * FROM (VALUES ('click'),('error'),('purchase'),('refund'),('signup'),('view')) AS t(event_type)),
    n AS (SELECT event_type, COUNT(event_id) AS n FROM d LEFT JOIN events USING (event_type) GROUP BY 1)
    SELECT event_type, n::BIGINT AS n, ROUND(n / (SELECT SUM(n) FROM n)::DOUBLE, 6) AS share,
           ROUND((SELECT MAX(n) FROM n) / NULLIF(n, 0)::DOUBLE, 6) AS majority_ratio FROM n
""")
def value_counts(spark, sf):
    counts = profile.value_counts(
        table(spark, sf, "events"), "event_type", ["click", "error", "purchase", "refund", "signup", "view"])
    top = counts.agg(F.max("n")).scalar()
    return rounded(counts.withColumn("majority_ratio", top / F.nullif("n", F.lit(0))), 6)


@query("histogram_bins", """
    WITH e AS (SELECT event_type, value, (SELECT MIN(value) FROM events) AS lo, (SELECT MAX(value) FROM events) AS hi FROM events)
    SELECT event_type, least(floor((value - lo) / ((hi - lo) / 25)), 24)::BIGINT AS bin,
           ROUND(MIN(lo) + least(floor((value - lo) / ((hi - lo) / 25)), 24) * ((MIN(hi) - MIN(lo)) / 25), 5) AS lo,
           ROUND(MIN(lo) + (least(floor((value - lo) / ((hi - lo) / 25)), 24) + 1) * ((MIN(hi) - MIN(lo)) / 25), 5) AS hi,
           COUNT(*)::BIGINT AS n
    FROM e GROUP BY event_type, least(floor((value - lo) / ((hi - lo) / 25)), 24)
""")
def histogram_bins(spark, sf):
    return as_long(rounded(profile.histogram(table(spark, sf, "events"), "value", 25, ["event_type"]), 5))


@query("boxplot_stats", """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                      quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
    SELECT event_type, ROUND(q1, 5) AS q1, ROUND(median, 5) AS median, ROUND(q3, 5) AS q3,
           MIN(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
           MAX(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
           count(*) FILTER (value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::BIGINT AS outliers
    FROM events JOIN q USING (event_type) GROUP BY event_type, q1, median, q3
""")
def boxplot_stats(spark, sf):
    return rounded(profile.box_stats(table(spark, sf, "events"), "value", ["event_type"]), 5, "q1", "median", "q3")


@query("kde_grid", """
    WITH s AS (SELECT COUNT(*) AS n, pow(COUNT(*), -0.2::DOUBLE) * stddev_samp(value) AS h FROM events)
    SELECT ROUND(x, 6) AS x, ROUND(SUM(exp(-0.5::DOUBLE * pow((value - x) / h, 2))) / (MIN(n) * MIN(h) * sqrt(2 * pi())), 9) AS density
    FROM events, s, (SELECT lo + i * ((hi - lo) / 40) AS x FROM range(41) t(i), (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events)) GROUP BY x
""")
def kde_grid(spark, sf):
    events = table(spark, sf, "events")
    low, high = events.agg(F.min("value"), F.max("value")).first()
    curve = profile.density_curve(events, "value", [low + i * ((high - low) / 40) for i in range(41)])
    return rounded(rounded(curve, 9, "density"), 6, "x")


def _pairs_sql(cols, source, digits=6):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, ROUND(corr({a}, {b}), {digits}) AS r FROM {source}" for a, b in combinations(cols, 2))


GAPPY_SQL = """(SELECT CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS l_quantity, l_extendedprice,
    CASE WHEN l_orderkey % 7 <> 0 THEN l_discount END AS l_discount, l_tax FROM lineitem)"""


def gappy_lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity")).alias("l_quantity"), "l_extendedprice",
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_discount")).alias("l_discount"), "l_tax")


@query("corr_pearson", f"""
    WITH p AS ({_pairs_sql(LINES, GAPPY_SQL)})
    SELECT * FROM p UNION ALL SELECT b, a, r FROM p
    UNION ALL SELECT c, c, 1.0 FROM (VALUES {", ".join(f"('{c}')" for c in LINES)}) AS t(c)
""")
def corr_pearson(spark, sf):
    return stats.full_matrix(rounded(stats.pearson_pairs(gappy_lines(spark, sf), LINES), 6), LINES)


@query("corr_pairs", f"SELECT * FROM ({_pairs_sql(LINES, 'lineitem')}) WHERE abs(r) > 0.5")
def corr_pairs(spark, sf):
    return stats.joint_pairs_above(rounded(stats.pearson_pairs(table(spark, sf, "lineitem"), LINES), 6), 0.5)


@query("corr_spearman", f"""
    WITH r AS (SELECT {", ".join(
        f"rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in LINES)} FROM lineitem)
    {_pairs_sql(LINES, 'r')}
""")
def corr_spearman(spark, sf):
    return rounded(stats.spearman_pairs(table(spark, sf, "lineitem"), LINES), 6)


def _pair_ranks_sql(a, b):
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in (a, b))
    return f"SELECT '{a}' AS a, '{b}' AS b, ROUND(corr({a}, {b}), 6) AS r FROM (SELECT {ranks} FROM {GAPPY_SQL} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"


@query("corr_spearman_gaps", " UNION ALL ".join(_pair_ranks_sql(a, b) for a, b in combinations(LINES, 2)))
def corr_spearman_gaps(spark, sf):
    return rounded(stats.spearman_pairs(gappy_lines(spark, sf), LINES), 6)


TARGETS = ("o_totalprice", "n_lines", "quantity", "discount")
ORDER_LINES_SQL = """(SELECT o_totalprice, COUNT(*)::DOUBLE AS n_lines, SUM(l_quantity) AS quantity, ROUND(AVG(l_discount), 9) AS discount,
    MAX((o_orderstatus = 'F')::INT) AS closed FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_totalprice)"""


def order_lines(spark, sf):
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("quantity"), F.round(F.avg("l_discount"), 9).alias("discount"))
    o = table(spark, sf, "orders")
    return o.join(li, o.o_orderkey == li.l_orderkey).select(
        "o_totalprice", "n_lines", "quantity", "discount", (F.col("o_orderstatus") == "F").cast("int").alias("closed"))


@query("corr_target_rank", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", ROUND(corr({c}, closed), 6) AS r FROM {ORDER_LINES_SQL}" for c in TARGETS))
def corr_target_rank(spark, sf):
    return rounded(stats.target_ranking(order_lines(spark, sf), TARGETS, "closed"), 6)


@query("topk_corr", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", ROUND(corr({c}, l_extendedprice), 6) AS r FROM lineitem"
    for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey")) + ") ORDER BY abs(r) DESC LIMIT 2")
def topk_corr(spark, sf):
    return rounded(stats.target_ranking(
        table(spark, sf, "lineitem"), ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey"), "l_extendedprice", 2), 6)


@query("extreme_columns", """
    SELECT 'l_extendedprice' AS max_column, ROUND(AVG(l_extendedprice), 4) AS max_mean,
           CASE WHEN AVG(l_tax) <= AVG(l_discount) THEN 'l_tax' ELSE 'l_discount' END AS min_column,
           ROUND(least(AVG(l_tax), AVG(l_discount)), 4) AS min_mean FROM lineitem
""")
def extreme_columns(spark, sf):
    return rounded(profile.extreme_columns(table(spark, sf, "lineitem"), LINES), 4)


@query("prevalence", """
    SELECT source, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, COUNT(*)::BIGINT AS n,
           SUM(quality)::BIGINT AS positives, ROUND(AVG(quality), 6) AS rate
    FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2
""")
def prevalence(spark, sf):
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    split = F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train").alias("split")
    return rounded(rows.groupBy("source", split).agg(
        F.count(F.lit(1)).alias("n"), F.sum("quality").alias("positives"), F.avg("quality").alias("rate")), 6)


@query("label_before_after", """
    WITH x AS (SELECT o_orderpriority AS before,
        CASE WHEN o_orderkey % 4 = 0 THEN '0-NEW' WHEN o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS after FROM orders),
    a AS (SELECT before AS label, COUNT(*) AS n FROM x GROUP BY 1), b AS (SELECT after AS label, COUNT(*) AS n FROM x GROUP BY 1)
    SELECT label, COALESCE(a.n, 0)::BIGINT AS original, COALESCE(b.n, 0)::BIGINT AS corrected FROM a FULL JOIN b USING (label)
""")
def label_before_after(spark, sf):
    from lumentab.operators.audit import before_after

    after = (
        F.when(F.col("o_orderkey") % 4 == 0, "0-NEW").when(F.col("o_orderpriority") == "5-LOW", "4-NOT SPECIFIED")
        .otherwise(F.col("o_orderpriority")))
    return before_after(table(spark, sf, "orders").withColumn("after", after), "o_orderpriority", "after")


@query("avg_rank", """
    SELECT DISTINCT l_extendedprice, COUNT(*) OVER (PARTITION BY l_extendedprice)::BIGINT AS n,
           rank() OVER (ORDER BY l_extendedprice) + (COUNT(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS "rank"
    FROM lineitem
""")
def avg_rank(spark, sf):
    return order.average_ranks(table(spark, sf, "lineitem"), "l_extendedprice").select("l_extendedprice", "n", "rank")


def _mw_sql(cols):
    one = """
    SELECT "column", u, ROUND(z, 5) AS z, ROUND(exp(-x * x) * t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))), 4) + 0.0 AS p
    FROM (SELECT *, abs(z) / sqrt(2::DOUBLE) AS x, 1 / (1 + 0.3275911::DOUBLE * abs(z) / sqrt(2::DOUBLE)) AS t FROM (
    SELECT '{c}' AS "column", u, sign(u - m) * greatest(abs(u - m) - 0.5, 0) / sqrt(n0 * n1 / 12 * ((n + 1) - ties / (n * (n - 1)))) AS z
    FROM (SELECT SUM(rk) FILTER (closed = 0) - n0 * (n0 + 1) / 2 AS u, n0 * n1 / 2 AS m, n0, n1, n0 + n1 AS n,
                 (SELECT SUM(k * k * k - k) FROM (SELECT COUNT(*)::DOUBLE AS k FROM s GROUP BY {c})) AS ties
          FROM (SELECT closed, rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS rk,
                       (SELECT count(*) FILTER (closed = 0)::DOUBLE FROM s) AS n0, (SELECT count(*) FILTER (closed = 1)::DOUBLE FROM s) AS n1 FROM s)
          GROUP BY n0, n1)))"""
    return f"WITH s AS MATERIALIZED (SELECT * FROM {ORDER_LINES_SQL}) " + " UNION ALL ".join(one.format(c=c) for c in cols)


@query("mannwhitney", _mw_sql(TARGETS))
def mannwhitney(spark, sf):
    return rounded(rounded(stats.mann_whitney(order_lines(spark, sf), TARGETS, "closed"), 5, "z"), 4, "p")


@query("vif")
def vif(spark, sf):
    return rounded(stats.variance_inflation(table(spark, sf, "lineitem"), LINES), 6)


@query("vif_pair", """
    WITH g AS (SELECT SUM(l_quantity * l_quantity) AS a, SUM(l_tax * l_tax) AS b, SUM(l_quantity * l_tax) AS c FROM lineitem),
    v AS (SELECT 1 / (1 - c * c / (a * b)) AS vif FROM g)
    SELECT k AS "column", ROUND(vif, 6) AS vif, CASE WHEN vif > 10 THEN 'high' WHEN vif > 5 THEN 'moderate' ELSE 'low' END AS band
    FROM v, (VALUES ('l_quantity'), ('l_tax')) t(k)
""")
def vif_pair(spark, sf):
    return rounded(stats.variance_inflation(table(spark, sf, "lineitem"), ["l_quantity", "l_tax"]), 6)


@query("ols_simple", """
    SELECT l_returnflag, ROUND(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
           ROUND(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, ROUND(regr_r2(l_extendedprice, l_quantity), 6) AS r2
    FROM lineitem GROUP BY 1
""")
def ols_simple(spark, sf):
    return rounded(rounded(stats.simple_regression(
        table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"]), 6, "r2"), 4, "slope", "intercept")
