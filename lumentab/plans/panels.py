"""Returns, two-period rules, trends, weighted ranking, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumentab.operators import panel, prepare, split
from lumentab.plans.registry import as_long, query, rounded, table


@query("returns", """
    WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 17 <> 0 THEN value END AS v FROM events),
    f AS (SELECT event_id, user_id, ts, COALESCE(v, (SELECT quantile_cont(v, 0.5) FROM e)) AS value FROM e),
    r AS (SELECT *, value / NULLIF(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) - 1 AS ret FROM f)
    SELECT event_id, user_id, ROUND(value, 6) AS value, ROUND(COALESCE(ret, 0), 9) AS value_ret,
           ROUND(COALESCE(ln(1 + ret), 0), 9) AS value_logret FROM r
""")
def returns(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("value"))
    out = panel.with_returns(e, ["user_id"], "ts", ["value"], ["event_id"], period="day").drop("ts")
    return rounded(rounded(out, 6, "value"), 9, "value_ret", "value_logret")


@query("returns_global", """
    WITH e AS (SELECT event_id, ts, CASE WHEN event_id % 17 <> 0 THEN value END AS v FROM events),
    f AS (SELECT event_id, ts, COALESCE(v, (SELECT quantile_cont(v, 0.5) FROM e)) AS value FROM e),
    r AS (SELECT *, value / NULLIF(lag(value) OVER (ORDER BY ts, event_id), 0) - 1 AS ret FROM f)
    SELECT event_id, ROUND(value, 6) AS value, ROUND(COALESCE(ret, 0), 9) AS value_ret, ROUND(COALESCE(ln(1 + ret), 0), 9) AS value_logret FROM r
""")
def returns_global(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("value"))
    out = panel.with_returns(e, [], "ts", ["value"], ["event_id"]).drop("ts")
    return rounded(rounded(out, 6, "value"), 9, "value_ret", "value_logret")


NATION_YEARS_SQL = """
    y AS (SELECT c_nationkey AS unit, year(o_orderdate) AS yr, COUNT(*)::DOUBLE AS n_orders, AVG(o_totalprice) AS price,
                 AVG((o_orderstatus = 'F')::DOUBLE) AS closed, AVG(c_acctbal) AS balance,
                 (AVG(o_totalprice) > (SELECT AVG(o_totalprice) FROM orders))::BIGINT AS label
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    g AS (SELECT unit, yr, label, n_orders, balance, CASE WHEN (unit + yr) % 7 <> 0 THEN price END AS price,
                 CASE WHEN (unit * yr) % 11 <> 0 THEN closed END AS closed FROM y)"""
SCORES_SQL = f"""WITH {NATION_YEARS_SQL},
    m AS (SELECT unit, quantile_cont(price, 0.5) AS price_m, quantile_cont(closed, 0.5) AS closed_m FROM g GROUP BY 1),
    i AS (SELECT unit, yr, label, n_orders, balance, COALESCE(price, price_m) AS price, COALESCE(closed, closed_m) AS closed
          FROM g JOIN m USING (unit)),
    f AS (SELECT unit, yr, label, n_orders, balance, COALESCE(price, (SELECT quantile_cont(price, 0.5) FROM i)) AS price,
                 COALESCE(closed, (SELECT quantile_cont(closed, 0.5) FROM i)) AS closed FROM i),
    b AS (SELECT MIN(n_orders) AS a0, MAX(n_orders) AS a1, MIN(price) AS p0, MAX(price) AS p1, MIN(closed) AS c0, MAX(closed) AS c1,
                 MIN(balance) AS b0, MAX(balance) AS b1 FROM f),
    s AS (SELECT unit, yr, label, 0.30::DOUBLE * (n_orders - a0) / (a1 - a0) + 0.30::DOUBLE * (price - p0) / (p1 - p0)
                 + 0.25::DOUBLE * (1 - (closed - c0) / (c1 - c0)) + 0.15::DOUBLE * (1 - (balance - b0) / (b1 - b0)) AS score FROM f, b),
    r AS (SELECT unit, AVG(score) AS score_mean, stddev_samp(score) AS score_std, COUNT(*) AS n,
                 AVG((label = 0)::DOUBLE) * 100 AS label_0_pct, AVG((label = 1)::DOUBLE) * 100 AS label_1_pct,
                 COALESCE(regr_slope(score, yr), 0) AS trend FROM s GROUP BY 1)"""
# An example of weights: two indicators where more is better, two where less is.
INDICATORS = (
    panel.Indicator("n_orders", 0.30), panel.Indicator("price", 0.30),
    panel.Indicator("closed", 0.25, False), panel.Indicator("balance", 0.15, False),
)


def nation_years(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    overall = o.select(F.avg("o_totalprice")).scalar()
    y = (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(F.col("c_nationkey").alias("unit"), F.year("o_orderdate").alias("yr"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("n_orders"), F.avg("o_totalprice").alias("price"),
            F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("closed"), F.avg("c_acctbal").alias("balance"))
    )
    return y.select(
        "unit", "yr", (F.col("price") > overall).cast("long").alias("label"), "n_orders", "balance",
        F.when((F.col("unit") + F.col("yr")) % 7 != 0, F.col("price")).alias("price"),
        F.when((F.col("unit") * F.col("yr")) % 11 != 0, F.col("closed")).alias("closed"))


def ranked(spark, sf):
    # The panel is a short aggregate read by several fits: keep it instead of joining again.
    years = nation_years(spark, sf).persist()
    return panel.rank_units(panel.score_rows(years, "unit", INDICATORS), "unit", "yr", "label")


@query("rank_score", SCORES_SQL + """
    SELECT unit::BIGINT AS unit, ROUND(score_mean, 6) AS score_mean, ROUND(score_std, 6) AS score_std, n::BIGINT AS n,
           ROUND(label_0_pct, 4) AS label_0_pct, ROUND(label_1_pct, 4) AS label_1_pct, ROUND(trend, 6) + 0.0 AS trend,
           row_number() OVER (ORDER BY score_mean, unit)::BIGINT AS ranking FROM r
""")
def rank_score(spark, sf):
    return as_long(rounded(rounded(ranked(spark, sf), 6, "score_mean", "score_std", "trend"), 4, "label_0_pct", "label_1_pct"))


@query("rank_verdict", SCORES_SQL + """
    SELECT unit::BIGINT AS unit, CASE WHEN trend > 0.005 THEN '↑ mejora' WHEN trend < -0.005 THEN '↓ empeora' ELSE '→ estable' END AS direction,
           CASE WHEN score_mean < 0.40 THEN 1 ELSE 0 END::BIGINT AS at_risk,
           CASE WHEN score_mean < 0.35 THEN 'ECHAR — desempeño critico, sin mejora'
                WHEN score_mean < 0.40 AND trend < 0 THEN 'ECHAR — en riesgo y empeorando'
                WHEN score_mean < 0.40 THEN 'ADVERTENCIA — en riesgo pero mejorando, dar seguimiento'
                WHEN score_mean < 0.55 THEN 'SEGUIMIENTO — desempeño moderado' ELSE 'OK — desempeño saludable' END AS verdict FROM r
""")
def rank_verdict(spark, sf):
    s, t = F.col("score_mean"), F.col("trend")
    return as_long(ranked(spark, sf).select(
        "unit", panel.trend_text(t).alias("direction"),
        (s < panel.RISK_LIMIT).cast("int").alias("at_risk"), panel.verdict(s, t).alias("verdict")))


@query("rank_detail", SCORES_SQL + """,
    w AS (SELECT unit FROM r ORDER BY score_mean, unit LIMIT 3),
    l AS (SELECT unit, 'n_orders' AS indicator, n_orders AS v, 1 AS up FROM f UNION ALL SELECT unit, 'price', price, 1 FROM f
          UNION ALL SELECT unit, 'closed', closed, 0 FROM f UNION ALL SELECT unit, 'balance', balance, 0 FROM f),
    o AS (SELECT indicator, AVG(v) AS overall FROM l GROUP BY 1)
    SELECT unit::BIGINT AS unit, indicator, ROUND(AVG(v), 4) AS unit_mean, ROUND(MAX(overall), 4) AS overall_mean,
           CASE WHEN MAX(up) = 1 THEN AVG(v) < MAX(overall) ELSE AVG(v) > MAX(overall) END::BIGINT AS flagged
    FROM l JOIN o USING (indicator) WHERE unit IN (SELECT unit FROM w) GROUP BY 1, 2
""")
def rank_detail(spark, sf):
    years = nation_years(spark, sf).persist()
    scored = panel.score_rows(years, "unit", INDICATORS).persist()
    ranking = panel.rank_units(scored, "unit", "yr", "label")
    return as_long(rounded(panel.worst_unit_detail(scored, ranking, "unit", INDICATORS), 4))


@query("rank_heat", SCORES_SQL + """,
    u AS (SELECT unit, AVG(n_orders) AS n_orders, AVG(price) AS price, AVG(closed) AS closed, AVG(balance) AS balance FROM f GROUP BY 1)
    SELECT unit::BIGINT AS unit, ROUND((n_orders - MIN(n_orders) OVER ()) / (MAX(n_orders) OVER () - MIN(n_orders) OVER ()), 6) AS n_orders,
           ROUND((price - MIN(price) OVER ()) / (MAX(price) OVER () - MIN(price) OVER ()), 6) AS price,
           ROUND(1 - (closed - MIN(closed) OVER ()) / (MAX(closed) OVER () - MIN(closed) OVER ()), 6) AS closed,
           ROUND(1 - (balance - MIN(balance) OVER ()) / (MAX(balance) OVER () - MIN(balance) OVER ()), 6) AS balance FROM u
""")
def rank_heat(spark, sf):
    years = nation_years(spark, sf).persist()
    scored = panel.score_rows(years, "unit", INDICATORS)
    return as_long(rounded(panel.heat_table(scored, "unit", INDICATORS), 6))


@query("trend_slope", """
    SELECT o_custkey, ROUND(CASE WHEN COUNT(*) > 1 THEN regr_slope(price, yr) ELSE 0 END, 4) + 0.0 AS slope, COUNT(*)::BIGINT AS n
    FROM (SELECT o_custkey, year(o_orderdate) AS yr, SUM(o_totalprice) AS price FROM orders GROUP BY 1, 2) GROUP BY 1
""")
def trend_slope(spark, sf):
    yearly = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(F.sum("o_totalprice").alias("price"))
    return rounded(yearly.groupBy("o_custkey").agg(
        panel.slope_or_zero("price", "yr").alias("slope"), F.count(F.lit(1)).alias("n")), 4)


@query("group_trend", """
    SELECT year(o_orderdate)::BIGINT AS yr, o_orderpriority, ROUND(AVG(o_totalprice), 4) AS mean_price FROM orders GROUP BY 1, 2
""")
def group_trend(spark, sf):
    return as_long(rounded(
        table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("yr"), "o_orderpriority")
        .agg(F.avg("o_totalprice").alias("mean_price")).orderBy("yr", "o_orderpriority"), 4))


@query("rule_two_period", """
    WITH y AS (SELECT o_custkey, year(o_orderdate) AS yr, SUM(o_totalprice) - 600000 AS surplus, COUNT(*) AS n FROM orders GROUP BY 1, 2)
    SELECT o_custkey, yr::BIGINT AS yr, (COALESCE(surplus < 0 AND lag(surplus) OVER (PARTITION BY o_custkey ORDER BY yr) < 0, FALSE)
           OR n < 1 OR surplus < -580000)::BIGINT AS rule FROM y
""")
def rule_two_period(spark, sf):
    y = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        (F.sum("o_totalprice") - 600000).alias("surplus"), F.count(F.lit(1)).alias("n"))
    flagged = panel.two_period_rule(y, ["o_custkey"], "yr", "surplus", [F.col("n") < 1, F.col("surplus") < -580000])
    return as_long(flagged.select("o_custkey", "yr", "rule"))


def _split_sql(source, key, cuts, names, by=None, cols="", seed=42):
    part = f"PARTITION BY {by} " if by else ""
    steps = " ".join(f"WHEN pos < floor({c}::DOUBLE * n) THEN '{n}'" for c, n in zip(cuts, names))
    return f"""SELECT {key}{cols}, CASE {steps} ELSE '{names[-1]}' END AS split FROM (
        SELECT *, row_number() OVER ({part}ORDER BY md5('{seed}:' || {key}::VARCHAR), {key}) - 1 AS pos,
               COUNT(*) OVER ({part}) AS n FROM {source})"""


@query("split_random", _split_sql("orders", "o_orderkey", (0.8,), ("train", "test")))
def split_random(spark, sf):
    return split.hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", (0.8, 0.2), ("train", "test"))


@query("split_strat2", _split_sql("labels", "doc_id", (0.7,), ("train", "test"), "quality", ", quality::BIGINT AS quality"))
def split_strat2(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return as_long(split.stratified_split(labels, "doc_id", "quality", (0.7, 0.3), ("train", "test")))


@query("split_strat3", _split_sql("orders", "o_orderkey", (0.7, 0.85), ("train", "valid", "test"), "o_orderpriority", ", o_orderpriority"))
def split_strat3(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return split.stratified_split(o, "o_orderkey", "o_orderpriority", (0.7, 0.15, 0.15), ("train", "valid", "test"))


@query("split_temporal", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train'
        WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'valid' ELSE 'test' END AS split FROM orders
""")
def split_temporal(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 19 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    limits = [F.lit(d).cast("timestamp") for d in ("1999-01-01", "2000-01-01")]
    return split.time_split(o, "o_orderdate", limits, ("train", "valid", "test")).drop("o_orderdate")


@query("kfold_assign", """
    SELECT doc_id, toxic::BIGINT AS toxic,
           ((row_number() OVER (PARTITION BY toxic ORDER BY md5('42:' || doc_id::VARCHAR), doc_id) - 1) % 5)::BIGINT AS fold FROM labels
""")
def kfold_assign(spark, sf):
    return as_long(split.fold_numbers(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", 5, "toxic"))
