"""Exact metrics over scored tables.

The scored table is every labelled document with a score from its length, so results are
deterministic and can be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lumentab.operators import evaluate as ev
from lumentab.plans.registry import ORACLES, as_long, query, rounded, table

SCORED_SQL = """s AS (SELECT doc_id, quality, toxic, lang, n_chars / (n_chars + 1500.0::DOUBLE) AS prob,
        CASE WHEN doc_id % 5 = 0 THEN 'test' WHEN doc_id % 5 = 1 THEN 'valid' ELSE 'train' END AS split
      FROM labels JOIN documents USING (doc_id))"""


def scored(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    k = F.col("doc_id") % 5
    return table(spark, sf, "labels").join(d, "doc_id").select(
        "doc_id", "quality", "toxic", "lang", (F.col("n_chars") / (F.col("n_chars") + 1500.0)).alias("prob"),
        F.when(k == 0, "test").when(k == 1, "valid").otherwise("train").alias("split"))


CLASS_SQL = """c AS (SELECT o_orderkey, o_orderpriority AS y,
        CASE WHEN o_orderkey % 3 = 0 THEN '1-URGENT' WHEN o_orderkey % 7 = 0 THEN '5-LOW' ELSE o_orderpriority END AS p FROM orders)"""


def classified(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("y"),
        F.when(k % 3 == 0, "1-URGENT").when(k % 7 == 0, "5-LOW").otherwise(F.col("o_orderpriority")).alias("p"))


REPORT_SQL = f"""WITH {CLASS_SQL}, k AS (SELECT DISTINCT y AS class FROM c UNION SELECT DISTINCT p FROM c),
    r AS (SELECT class, count(*) FILTER (y = class AND p = class) AS tp, count(*) FILTER (y <> class AND p = class) AS fp,
                 count(*) FILTER (y = class AND p <> class) AS fn FROM k JOIN c ON y = class OR p = class GROUP BY 1),
    m AS (SELECT *, COALESCE(tp / NULLIF(tp + fp, 0)::DOUBLE, 0) AS pr, COALESCE(tp / NULLIF(tp + fn, 0)::DOUBLE, 0) AS re FROM r),
    f AS (SELECT *, COALESCE(2 * pr * re / NULLIF(pr + re, 0), 0) AS f1 FROM m)"""


@query("eval_class_report", REPORT_SQL + """
    SELECT class, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, ROUND(pr, 6) AS "precision", ROUND(re, 6) AS recall,
           ROUND(f1, 6) AS f1, (tp + fn)::BIGINT AS support FROM f
""")
def eval_class_report(spark, sf):
    return rounded(ev.class_report(classified(spark, sf), "y", "p"), 6)


@query("eval_summary", REPORT_SQL + """
    SELECT ROUND(SUM(tp) / SUM(tp + fn)::DOUBLE, 6) AS accuracy, ROUND(AVG(pr), 6) AS macro_precision, ROUND(AVG(re), 6) AS macro_recall,
           ROUND(AVG(f1), 6) AS macro_f1, ROUND(SUM(pr * (tp + fn)) / SUM(tp + fn), 6) AS weighted_precision,
           ROUND(SUM(re * (tp + fn)) / SUM(tp + fn), 6) AS weighted_recall, ROUND(SUM(f1 * (tp + fn)) / SUM(tp + fn), 6) AS weighted_f1 FROM f
""")
def eval_summary(spark, sf):
    return rounded(ev.summary_report(ev.class_report(classified(spark, sf), "y", "p")), 6)


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("eval_confusion", f"WITH {CLASS_SQL} SELECT y, " + ", ".join(
    f"count(*) FILTER (p = '{v}')::BIGINT AS \"pred_{v}\"" for v in PRIORITIES) + " FROM c GROUP BY 1")
def eval_confusion(spark, sf):
    return ev.confusion_matrix(classified(spark, sf), "y", "p", PRIORITIES)


OVR_SQL = """o AS (SELECT c.class, (o_orderpriority = c.class)::INT AS y,
        (o_totalprice * (1 + ascii(c.class) % 3)) - floor(o_totalprice * (1 + ascii(c.class) % 3) / 1000) * 1000 AS score
      FROM orders, (SELECT DISTINCT o_orderpriority AS class FROM orders) c)"""


@query("roc_points", f"""
    WITH {SCORED_SQL}, d AS (SELECT prob, SUM(quality) AS pos, SUM(1 - quality) AS neg FROM s GROUP BY 1),
    w AS (SELECT prob, SUM(pos) OVER (ORDER BY prob DESC) AS tp, SUM(neg) OVER (ORDER BY prob DESC) AS fp,
                 SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM d)
    SELECT ROUND(prob, 9) AS prob, tp::BIGINT AS tp, fp::BIGINT AS fp, ROUND(tp / p::DOUBLE, 6) AS tpr, ROUND(fp / n::DOUBLE, 6) AS fpr,
           ROUND(tp / (tp + fp)::DOUBLE, 6) AS "precision" FROM w
""")
def roc_points(spark, sf):
    return rounded(rounded(ev.roc_points(scored(spark, sf), "quality", "prob"), 9, "prob"), 6, "tpr", "fpr", "precision")


@query("eval_auc", f"""
    WITH {SCORED_SQL}, l AS (SELECT 'quality' AS class, quality AS y, prob FROM s UNION ALL SELECT 'toxic', toxic, prob FROM s
      UNION ALL SELECT 'none', 0, prob FROM s),
    r AS (SELECT class, y, rank() OVER (PARTITION BY class ORDER BY prob) + (COUNT(*) OVER (PARTITION BY class, prob) - 1) / 2.0::DOUBLE AS rk FROM l)
    SELECT class, ROUND((SUM(rk) FILTER (y = 1) - SUM(y) * (SUM(y) + 1) / 2.0::DOUBLE) / NULLIF(SUM(y) * SUM(1 - y), 0)::DOUBLE, 6) AS auc
    FROM r GROUP BY 1
""")
def eval_auc(spark, sf):
    y = {"quality": F.col("quality"), "toxic": F.col("toxic"), "none": F.lit(0)}
    rows = F.array(*[F.struct(F.lit(c).alias("class"), e.alias("y"), F.col("prob")) for c, e in y.items()])
    return rounded(ev.ranking_metrics(scored(spark, sf).select(F.inline(rows)), "y", "prob", ["class"]).drop("ap"), 6)


@query("eval_ap", f"""
    WITH {SCORED_SQL}, d AS (SELECT prob, SUM(quality) AS pos, COUNT(*) AS n FROM s GROUP BY 1),
    w AS (SELECT pos, SUM(pos) OVER (ORDER BY prob DESC) AS tp, SUM(n) OVER (ORDER BY prob DESC) AS called, SUM(pos) OVER () AS p FROM d)
    SELECT ROUND(SUM(pos / p::DOUBLE * tp / called), 6) AS ap FROM w
""")
def eval_ap(spark, sf):
    return rounded(ev.ranking_metrics(scored(spark, sf), "quality", "prob").drop("auc"), 6)


@query("eval_ovr", """
    WITH o AS (SELECT label AS class, (e.label = k.class)::INT AS y, embedding[k.class + 1]::DOUBLE AS score, k.class AS c
               FROM embeddings e, (SELECT DISTINCT label AS class FROM embeddings) k),
    r AS (SELECT c, y, rank() OVER (PARTITION BY c ORDER BY score) + (COUNT(*) OVER (PARTITION BY c, score) - 1) / 2.0::DOUBLE AS rk FROM o)
    SELECT c::BIGINT AS class, ROUND((SUM(rk) FILTER (y = 1) - SUM(y) * (SUM(y) + 1) / 2.0::DOUBLE) / (SUM(y) * SUM(1 - y))::DOUBLE, 6) AS auc
    FROM r GROUP BY 1
""")
def eval_ovr(spark, sf):
    e = table(spark, sf, "embeddings")
    classes = sorted(r["label"] for r in e.select("label").distinct().collect())
    long = ev.one_vs_rest(e, "label", classes, lambda c: F.get("embedding", F.lit(c)))
    return as_long(rounded(ev.ranking_metrics(long, "y", "score", ["class"]).drop("ap"), 6))


@query("eval_prob", f"""
    WITH {SCORED_SQL}
    SELECT ROUND(AVG(pow(prob - quality, 2)), 6) AS brier,
           ROUND(-AVG(CASE WHEN quality = 1 THEN ln(prob) ELSE ln(1 - prob) END), 6) AS log_loss FROM s
""")
def eval_prob(spark, sf):
    return rounded(scored(spark, sf).agg(*[e.alias(n) for n, e in ev.probability_metrics("quality", "prob").items()]), 6)


@query("eval_regression", """
    WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500.0::DOUBLE AS p FROM lineitem)
    SELECT ROUND(1 - SUM(pow(y - p, 2)) / (SELECT SUM(pow(y - (SELECT AVG(y) FROM p), 2)) FROM p), 6) AS r2,
           ROUND(AVG(abs(y - p)), 4) AS mae FROM p
""")
def eval_regression(spark, sf):
    p = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500.0).alias("p"))
    m = ev.regression_metrics("y", "p")
    return p.agg(F.round(m["r2"], 6).alias("r2"), F.round(m["mae"], 4).alias("mae"))


@query("eval_by_split", f"""
    WITH {SCORED_SQL}, r AS (SELECT *, rank() OVER (PARTITION BY split ORDER BY prob) + (COUNT(*) OVER (PARTITION BY split, prob) - 1) / 2.0::DOUBLE AS rk FROM s),
    b AS (SELECT split, COUNT(*)::BIGINT AS n, AVG(quality) AS prevalence, AVG(pow(prob - quality, 2)) AS brier,
           -AVG(CASE WHEN quality = 1 THEN ln(prob) ELSE ln(1 - prob) END) AS log_loss,
           count(*) FILTER (quality = 0 AND prob < 0.5)::BIGINT AS tn, count(*) FILTER (quality = 0 AND prob >= 0.5)::BIGINT AS fp,
           count(*) FILTER (quality = 1 AND prob < 0.5)::BIGINT AS fn, count(*) FILTER (quality = 1 AND prob >= 0.5)::BIGINT AS tp,
           (SUM(rk) FILTER (quality = 1) - SUM(quality) * (SUM(quality) + 1) / 2.0::DOUBLE) / (SUM(quality) * SUM(1 - quality))::DOUBLE AS auc
         FROM r GROUP BY 1),
    d AS (SELECT split, prob, SUM(quality) AS pos, COUNT(*) AS n FROM s GROUP BY 1, 2),
    w AS (SELECT split, pos, SUM(pos) OVER (PARTITION BY split ORDER BY prob DESC) AS tp,
                 SUM(n) OVER (PARTITION BY split ORDER BY prob DESC) AS called, SUM(pos) OVER (PARTITION BY split) AS p FROM d),
    a AS (SELECT split, SUM(pos / p::DOUBLE * tp / called) AS ap FROM w GROUP BY 1)
    SELECT split, n, ROUND(prevalence, 6) AS prevalence, ROUND(brier, 6) AS brier, ROUND(log_loss, 6) AS log_loss, tn, fp, fn, tp,
           ROUND(COALESCE(tp / NULLIF(tp + fp, 0)::DOUBLE, 0), 6) AS "precision", ROUND(COALESCE(tp / NULLIF(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
           ROUND(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1, ROUND(auc, 6) AS auc, ROUND(ap, 6) AS ap
    FROM b JOIN a USING (split)
""")
def eval_by_split(spark, sf):
    return rounded(ev.metrics_by_split(scored(spark, sf), "split", "quality", "prob", 0.5), 6)


SWEEP_SQL = f"""WITH {SCORED_SQL}, g AS (SELECT ROUND(i * 0.05::DOUBLE, 2) AS t FROM range(1, 20) x(i)),
    c AS (SELECT t, count(*) FILTER (prob >= t AND quality = 1) AS tp, count(*) FILTER (prob >= t) AS called, SUM(quality) AS pos
          FROM s, g GROUP BY 1),
    w AS (SELECT t AS threshold, ROUND(COALESCE(tp / NULLIF(pos, 0)::DOUBLE, 0), 4) AS recall,
                 ROUND(COALESCE(tp / NULLIF(called, 0)::DOUBLE, 0), 4) AS "precision",
                 ROUND(COALESCE(2 * tp / NULLIF(called + pos, 0)::DOUBLE, 0), 4) AS f1 FROM c)"""


@query("threshold_sweep", SWEEP_SQL + "SELECT * FROM w")
def threshold_sweep(spark, sf):
    return ev.threshold_sweep(scored(spark, sf), "quality", "prob")


@query("best_config", SWEEP_SQL + "SELECT * FROM w ORDER BY (recall >= 0.95) DESC, f1 DESC, threshold DESC LIMIT 1")
def best_config(spark, sf):
    return ev.best_threshold(ev.threshold_sweep(scored(spark, sf), "quality", "prob"))


def _metric_rows(spark, sf, prob):
    rows = scored(spark, sf).withColumn("prob", prob)
    wide = ev.metrics_by_split(rows, "split", "quality", "prob", 0.5).select(
        "split", F.col("auc").alias("roc_auc"), F.col("ap").alias("pr_auc"), "precision", "recall", "f1", "brier", "log_loss")
    return wide.unpivot(["split"], wide.columns[1:], "metric", "value")


BOARD_METRICS_SQL = """
    SELECT split, model, 'brier' AS metric, AVG(pow(prob - quality, 2)) AS value FROM t GROUP BY 1, 2
    UNION ALL SELECT split, model, 'log_loss', -AVG(CASE WHEN quality = 1 THEN ln(prob) ELSE ln(1 - prob) END) FROM t GROUP BY 1, 2
    UNION ALL SELECT split, model, 'precision', count(*) FILTER (quality = 1 AND prob >= 0.5) / count(*) FILTER (prob >= 0.5)::DOUBLE FROM t GROUP BY 1, 2
    UNION ALL SELECT split, model, 'recall', count(*) FILTER (quality = 1 AND prob >= 0.5) / SUM(quality)::DOUBLE FROM t GROUP BY 1, 2
    UNION ALL SELECT split, model, 'f1', 2 * count(*) FILTER (quality = 1 AND prob >= 0.5) / (count(*) FILTER (prob >= 0.5) + SUM(quality))::DOUBLE FROM t GROUP BY 1, 2
    UNION ALL SELECT split, model, 'roc_auc', SUM(pos * (total - p - (called - tp) + (n - pos) / 2.0::DOUBLE)) / MAX(p * (total - p))::DOUBLE FROM w GROUP BY 1, 2
    UNION ALL SELECT split, model, 'pr_auc', SUM(pos / p::DOUBLE * tp / called) FROM w GROUP BY 1, 2"""


@query("scoreboard", f"""
    WITH {SCORED_SQL}, u AS (SELECT split, quality, 'ours' AS model, prob FROM s UNION ALL
                             SELECT split, quality, 'theirs', sqrt(prob) * 0.9::DOUBLE FROM s),
    t AS MATERIALIZED (SELECT * FROM u),
    d AS (SELECT split, model, prob, SUM(quality) AS pos, COUNT(*) AS n FROM t GROUP BY 1, 2, 3),
    w AS MATERIALIZED (SELECT split, model, pos, n, SUM(pos) OVER z AS tp, SUM(n) OVER z AS called,
                              SUM(pos) OVER (PARTITION BY split, model) AS p, SUM(n) OVER (PARTITION BY split, model) AS total
                       FROM d WINDOW z AS (PARTITION BY split, model ORDER BY prob DESC)),
    m AS MATERIALIZED ({BOARD_METRICS_SQL}),
    h AS (SELECT split, metric, MAX(value) FILTER (model = 'ours') AS x, MAX(value) FILTER (model = 'theirs') AS y FROM m GROUP BY 1, 2)
    SELECT split, metric, ROUND(x, 5) AS ours, ROUND(y, 5) AS theirs,
           CASE WHEN metric IN ('brier', 'log_loss') THEN CASE WHEN ROUND(x, 9) <= ROUND(y, 9) THEN 'ours' ELSE 'theirs' END
                ELSE CASE WHEN ROUND(x, 9) >= ROUND(y, 9) THEN 'ours' ELSE 'theirs' END END AS winner
    FROM h
""")
def scoreboard(spark, sf):
    ours = rounded(_metric_rows(spark, sf, F.col("prob")), 9)
    theirs = rounded(_metric_rows(spark, sf, F.sqrt("prob") * 0.9), 9)
    return rounded(ev.scoreboard(ours, theirs), 5)


@query("scoreboard_tally", f"""
    WITH b AS ({ORACLES["scoreboard"]}), k AS (SELECT split, count(*) FILTER (winner = 'ours')::BIGINT AS ours_won, count(*) FILTER (winner = 'theirs')::BIGINT AS theirs_won FROM b GROUP BY 1)
    SELECT *, CASE WHEN ours_won > theirs_won THEN 'won' WHEN ours_won = theirs_won THEN 'draw' ELSE 'lost' END AS result FROM k
""")
def scoreboard_tally(spark, sf):
    ours = rounded(_metric_rows(spark, sf, F.col("prob")), 9)
    theirs = rounded(_metric_rows(spark, sf, F.sqrt("prob") * 0.9), 9)
    return ev.tally(ev.scoreboard(ours, theirs))
