"""Exact metrics over scored tables: each is one aggregate or one running total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lumentab.operators import order
from lumentab.operators.reshape import stack_cells
from lumentab.operators.ship import join_with_nulls

# Fixed value: double precision spacing used to clip probabilities in the log loss.
PROBABILITY_EPS = 2.220446049250313e-16
# The swept decision thresholds and the recall a threshold should reach.
THRESHOLDS = tuple(round(0.05 * i, 2) for i in range(1, 20))
WANTED_RECALL = 0.95


def or_zero(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def f1_of(p: Column, r: Column) -> Column:
    return or_zero(2 * p * r, p + r)


def confusion_long(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, y, p).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, p: str, labels: Sequence) -> DataFrame:
    """One row per given true label, one count column per given predicted label."""
    full = df.sparkSession.createDataFrame([(v,) for v in labels], df.select(y).schema)
    wide = df.groupBy(y).agg(*[F.count_if(F.col(p) == F.lit(v)).alias(f"pred_{v}") for v in labels])
    return full.join(wide, y, "left").na.fill(0)


def class_report(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class plus FP and FN; zero division gives 0."""
    by = list(by)
    cells = confusion_long(df, y, p, by)
    hit = F.col(y) == F.col(p)
    sides = F.array(
        F.struct(F.col(y).alias("class"), F.when(hit, F.col("n")).otherwise(0).alias("tp"),
                 F.when(hit, 0).otherwise(F.col("n")).alias("fn"), F.lit(0).cast("long").alias("fp")),
        F.struct(F.col(p).alias("class"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("fn"), F.when(hit, 0).otherwise(F.col("n")).alias("fp")),
    )
    counts = cells.select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn")
    )
    return (
        counts.withColumn("precision", or_zero(F.col("tp"), F.col("tp") + F.col("fp")))
        .withColumn("recall", or_zero(F.col("tp"), F.col("tp") + F.col("fn")))
        .withColumn("f1", f1_of(F.col("precision"), F.col("recall")))
        .withColumn("support", F.col("tp") + F.col("fn"))
    )


def summary_report(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and weighted averages from a class report."""
    n = F.sum("support")
    weighted = {m: F.sum(F.col(m) * F.col("support")) / n for m in ("precision", "recall", "f1")}
    return report.groupBy(*by).agg(
        (F.sum("tp") / n).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in weighted],
        *[e.alias(f"weighted_{m}") for m, e in weighted.items()],
    )


def _class_totals(df: DataFrame, y: str, score: str, by: Sequence[str], descending: bool, weight: str | None = None) -> DataFrame:
    def rows(hit: Column) -> Column:
        return F.count_if(hit) if weight is None else F.coalesce(F.sum(F.when(hit, F.col(weight))), F.lit(0))

    return order.running_totals(df, score, {"pos": rows(F.col(y) == 1), "neg": rows(F.col(y) != 1)}, by, descending)


def roc_points(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC and PR curve point per distinct score, highest score first."""
    t = _class_totals(df, y, score, by, True)
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    return t.select(
        *by, score, tp.alias("tp"), fp.alias("fp"),
        or_zero(tp, F.col("pos_total")).alias("tpr"),
        or_zero(fp, F.col("neg_total")).alias("fpr"),
        (tp / (tp + fp)).alias("precision"),
    )


def ranking_metrics(df: DataFrame, y: str, score: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """ROC AUC (tied pairs count one half; NULL with one class) and average precision; ``weight`` counts a row so often."""
    t = _class_totals(df, y, score, by, True, weight)
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    below = F.col("neg_total") - fp
    return t.groupBy(*by).agg(
        (
            F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
            / F.nullif(F.max(F.col("pos_total") * F.col("neg_total")).cast("double"), F.lit(0.0))
        ).alias("auc"),
        (
            F.sum(F.col("pos") * tp / (tp + fp)) / F.nullif(F.max("pos_total").cast("double"), F.lit(0.0))
        ).alias("ap"),
    )


def one_vs_rest(df: DataFrame, label: str, classes: Sequence, score_of) -> DataFrame:
    """Long table (class, y, score) that ranks every class against the rest; one scan."""
    return stack_cells(df, [], [
        {"class": F.lit(c), "y": (F.col(label) == F.lit(c)).cast("int"), "score": score_of(c).cast("double")}
        for c in classes
    ])


def probability_metrics(y: str, p: str, weight: str | None = None) -> dict[str, Column]:
    """Brier score and log loss as aggregate expressions; ``weight`` counts a row so often."""
    inside = F.least(F.greatest(F.col(p), F.lit(PROBABILITY_EPS)), F.lit(1.0 - PROBABILITY_EPS))

    def mean(x: Column) -> Column:
        return F.avg(x) if weight is None else F.sum(x * F.col(weight)) / F.sum(weight)

    return {
        "brier": mean((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))),
        "log_loss": -mean(F.when(F.col(y) == 1, F.log(inside)).otherwise(F.log(1.0 - inside))),
    }


def regression_metrics(y: str, p: str) -> dict[str, Column]:
    e = F.col(y) - F.col(p)
    return {
        "r2": 1.0 - F.sum(e * e) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0)),
        "mae": F.avg(F.abs(e)),
    }


def binary_counts(y: str, pred: Column) -> dict[str, Column]:
    pos = F.col(y) == 1
    return {
        "tn": F.count_if(~pos & ~pred), "fp": F.count_if(~pos & pred),
        "fn": F.count_if(pos & ~pred), "tp": F.count_if(pos & pred),
    }


def metrics_by_split(df: DataFrame, split: str, y: str, prob: str, threshold: float) -> DataFrame:
    """n, prevalence, AUC, AP, Brier, log loss, precision, recall, F1 and counts per split."""
    base = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(y).cast("double")).alias("prevalence"),
        *[e.alias(m) for m, e in probability_metrics(y, prob).items()],
        *[e.alias(m) for m, e in binary_counts(y, F.col(prob) >= threshold).items()],
    )
    base = base.withColumns({
        "precision": or_zero(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": or_zero(F.col("tp"), F.col("tp") + F.col("fn")),
    }).withColumn("f1", f1_of(F.col("precision"), F.col("recall")))
    return join_with_nulls(base, ranking_metrics(df, y, prob, [split]), [split])


def threshold_sweep(df: DataFrame, y: str, prob: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Recall, precision and F1 per threshold: one aggregate, rows are not multiplied by the grid."""
    pos = F.col(y) == 1
    wide = df.agg(
        F.count_if(pos).alias("pos"),
        *[F.count_if(pos & (F.col(prob) >= t)).alias(f"tp{i}") for i, t in enumerate(thresholds)],
        *[F.count_if(F.col(prob) >= t).alias(f"called{i}") for i, t in enumerate(thresholds)],
    )
    rows = [
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"),
                 F.col(f"called{i}").alias("called"), F.col("pos").alias("pos"))
        for i, t in enumerate(thresholds)
    ]
    return (
        wide.select(F.inline(F.array(*rows)))
        .withColumn("recall", F.round(or_zero(F.col("tp"), F.col("pos")), 4))
        .withColumn("precision", F.round(or_zero(F.col("tp"), F.col("called")), 4))
        .withColumn("f1", F.round(or_zero(2 * F.col("tp"), F.col("called") + F.col("pos")), 4))
        .select("threshold", "recall", "precision", "f1")
    )


def best_threshold(sweep: DataFrame, recall: float = WANTED_RECALL) -> DataFrame:
    """Highest F1 among thresholds with enough recall (all if none has); ties go to the higher threshold."""
    return sweep.orderBy((F.col("recall") >= recall).desc(), F.desc("f1"), F.desc("threshold")).limit(1)


# Metrics where more is better and where less is better.
HIGHER_IS_BETTER = ("roc_auc", "pr_auc", "precision", "recall", "f1")
LOWER_IS_BETTER = ("brier", "log_loss")


def scoreboard(ours: DataFrame, theirs: DataFrame, key: str = "split") -> DataFrame:
    """Long comparison of two metric tables (key, metric, value) with the winner; ties go to ours."""
    joined = ours.withColumnRenamed("value", "ours").join(theirs.withColumnRenamed("value", "theirs"), [key, "metric"])
    lower = F.col("metric").isin(*LOWER_IS_BETTER)
    wins = F.when(lower, F.col("ours") <= F.col("theirs")).otherwise(F.col("ours") >= F.col("theirs"))
    return joined.withColumn("winner", F.when(wins, "ours").otherwise("theirs"))


def tally(board: DataFrame, key: str = "split") -> DataFrame:
    ours = F.count_if(F.col("winner") == "ours")
    theirs = F.count_if(F.col("winner") == "theirs")
    return board.groupBy(key).agg(
        ours.alias("ours_won"), theirs.alias("theirs_won"),
        F.when(ours > theirs, "won").when(ours == theirs, "draw").otherwise("lost").alias("result"),
    )
