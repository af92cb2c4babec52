"""Spark ML jobs: linear models, trees, boosting, searches, calibration, comparison.

Fitting is distributed by Spark ML; these functions set parameters so that the optimum
equals the usual single-machine definitions and return result tables as DataFrames.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from itertools import product

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, functions as F

from lumentab.operators import boosting, evaluate
from lumentab.operators.boosting import Boosted, Setting

SEED = 42
# Rows that make a task of a fit worth its start, and rows of a task of a fit at most.
TASK_ROWS, MOST_TASK_ROWS = 20_000, 1_000_000
# Depth and leaf size of the single tree.
TREE_DEPTH, TREE_LEAF = 4, 3
# Grids of the searches.
LOGISTIC_C = (0.01, 0.1, 1.0, 10.0)
FOREST_GRID = {"numTrees": (50, 100), "maxDepth": (3, 5, 7), "minInstancesPerNode": (1, 3, 5)}
BOOSTING_GRID = {
    "rounds": (50, 100, 200), "leaves": (8, 15, 31), "rate": (0.01, 0.05, 0.1), "l2": (0.0, 0.1, 1.0), "min_leaf": (5, 10, 20),
}


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def probability_of(c: str = "probability", index: int = 1) -> Column:
    return vector_to_array(F.col(c))[index]


def row_count(df: DataFrame) -> int:
    return df.count()


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as its rows need: fits pass over it hundreds of times.

    Every task of every pass sends its sums to the driver, so there are no more tasks than run at once, unless
    these would hold more than ``MOST_TASK_ROWS`` rows.
    """
    rows, slots = row_count(df), df.sparkSession.sparkContext.defaultParallelism
    wanted = max(1, min(-(-rows // TASK_ROWS), max(slots, -(-rows // MOST_TASK_ROWS))))
    return df.coalesce(wanted) if wanted < df.rdd.getNumPartitions() else df


# ---------------------------------------------------------------- linear models

def logistic(df: DataFrame, label: str, c: float = 1.0, penalty: str = "l2", multinomial: bool = False,
             max_iter: int = 1000, rows: int | None = None) -> Model:
    """Logistic regression with inverse regularisation ``c``: the loss is averaged here, hence 1 / (c n)."""
    n = rows if rows is not None else row_count(df)
    return LogisticRegression(
        labelCol=label, maxIter=max_iter, regParam=1.0 / (c * n), elasticNetParam=1.0 if penalty == "l1" else 0.0,
        standardization=False, family="multinomial" if multinomial else "binomial",
    ).fit(df)


def linear(df: DataFrame, label: str, alpha: float = 0.0, penalty: str = "ridge", max_iter: int = 1000) -> Model:
    """Ridge or lasso with the usual ``alpha``; 0 gives ordinary least squares.

    The normal solver (one pass over the rows) scales the label by its deviation over n, so
    the ridge term needs alpha * sd(y) / n.
    """
    reg = alpha
    if alpha and penalty == "ridge":
        n, sd = df.agg(F.count(label), F.stddev_pop(label)).first()
        reg = alpha * sd / n
    return LinearRegression(
        labelCol=label, regParam=reg, elasticNetParam=1.0 if penalty == "lasso" else 0.0, standardization=False,
        maxIter=max_iter, solver="normal",
    ).fit(df)


class LinearClasses:
    """Least squares on the class number, rounded and clipped to the classes seen."""

    def __init__(self, model: Model, classes: int):
        self.model, self.classes = model, classes

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df).withColumn("prediction", ordinal_prediction("prediction", self.classes))


def linear_classes(df: DataFrame, label: str) -> LinearClasses:
    top = df.agg(F.max(label)).first()[0]
    return LinearClasses(linear(df, label), int(top) + 1)


def ordinal_prediction(prediction: str, classes: int) -> Column:
    """Regression output rounded half to even and clipped to the class range."""
    return F.greatest(F.lit(0.0), F.least(F.lit(float(classes - 1)), F.bround(F.col(prediction), 0)))


# ---------------------------------------------------------------- trees

def tree(df: DataFrame, label: str, depth: int = TREE_DEPTH, leaf: int = TREE_LEAF, features: str = "features") -> Model:
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=depth, minInstancesPerNode=leaf, seed=SEED).fit(df)


def forest(df: DataFrame, label: str, trees: int = 50, depth: int = 5, leaf: int = 1) -> Model:
    return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=SEED).fit(df)


def importance_table(model: Model, features: Sequence[str], df: DataFrame) -> DataFrame:
    """Importances, strongest first, with a flag above the mean and the rank."""
    values = [float(v) for v in model.featureImportances.toArray()]
    mean = sum(values) / len(values)
    ordered = sorted(zip(features, values), key=lambda p: (-p[1], p[0]))
    rows = [(f, v, int(v > mean), i + 1) for i, (f, v) in enumerate(ordered)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, above_mean int, place int")


# ---------------------------------------------------------------- searches

def log_uniform(n: int, low: float = 1e-3, high: float = 1e3, seed: int = SEED) -> list[float]:
    """Repeatable draws of a log-uniform parameter."""
    rng = random.Random(seed)
    return [math.exp(rng.uniform(math.log(low), math.log(high))) for _ in range(n)]


def grid(**axes: Sequence) -> list[dict]:
    return [dict(zip(axes, values)) for values in product(*axes.values())]


def _maps(estimator, settings: Sequence[Mapping]) -> list[dict]:
    return [{estimator.getParam(k): v for k, v in s.items()} for s in settings]


def cross_validate(df: DataFrame, estimator, settings: Sequence[Mapping], evaluator, folds: int, fold_col: str,
                   parallelism: int = 4) -> tuple[CrossValidatorModel, DataFrame]:
    """Exhaustive or drawn settings with given folds; returns the model and the table of mean scores."""
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=_maps(estimator, settings), evaluator=evaluator,
        numFolds=folds, foldCol=fold_col, parallelism=parallelism, seed=SEED,
    )
    fitted = validator.fit(dealt(df))
    rows = [
        (i, *[float(v) if isinstance(v, (int, float)) else v for v in s.values()], float(m))
        for i, (s, m) in enumerate(zip(settings, fitted.avgMetrics))
    ]
    names = list(settings[0])
    schema = "setting long, " + ", ".join(f"{n} {'string' if isinstance(settings[0][n], str) else 'double'}" for n in names)
    return fitted, df.sparkSession.createDataFrame(rows, schema + ", score double")


def accuracy(label: str) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


def r_squared(label: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, metricName="r2")


def holdout_search(df: DataFrame, features: Sequence[str], label: str, part: str, settings: Sequence[Setting]) -> tuple[DataFrame, Boosted]:
    """Fit every setting on part 0 and score parts 0 (train) and 1 (valid) exactly; all settings are fitted together.

    Table: setting, its values, auc_train, auc_valid, logloss_valid, gap; best = highest auc_valid, then smallest gap.
    The model is the best run, with the rounds of the best setting.
    """
    settings = [replace(s, held=1) for s in settings]
    scored, runs, run_of = boosting.fit_many(df.where(F.col(part).isin(0, 1)), features, label, settings, 2, part)
    scored = scored.select("run", "rounds", "part", "y", "w", F.col("probability")[1].alias("prob"))
    by = ["run", "rounds", "part"]
    ranked = evaluate.ranking_metrics(scored, "y", "prob", by, "w").select(*by, "auc")
    losses = scored.groupBy(*by).agg(evaluate.probability_metrics("y", "prob", "w")["log_loss"].alias("loss"))
    told = {(r["run"], r["rounds"], r["part"]): (r["auc"] or 0.0, r["loss"]) for r in losses.join(ranked, by, "left").collect()}
    rows = []
    for i, (s, r) in enumerate(zip(settings, run_of)):
        (train, _), (valid, loss) = told[r, s.rounds, 0], told[r, s.rounds, 1]
        rows.append([i, *[float(getattr(s, n)) for n in BOOSTING_GRID], *[round(x, 4) for x in (train, valid, loss, train - valid)]])
    chosen = min(rows, key=lambda r: (-r[-3], r[-1], r[0]))[0]
    schema = "setting long, " + ", ".join(f"{n} double" for n in BOOSTING_GRID)
    table = df.sparkSession.createDataFrame(
        [(*r, int(r[0] == chosen)) for r in rows], schema + ", auc_train double, auc_valid double, logloss_valid double, gap double, best int")
    best = runs[run_of[chosen]]
    return table, replace(best, rounds=best.rounds[:settings[chosen].rounds])


def cross_validate_boosting(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int,
                            settings: Sequence[Setting], classes: int = 2) -> list[float]:
    """Mean accuracy over the folds of each setting; the fits of all settings and folds go together."""
    fitted = [replace(s, held=f) for s in settings for f in range(folds)]
    scored, _, run_of = boosting.fit_many(df, features, label, fitted, classes, fold)
    held = F.create_map(*[F.lit(v) for r, s in {r: s for r, s in zip(run_of, fitted)}.items() for v in (r, s.held)])
    # Ties of probabilities go to the lower class.
    called = F.array_position("probability", F.array_max("probability")) - 1
    rates = scored.where(F.col("part") == held[F.col("run")]).groupBy("run", "rounds").agg(
        (F.sum(F.when(called == F.col("y"), F.col("w")).otherwise(0)) / F.sum("w")).alias("rate")).collect()
    rate = {(r["run"], r["rounds"]): r["rate"] for r in rates}
    own = [rate[r, s.rounds] for r, s in zip(run_of, fitted)]
    return [sum(own[i:i + folds]) / folds for i in range(0, len(own), folds)]


# ---------------------------------------------------------------- calibration and comparison

def isotonic(valid: DataFrame, label: str, score: str) -> Model:
    """Isotonic calibration fitted on held-out scores."""
    return IsotonicRegression(featuresCol=score, labelCol=label, predictionCol="calibrated").fit(valid)


def scored_rows(model: Model, df: DataFrame, key: Sequence[str], label: str, threshold: float = 0.5) -> DataFrame:
    """key, y_true, prob, pred per row: the stored form every metric works on."""
    return model.transform(df).select(
        *key, F.col(label).cast("long").alias("y_true"), probability_of().alias("prob"),
        (probability_of() >= threshold).cast("long").alias("pred"))


def compare_label_versions(df: DataFrame, split: str, versions: Mapping[str, str],
                           learners: Mapping[str, Callable[[DataFrame, str], Model]]) -> DataFrame:
    """The same learners on several label columns: accuracy and weighted F1 on the test rows, and the F1 change."""
    parts = None
    for version, label in versions.items():
        train, test = df.where(F.col(split) == "train").persist(), df.where(F.col(split) == "test")
        for name, fit in learners.items():
            predicted = fit(train, label).transform(test)
            report = evaluate.summary_report(evaluate.class_report(predicted, label, "prediction")).select(
                F.lit(version).alias("version"), F.lit(name).alias("model"), "accuracy", F.col("weighted_f1").alias("f1"))
            parts = report if parts is None else parts.unionByName(report)
        train.unpersist()
    first = next(iter(versions))
    base = parts.where(F.col("version") == first).select("model", F.col("f1").alias("_base"))
    return parts.join(base, "model").withColumn("f1_change", F.col("f1") - F.col("_base")).drop("_base")


def save_model(model: Model, path: str) -> None:
    PipelineModel(stages=[model]).write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
