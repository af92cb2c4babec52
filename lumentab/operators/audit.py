"""Label auditing: composite scores, cluster naming, votes, budgeted correction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lumentab.functions.columns import cut, reverse_scored, row_mean
from lumentab.operators.reshape import stack_cells
from lumentab.operators.ship import ship_if_short

# Label names in ascending order, score limits, centre of each class, share of rows a correction may change.
LEVELS = ("bajo", "medio", "alto")
LEVEL_LIMITS = (2.33, 3.67)
CLASS_CENTRES = {"bajo": 1.5, "medio": 3.0, "alto": 4.5}
OTHER_CENTRE = 3.0
CHANGE_SHARE = 0.30


def level_of(score: Column | str) -> Column:
    return cut(score, LEVEL_LIMITS, LEVELS)


def composite_score(risk: Sequence[Column | str], protective: Sequence[Column | str]) -> Column:
    """Mean of the risk answers and of the reversed protective answers, averaged."""
    return (row_mean(risk) + row_mean([reverse_scored(c) for c in protective])) / 2


def before_after(df: DataFrame, before: str, after: str) -> DataFrame:
    """Counts per label before and after, 0 where a label is missing on one side; one scan."""
    sides = [
        {"label": F.col(before), "b": F.lit(1), "a": F.lit(0)}, {"label": F.col(after), "b": F.lit(0), "a": F.lit(1)},
    ]
    return stack_cells(df, [], sides).groupBy("label").agg(F.sum("b").alias("original"), F.sum("a").alias("corrected"))


def cluster_names(df: DataFrame, cluster: str, score: str, mode: str = "reference") -> DataFrame:
    """Name clusters by mean score (noise -1 left out): rows (cluster, mean_score, level).

    ``reference``: with three clusters or more the three lowest get the names in order and
    the others the middle one; with fewer the score limits decide.  ``by_range``: always
    the score limits.
    """
    means = df.where(F.col(cluster) != -1).groupBy(cluster).agg(F.avg(score).alias("mean_score"))
    if mode == "by_range":
        return means.withColumn("level", level_of("mean_score"))
    lowest = means.orderBy("mean_score", cluster).limit(len(LEVELS)).agg(
        F.array_sort(F.collect_list(F.struct("mean_score", cluster))).alias("v")
    ).select(F.transform("v", lambda s: s[cluster])).scalar()
    place = F.array_position(lowest, F.col(cluster)).cast("int")
    ordered = F.coalesce(F.get(F.array(*[F.lit(x) for x in LEVELS]), F.nullif(place, F.lit(0)) - 1), F.lit(LEVELS[1]))
    enough = F.size(lowest) >= len(LEVELS)
    return means.withColumn("level", F.when(enough, ordered).otherwise(level_of("mean_score")))


def named_rows(df: DataFrame, cluster: str, score: str, out: str, mode: str = "reference") -> DataFrame:
    """Rows with the level of their cluster; noise and unnamed clusters get the middle level."""
    names = cluster_names(df, cluster, score, mode).select(cluster, F.col("level").alias(out))
    return df.join(ship_if_short(names), cluster, "left").withColumn(out, F.coalesce(out, F.lit(LEVELS[1])))


def majority_vote(votes: Sequence[Column | str]) -> Column:
    """Most frequent of three votes; three different votes give the first."""
    a, b, c = [F.col(v) if isinstance(v, str) else v for v in votes]
    return F.when((a == b) | (a == c), a).when(b == c, b).otherwise(a)


def vote_size(votes: Sequence[Column | str]) -> Column:
    """How many of three votes agree with the majority."""
    a, b, c = [F.col(v) if isinstance(v, str) else v for v in votes]
    return F.when((a == b) & (b == c), 3).when((a == b) | (a == c) | (b == c), 2).otherwise(1)


def inconsistency_pct(label: str, other: str) -> Column:
    return F.avg((F.col(label) != F.col(other)).cast("double")) * 100.0


def class_gap(score: str, label: str, centres: Mapping[str, float] = CLASS_CENTRES) -> Column:
    """Distance of a score from the centre of its class."""
    centre = F.lit(OTHER_CENTRE)
    for name, value in centres.items():
        centre = F.when(F.col(label) == name, value).otherwise(centre)
    return F.abs(F.col(score) - centre)


def correct_labels(df: DataFrame, key: str, label: str, vote: str, gap: str,
                   share: float = CHANGE_SHARE, out: str = "corrected", votes: Column | None = None,
                   min_votes: int = 0) -> DataFrame:
    """Replace at most ``floor(share * n)`` labels by the vote, largest gap first (then smallest key).

    With ``votes`` (see ``vote_size``) only rows with at least ``min_votes`` agreeing votes are candidates.

    The gap of the last accepted change is an order statistic of the candidates; rows with
    a larger gap change without any sort, only rows that tie on the limit are ranked.
    """
    from lumentab.operators.order import running_totals

    candidate = F.col(label) != F.col(vote)
    if votes is not None:
        candidate = candidate & (votes >= min_votes)
    budget = int(df.count() * share)
    steps = running_totals(df.where(candidate), gap, {"n": F.count(F.lit(1))}, descending=True)
    at = (
        steps.where(F.col("n_before") < budget)
        .agg(F.min(F.struct(F.col(gap).alias("gap"), F.col("n_before").alias("before"))).alias("s")).first()["s"]
    )
    if at is None:
        return df.withColumn(out, F.col(label))
    tied = candidate & (F.col(gap) == F.lit(at["gap"]))
    chosen = _lowest_keys(df.where(tied), key, budget - at["before"]).withColumn("_chosen", F.lit(True))
    above = candidate & (F.col(gap) > F.lit(at["gap"]))
    change = F.coalesce(above, F.lit(False)) | F.coalesce("_chosen", F.lit(False))
    return df.join(chosen, key, "left").withColumn(
        out, F.when(change, F.col(vote)).otherwise(F.col(label))
    ).select(*df.columns, out)


def _lowest_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    from lumentab.operators.order import dense_index

    return dense_index(df.select(key), key, "_idx").where(F.col("_idx") < n).select(key)
