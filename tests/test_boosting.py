"""The boosting engine against a plain Python version, on both ways of growing nodes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumentab.operators import boosting, evaluate, models
from lumentab.operators.boosting import Setting


def plain_boosting(x, y, w_train, s, classes=2):
    """Raw predictions after every round: rows of lists, None for a missing cell; loops only."""
    n, width = len(x), len(x[0])
    cuts = []
    for f in range(width):
        values = sorted({r[f] for r in x if r[f] is not None})
        cuts.append([(a + b) / 2 for a, b in zip(values, values[1:])])
    own = [i for i in range(n) if w_train[i]]
    share = [sum(y[i] == k for i in own) for k in range(classes)]
    tracks = 1 if classes == 2 else classes
    base = [math.log(share[1] / share[0])] if classes == 2 else [math.log(c / len(own)) for c in share]
    raw = [[b] * n for b in base]
    out = []
    for _ in range(s.rounds):
        grads = []
        for k in range(tracks):
            g, h = [], []
            for i in range(n):
                if classes == 2:
                    p, hit = 1 / (1 + math.exp(-raw[0][i])), y[i] == 1
                else:
                    e = [math.exp(raw[c][i] - max(raw[c][i] for c in range(classes))) for c in range(classes)]
                    p, hit = e[k] / sum(e), y[i] == k
                g.append(p - hit)
                h.append(p * (1 - p))
            grads.append((g, h))
        steps = []
        for g, h in grads:
            def find(rows):
                gs, hs = sum(g[i] for i in rows), sum(h[i] for i in rows)
                best = None
                for f in range(width):
                    for c, cut in enumerate([*cuts[f], math.inf]):
                        for side in (False, True):
                            left = [i for i in rows if (side if x[i][f] is None else x[i][f] <= cut)]
                            right = [i for i in rows if i not in set(left)]
                            gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                            if min(len(left), len(right)) < s.min_leaf or min(hl, hs - hl) < 1e-3:
                                continue
                            gain = round(gl ** 2 / (hl + s.l2) + (gs - gl) ** 2 / (hs - hl + s.l2) - gs ** 2 / (hs + s.l2), 9)
                            if gain > 0 and (best is None or gain > best[0]):
                                some = any(x[i][f] is None for i in rows)
                                best = (gain, f, cut, side if some else len(left) >= len(right))
                return best

            splits, leaves = {}, {1: own}
            known = {1: find(own)}
            while s.leaves is None or len(leaves) < s.leaves:
                open_ = [(-known[m][0], m) for m in leaves if known[m] and (s.depth is None or m.bit_length() - 1 < s.depth)]
                if not open_:
                    break
                m = min(open_)[1]
                rows = leaves.pop(m)
                splits[m] = known[m]
                _, f, cut, side = known[m]
                for child, part in ((2 * m, True), (2 * m + 1, False)):
                    leaves[child] = [i for i in rows if (side if x[i][f] is None else x[i][f] <= cut) == part]
                    known[child] = find(leaves[child])
            value = {m: -s.rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + s.l2) for m, rows in leaves.items()}

            def fall(i):
                m = 1
                while m in splits:
                    _, f, cut, side = splits[m]
                    m = 2 * m + (not (side if x[i][f] is None else x[i][f] <= cut))
                return value[m]

            steps.append([fall(i) for i in range(n)])
        for k in range(tracks):
            raw[k] = [a + b for a, b in zip(raw[k], steps[k])]
        out.append([list(r) for r in raw])
    return out


@pytest.fixture(scope="module")
def made():
    rng = np.random.default_rng(3)
    n = 200
    a, b = rng.integers(0, 9, n), np.round(rng.normal(size=n), 1)
    x = [[None if rng.random() < 0.2 else float(a[i]), float(b[i]), None if rng.random() < 0.1 else float(rng.integers(0, 3))] for i in range(n)]
    score = a / 3 - 1.3 + b + 0.5 * rng.normal(size=n)
    return x, [int(v > 0) for v in score], [int(np.digitize(v, [-0.7, 0.8])) for v in score], [int(i % 4 == 3) for i in range(n)]


@pytest.fixture(scope="module")
def table(spark, made):
    x, y, level, held = made
    rows = [(i, *x[i], y[i], level[i], held[i]) for i in range(len(x))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int, level int, part int").repartition(3).persist()


def softmax(raw):
    e = np.exp(np.array(raw) - np.max(raw, axis=0))
    return e / e.sum(axis=0)


@pytest.mark.parametrize("local", [boosting.LOCAL, 0, 40])
def test_runs_together_equal_the_plain_version(monkeypatch, table, made, local):
    monkeypatch.setattr(boosting, "LOCAL", local)
    monkeypatch.setattr(boosting, "PART_CELLS", 60)
    x, y, _, held = made
    settings = [Setting(3, 6, 0.3, 0.0, 5, None, 1), Setting(2, 6, 0.3, 0.0, 5, None, 1), Setting(3, 4, 0.1, 1.0, 12, None, 1), Setting(2, None, 0.2, 0.1, 3, 2, 1)]
    scored, _, run_of = boosting.fit_many(table, ["a", "b", "c"], "y", settings, 2, "part")
    assert run_of[0] == run_of[1] and len(set(run_of)) == 3
    for s, r in zip(settings, run_of):
        raw = plain_boosting(x, y, [not h for h in held], s)[-1][0]
        got = scored.where((F.col("run") == r) & (F.col("rounds") == s.rounds)).collect()
        assert sum(g["w"] for g in got) == len(x)
        told = sorted((g["part"], g["y"], round(g["probability"][1], 8)) for g in got for _ in range(g["w"]))
        want = sorted((held[i], y[i], round(1 / (1 + math.exp(-raw[i])), 8)) for i in range(len(x)))
        assert [t[:2] for t in told] == [t[:2] for t in want]
        np.testing.assert_allclose([t[2] for t in told], [t[2] for t in want], atol=1e-7)


def test_softmax_equals_the_plain_version_and_scores_new_rows(table, made):
    x, _, level, _ = made
    s = Setting(3, 5, 0.3, 0.5, 6)
    model = boosting.fit(table, ["a", "b", "c"], "level", s, 3)
    want = softmax(plain_boosting(x, level, [True] * len(x), s, 3)[-1])
    got = {r["id"]: r for r in model.transform(table.select("id", "a", "b", "c")).collect()}
    np.testing.assert_allclose([got[i]["probability"] for i in range(len(x))], want.T, atol=1e-7)
    assert all(got[i]["prediction"] == want[:, i].argmax() for i in range(len(x)))


def test_log_loss_of_training_rows_never_rises(table):
    scored, *_ = boosting.fit_many(table, ["a", "b", "c"], "level", [Setting(k, 8, 0.1, 0.0, 5) for k in range(1, 9)], 3)
    loss = scored.groupBy("rounds").agg(F.sum(-F.log(F.element_at("probability", F.col("y") + 1)) * F.col("w")).alias("l")).orderBy("rounds").collect()
    values = [r["l"] for r in loss]
    assert len(values) == 8 and all(b < a for a, b in zip(values, values[1:]))


def test_a_table_that_nothing_splits(spark):
    rows = spark.createDataFrame([(None, i % 2) for i in range(10)] + [(1.0, None)], "a double, y int")
    model = boosting.fit(rows, ["a"], "y", Setting(3, 4, 0.1, 0.0, 2))
    assert {round(r["probability"][1], 9) for r in model.transform(rows).collect()} == {0.5}


def test_many_values_are_cut_at_quantiles(spark):
    rows = spark.range(2000).selectExpr("double(id) a", "int(id >= 1200) y")
    model = boosting.fit(rows, ["a"], "y", Setting(2, 3, 0.5, 0.0, 5))
    assert len(model.cuts[0]) <= boosting.BINS - 1
    p = [r["probability"][1] for r in model.transform(rows).orderBy("a").collect()]
    assert max(p[:1190]) < 0.6 < min(p[1210:])


def test_holdout_search_scores_every_setting(table):
    settings = [Setting(r, leaves, 0.2, 0.0, 5) for r in (2, 4) for leaves in (3, 6)]
    found, best = models.holdout_search(table, ["a", "b", "c"], "y", "part", settings)
    rows = found.orderBy("setting").collect()
    top = min(rows, key=lambda r: (-r["auc_valid"], r["gap"], r["setting"]))
    assert len(rows) == 4 and [r["best"] for r in rows].index(1) == top["setting"] and len(best.rounds) == int(top["rounds"])
    # The best model, applied to the rows, has the scores of the table.
    scored = best.transform(table).select("part", "y", F.col("probability")[1].alias("p"))
    auc = {r["part"]: r["auc"] for r in evaluate.ranking_metrics(scored, "y", "p", ["part"]).collect()}
    assert round(auc[0], 4) == top["auc_train"] and round(auc[1], 4) == top["auc_valid"]
    loss = scored.where("part = 1").agg(evaluate.probability_metrics("y", "p")["log_loss"]).first()[0]
    assert round(loss, 4) == top["logloss_valid"]


def test_cross_validation_equals_separate_fits(table):
    folded = table.withColumn("fold", (F.col("id") % 3).cast("int"))
    settings = [Setting(2, None, 0.1, 0.0, 3, 3), Setting(3, None, 0.1, 0.0, 3, 3)]
    got = models.cross_validate_boosting(folded, ["a", "b", "c"], "y", "fold", 3, settings)
    for s, mean in zip(settings, got):
        scored, *_ = boosting.fit_many(folded, ["a", "b", "c"], "y", [Setting(s.rounds, None, 0.1, 0.0, 3, 3, held=f) for f in range(3)], 2, "fold")
        right = F.sum(F.when((F.col("probability")[1] > 0.5) == (F.col("y") == 1), F.col("w")).otherwise(0)) / F.sum("w")
        rates = scored.where(F.col("part") == F.col("run")).groupBy("run").agg(right.alias("r")).collect()
        assert math.isclose(mean, sum(r["r"] for r in rates) / 3)


def test_few_cells_are_fitted_without_passes(monkeypatch, table):
    settings = [Setting(r, 6, rate, 0.1, 5, held=1) for r in (2, 5) for rate in (0.1, 0.3)]

    def fitted(classes):
        scored, runs, run_of = boosting.fit_many(table, ["a", "b", "c"], "y" if classes == 2 else "level", settings, classes, "part")
        rows = sorted((*r[:5], *[round(p, 9) for p in r[5]]) for r in scored.collect())
        return rows, [[[t.at.tolist() for t in ts] for ts in m.rounds] for m in runs], run_of

    monkeypatch.setattr(boosting, "LOCAL", 0)
    slow = [fitted(k) for k in (2, 3)]
    monkeypatch.undo()

    def no_pass(*_):
        raise AssertionError("a pass over few cells")

    monkeypatch.setattr(boosting, "_pieces", no_pass)
    assert [fitted(k) for k in (2, 3)] == slow


def test_some_ten_thousand_cells_take_no_passes_and_runs_do_not_share_tasks(spark, monkeypatch):
    def no_pass(*_):
        raise AssertionError("a pass over few cells")

    monkeypatch.setattr(boosting, "_pieces", no_pass)
    rows = spark.range(25_000).select((F.col("id") % 250).alias("a"), F.floor(F.col("id") / 250).alias("b"), (F.col("id") % 2).alias("y"))
    settings = [Setting(1, 4, 0.1, float(l2), 5) for l2 in range(12)]
    scored = boosting.fit_many(rows, ["a", "b"], "y", settings)[0]
    told = scored.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("run").alias("runs"), F.sum("w").alias("w")).collect()
    assert [(r["runs"], r["w"]) for r in told] == [(1, 25_000)] * 12
