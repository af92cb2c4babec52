"""The near-duplicate stage of a large table: what it shuffles, and that candidates stay apart."""

import numpy as np
import pytest

from lumentab.llm import ngramjoin
from lumentab.operators import ship


def rows_shuffled(df):
    """Rows that a join or aggregate of ``df`` received through a shuffle, after it ran."""
    def below(node):
        own = [node.metrics().apply("shuffleRecordsWritten").value()] if node.nodeName() == "Exchange" else []
        children = node.children()
        return own + [n for k in range(children.size()) for n in below(children.apply(k))]

    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return sum(below(plan))


@pytest.fixture
def long_tables(spark, monkeypatch):
    """Every table counts as too long to ship, and plans tell what they shuffled."""
    monkeypatch.setattr(ship, "SHIP_ROWS", 1)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rows_without_a_key_of_a_long_table_are_not_shuffled(spark, long_tables):
    docs = spark.createDataFrame([(None if i % 400 == 3 else i // 2 * 2, "text", i) for i in range(4000)], "doc_id int, text string, key_word int")
    table = spark.createDataFrame([(i, i % 3) for i in range(-10, 40, 2)], "own long, extra long")
    left = ship.without(docs, "doc_id", table.select("own"), "own")
    assert left.columns == docs.columns
    got = sorted((r.doc_id, r.key_word) for r in left.where("doc_id IS NOT NULL").collect())
    assert got == [(i // 2 * 2, i) for i in range(40, 4000) if i % 400 != 3]
    assert left.where("doc_id IS NULL").count() == 10
    some = ship.joined_with_some(docs, "doc_id", table, "own")
    assert some.columns == [*docs.columns, *table.columns]
    assert sorted((r.doc_id, r.key_word, r.extra) for r in some.collect()) == [(i // 2 * 2, i, i // 2 * 2 % 3) for i in range(40) if i != 3]
    # The table and the partial bits, twice, and few rows besides those of its keys.
    assert rows_shuffled(left) < 1000 and rows_shuffled(some) < 600


def test_keep_one_with_long_tables(long_tables, odd, odd_rows):
    kept = ngramjoin.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 8, 9, 10, 11, 12, 13] and ids.count(None) == 2


def test_senders_meet_others_of_like_size_once(spark):
    mark = np.array([5 << 60, 3 << 60, 7 << 60, 9 << 60], dtype=np.uint64)
    a, b, twice, far = ngramjoin._sender(mark, np.array([100, 110, 200, 1000])).tolist()
    sent = [(1, a), (1, b), (1, a), (2, b), (2, a), (3, a), (3, twice), (4, twice), (4, far), (5, a), (5, a), (6, b), (7, far), (7, a), (7, b)]
    got = ngramjoin.met_senders(spark.createDataFrame(sent, "key long, sender long").repartition(3), 80).collect()
    # Keys 1, 2 and 7 bring the same two sets together.
    assert sorted((r.f1_high << 14, r.c) for r in got) == [(3 << 60, 2), (5 << 60, 2)]
    assert len({r.bucket for r in got}) == 1


@pytest.mark.parametrize("percent", [80, 85])
def test_sets_that_may_link_are_within_reach(percent):
    n = np.concatenate((np.arange(1, 400), np.array([10**5, 10**7])))
    small = -(-percent * n // 100)
    steps = [ngramjoin._sender(np.zeros(len(n), np.uint64), k) >> ngramjoin.MARK_BITS for k in (small, n)]
    assert (100 * small >= percent * n).all() and (steps[1] - steps[0] <= ngramjoin._size_reach(percent)).all()
    assert (np.diff(steps[1]) >= 0).all() and (steps[0] >= 0).all()


@pytest.mark.parametrize("n", [70, 127, 200, 255, 500])
def test_unlike_sets_of_one_size_are_no_candidates(n):
    rng = np.random.default_rng(n)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(60)]
    i, _ = ngramjoin._alike(np.array([len(s) for s in sets]), [ngramjoin.signature(s) for s in sets], None, 80)
    assert not len(i)
