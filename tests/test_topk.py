"""The first ranks and rows of an order against plain Python."""

import random
from decimal import Decimal

import pytest

from tillmark.operators import topk
from tillmark.operators.ranking import Ranks, asc, desc


def rows(n, spread, seed):
    pick = random.Random(seed)
    some = lambda: None if pick.random() < 0.1 else pick.randrange(spread)
    return [(pick.choice("abbbb") if pick.random() < 0.9 else None, some(), some(), f"x{i}") for i in range(n)]


def money(value):
    return None if value is None else Decimal(value)


def brute(table, k, up):
    out = []
    for g, v, w, x in table:
        key = lambda r: (
            (r[1] is not None, r[1] or 0) if up else (r[1] is None, -(r[1] or 0)),
            (r[2] is None, -(r[2] or 0)),
        )
        rank = 1 + sum(key(r) < key((g, v, w, x)) for r in table if r[0] == g)
        if rank <= k:
            out.append((g, v, money(w), x, rank))
    return sorted(out, key=str)


@pytest.mark.parametrize("up", [True, False])
@pytest.mark.parametrize("n, spread, k", [(1, 3, 1), (60, 2, 3), (400, 1, 5), (400, 9, 10), (400, 1000, 4), (30, 5, 99)])
def test_first_ranks(spark, n, spread, k, up):
    """spread 1: nearly all rows of a group tie for the first rank."""
    table = rows(n, spread, n + k)
    frame = spark.createDataFrame([(g, v, money(w), x) for g, v, w, x in table], "g string, v long, w decimal(9,2), x string")
    order = Ranks([asc("v") if up else desc("v"), desc("w")], partition_by=["g"], rank="place")
    got = topk.first_ranks(frame.repartition(3), order, k)
    assert got.columns == ["g", "v", "w", "x", "place"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(table, k, up)


def test_batches_are_merged(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        table = rows(300, 12, 2)
        frame = spark.createDataFrame([(g, v, money(w), x) for g, v, w, x in table], "g string, v long, w decimal(9,2), x string")
        order = Ranks([desc("v"), desc("w")], partition_by=["g"], rank="place")
        got = topk.first_ranks(frame.repartition(2), order, 6).collect()
        assert sorted([tuple(r) for r in got], key=str) == brute(table, 6, False)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("n, spread", [(0, 1), (3, 2), (200, 1), (200, 6), (203, 500)])
def test_first_rows_equal_the_whole_ranking(spark, n, spread):
    from tillmark.operators.ranking import with_ranks

    pick = random.Random(n)
    frame = spark.createDataFrame([(i, pick.choice([None, *range(spread)])) for i in range(n)], "id long, v long")
    order = Ranks([desc("v")], ["id"], rank="place", row_number="number", ntiles={"tile": 5})
    want = [r for r in with_ranks(frame, order).collect() if r.number <= 10]
    got = topk.first_rows(frame, order, 10).collect()
    assert sorted(got, key=str) == sorted(want, key=str)


def test_no_row_and_wrong_orders(spark):
    none = spark.createDataFrame([], "g string, v long")
    assert topk.first_ranks(none, Ranks([desc("v")], partition_by=["g"], rank="place"), 3).count() == 0
    with pytest.raises(ValueError):
        topk.first_ranks(none, Ranks([desc("v")], ["g"], row_number="n"), 3)
    with pytest.raises(ValueError):
        topk.first_rows(none, Ranks([desc("v")], partition_by=["g"], rank="place"), 3)


def test_report_on_first_ranks_shuffles_no_full_row(spark, workspace, monkeypatch):
    """The totals are stored narrow, without counting anything distinct; after that only keys are shuffled."""
    plans = []
    real = topk.checkpointed

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df)

    monkeypatch.setattr(topk, "checkpointed", seen)
    found = workspace.hot_selling(10)
    (stored,) = plans
    assert "Expand" not in stored and "total_discounts_given" not in stored and "distinct" not in stored
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan
