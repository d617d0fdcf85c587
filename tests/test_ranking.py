"""Ranking against plain Python, with ties, nulls, tiny inputs and dominant keys."""

import random
import re

import pytest

from tillmark.operators import durable, ranking
from tillmark.operators.ranking import Ranks, asc, desc, with_ranks


def tiles(total, n):
    size, larger = divmod(total, n)
    return [t + 1 for t in range(n) for _ in range(size + (t < larger))]


def expected(rows, ascending, grouped):
    """(group, id, value) -> {id: (rank, row number, ntile(5))}"""
    out = {}
    for group in {r[0] for r in rows} if grouped else {None}:
        members = [r for r in rows if not grouped or r[0] == group]
        low = float("-inf")
        value = lambda r: low if r[2] is None else r[2]
        members.sort(key=lambda r: ((value(r) if ascending else -value(r)), r[1]))
        tile = tiles(len(members), 5)
        for at, row in enumerate(members):
            first = next(i for i, other in enumerate(members) if value(other) == value(row))
            out[row[1]] = (first + 1, at + 1, tile[at])
    return out


def ranked(spark, rows, ascending, grouped):
    frame = spark.createDataFrame(rows, "g string, id bigint, v bigint").repartition(3)
    order = [asc("v") if ascending else desc("v")]
    groups = ["g"] if grouped else []
    got = with_ranks(frame, Ranks(order, ["id"], groups, rank="rank", row_number="number", ntiles={"tile": 5}))
    assert got.columns == ["g", "id", "v", "number", "tile", "rank"]
    return {r.id: (r["rank"], r.number, r.tile) for r in got.collect()}


def sample(n, spread, seed, groups=("a",)):
    pick = random.Random(seed)
    return [(pick.choice(groups), i, None if pick.random() < 0.1 else pick.randrange(spread)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 7, 12])
def test_tiny_inputs(spark, n):
    rows = sample(n, 3, n)
    assert ranked(spark, rows, True, False) == expected(rows, True, False)


@pytest.mark.parametrize("ascending", [False, True])
@pytest.mark.parametrize("spread", [1, 4, 1000])
def test_ties_and_nulls(spark, spread, ascending):
    """spread 1: every key is equal, so the ties of one key span all tasks."""
    rows = sample(400, spread, spread)
    assert ranked(spark, rows, ascending, False) == expected(rows, ascending, False)


def test_groups_one_of_them_dominant(spark):
    rows = sample(500, 6, 1, groups=("big", "big", "big", "big", "b", "c", None))
    assert ranked(spark, rows, False, True) == expected(rows, False, True)


def test_several_batches_in_one_run(spark):
    """Groups and ties that go on from one Arrow batch to the next."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rows = sample(300, 5, 9, groups=("a", "b"))
    assert ranked(spark, rows, True, True) == expected(rows, True, True)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_several_orders_at_once(spark):
    rows = sample(300, 7, 11, groups=("a", "b", None))
    frame = spark.createDataFrame(rows, "g string, id bigint, v bigint").repartition(3)
    first = Ranks([asc("v")], ["id"], ["g"], rank="r1", row_number="n1", ntiles={"t1": 5})
    got = with_ranks(frame, first, Ranks([desc("v")], ["id"], rank="r2"), Ranks([asc("id")], row_number="n3"))
    assert got.columns == ["g", "id", "v", "n1", "t1", "r1", "r2", "n3"]
    up, down = expected(rows, True, True), expected(rows, False, False)
    for r in got.collect():
        assert (r.r1, r.n1, r.t1) == up[r.id] and r.r2 == down[r.id][0] and r.n3 == r.id + 1


def test_frames_of_a_ranked_table_have_one_wide_exchange(spark, workspace, monkeypatch):
    """What is stored: the table without a shuffle, then narrow rows shuffled by range alone.  The full rows are
    shuffled once in the end, by nothing where the ranks are few enough to be sent to them."""
    plans = []
    real = durable.checkpointed

    def seen(df):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return real(df)

    totals = real(workspace.sales_totals)
    monkeypatch.setattr(ranking, "checkpointed", seen)
    from tillmark.plans import marts

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        final = marts.mart_sales_summary(totals)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 3
    (wide, first), *narrow = plans
    assert len(wide) == len(totals.columns) + 1 and "Exchange" not in first
    for columns, plan in narrow:
        assert len(columns) <= 11 and plan.count("Exchange rangepartitioning") == 1
        assert "total_discounts_given" not in plan
    exchanges = re.findall(r"Exchange hashpartitioning\(_row[^)]*\)", final)
    assert len(exchanges) == 2  # the full rows, and all their ranks together
    assert "SinglePartition" not in final + "".join(p for _, p in plans)
