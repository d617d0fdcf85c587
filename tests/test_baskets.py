"""Co-purchase counts against brute force, for ordinary and very long baskets."""

import random
from collections import defaultdict

import pytest

from tillmark.operators.baskets import basket_items, product_pairs


def brute(lines):
    baskets, pairs, units = defaultdict(set), defaultdict(int), defaultdict(list)
    for t1, p1, _ in lines:
        for t2, p2, q2 in lines:
            if t1 is not None and t1 == t2 and None not in (p1, p2) and p1 != p2:
                baskets[p1, p2].add(t1)
                pairs[p1, p2] += 1
                if q2 is not None:
                    units[p1, p2].append(q2)
    return {k: (len(baskets[k]), pairs[k], sum(units[k]) if units[k] else None) for k in pairs}


def lines_of(seed):
    pick = random.Random(seed)
    rows = [(f"t{pick.randrange(12)}", pick.randrange(9), pick.choice([1, 2, 5, None])) for _ in range(80)]
    rows += [("long", p % 30, p % 4) for p in range(60)]  # a third of all lines in one basket, each product twice
    rows += [(None, 1, 1), (None, 2, 1), ("t1", None, 1)]
    return rows


@pytest.mark.parametrize("min_baskets", [1, 2, 3])
@pytest.mark.parametrize("tile", [1, 3, 7, 1000])
def test_pairs(spark, tile, min_baskets):
    """tile 1: every basket of two products or more is long; 7: a few are; 1000: none is."""
    rows = lines_of(tile)
    items = basket_items(spark.createDataFrame(rows, "t string, p bigint, q bigint"), "t", "p", "q")
    got = {
        (r.anchor, r.related): (r.baskets, r.line_pairs, r.related_units)
        for r in product_pairs(items, min_baskets, tile).collect()
    }
    assert got == {pair: counts for pair, counts in brute(rows).items() if counts[0] >= min_baskets}


def test_one_long_basket_is_not_paired_up_for_pairs_of_two_baskets(spark):
    """300 products in one basket would be 44,850 pairs; only the pair that another basket has is looked up."""
    rows = [("long", p, 1) for p in range(300)] + [("t", 5, 2), ("t", 9, 3)]
    items = basket_items(spark.createDataFrame(rows, "t string, p bigint, q bigint"), "t", "p", "q")
    pairs = product_pairs(items, 2, 20)
    assert sorted(tuple(r) for r in pairs.collect()) == [(5, 9, 2, 2, 4), (9, 5, 2, 2, 3)]
    assert max(_join_rows(pairs)) < 1000
    everything = product_pairs(items, 1, 20)
    assert len(everything.collect()) == 300 * 299 and max(_join_rows(everything)) >= 44_849


def _join_rows(df):
    """Output rows of every join of a frame that has run."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if "Join" in node.nodeName():
            metric = node.metrics().get("numOutputRows")
            found += [metric.get().value()] if metric.isDefined() else []
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found
