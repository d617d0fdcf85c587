"""Partner lists from posting heads against all pairs."""

import random
from collections import Counter

import pytest

from tillmark.operators import baskets


def items(seed, long_baskets, size, products):
    """(basket, product, lines, units): a few long baskets with leading products, and many short ones."""
    rng = random.Random(seed)
    rows = []
    for b in range(long_baskets):
        for p in rng.sample(range(products), size):
            rows.append((f"long{b}", p, 1 if rng.random() < 0.8 else rng.randint(2, 4), 1))
    for b in range(40):
        rows += [(f"b{b}", p, rng.randint(1, 2), 1) for p in rng.sample(range(products), rng.randint(1, 4))]
    return rows


def brute(rows, depths):
    by_basket, pairs = {}, Counter()
    for basket, product, lines, _ in rows:
        by_basket.setdefault(basket, []).append((product, lines))
    for own in by_basket.values():
        for a, la in own:
            if a in depths:
                for b, lb in own:
                    if a != b:
                        pairs[a, b] += la * lb
    out = set()
    for anchor, depth in depths.items():
        mine = sorted([(-n, b) for (a, b), n in pairs.items() if a == anchor])[:depth]
        out |= {(anchor, b, -n, place) for place, (n, b) in enumerate(mine, 1)}
    return out


def listed(spark, rows, depths, **how):
    frame = spark.createDataFrame(rows, "basket string, product long, lines long, units long")
    wanted = spark.createDataFrame(list(depths.items()), "anchor long, depth long")
    found = baskets.partner_lists(frame, wanted, **how)
    return {(r.anchor, r.related, r.line_pairs, r.place) for r in found.collect()}


@pytest.mark.parametrize("seed, n, size, products, head", [(1, 0, 0, 30, 4), (2, 1, 60, 80, 2), (3, 3, 50, 60, 4), (4, 4, 30, 90, 64), (5, 2, 60, 60, 1)])
def test_lists_equal_all_pairs(spark, seed, n, size, products, head):
    rows = items(seed, n, size, products)
    rng = random.Random(seed)
    depths = {p: rng.choice([1, 3, 10, 500]) for p in range(products + 5) if p % 3}
    assert listed(spark, rows, depths, tile=10, head=head) == brute(rows, depths)


@pytest.mark.parametrize("seed, n, size, products, head", [(6, 0, 0, 30, 4), (7, 3, 50, 60, 4), (8, 2, 60, 60, 1)])
def test_a_product_may_have_several_rows_in_a_basket(spark, seed, n, size, products, head):
    rows = items(seed, n, size, products)
    depths = {p: 1 + p % 9 for p in range(products)}
    cut = [(b, p, 1, u) for b, p, lines, u in rows for _ in range(lines)]
    assert listed(spark, cut, depths, tile=10, head=head) == brute(rows, depths)


@pytest.mark.parametrize("a_bin, most", [(7, 1000), (10_000, 1000), (7, 3)])
@pytest.mark.parametrize("n", [0, 3])
def test_lists_are_the_same_whatever_a_task_adds_up(spark, monkeypatch, a_bin, most, n):
    """Pairs that lie in several bins, in one, and of products that are too frequent for one task."""
    monkeypatch.setattr(baskets, "ITEMS_A_BIN", a_bin)
    monkeypatch.setattr(baskets, "MOST_A_PRODUCT", most)
    rows = items(9 + n, n, 30, 12 if not n else 40)
    depths = {p: 1 + p % 12 for p in range(0, 40, 2)}
    assert listed(spark, rows, depths, tile=10, head=4) == brute(rows, depths)


def test_baskets_and_products_that_are_null_have_no_partner(spark):
    rows = [(None, 1, 1, 1), (None, 2, 1, 1), ("x", None, 1, 1), ("x", 1, 2, 1), ("x", 3, 1, 1)]
    assert listed(spark, rows, {1: 5, 2: 5, 3: 5}) == {(1, 3, 2, 1), (3, 1, 2, 1)}


def test_a_lone_product_and_no_anchor(spark):
    rows = [("x", p, 1, 1) for p in range(20)] + [("y", 99, 1, 1)]
    assert listed(spark, rows, {99: 3, 5: 2}, tile=10, head=2) == {(5, 0, 1, 1), (5, 1, 1, 2)}
    frame = spark.createDataFrame(rows, "basket string, product long, lines long, units long")
    assert baskets.partner_lists(frame, spark.createDataFrame([], "anchor long, depth long"), tile=10).count() == 0


def test_pairs_that_cannot_be_listed_are_not_formed(spark, monkeypatch):
    """One basket with 3,000 products: nine million ordered pairs, of which at most a fortieth is formed."""
    size, depth = 3000, 20
    rows = [("long", p, 1 + (p % 7 == 0), 1) for p in range(size)] + [(f"b{p}", q, 1, 1) for p in range(50) for q in (p, p + 50)]
    depths = dict.fromkeys(range(size), depth)
    formed = []
    real = baskets.checkpointed

    def seen(df):
        stored = real(df)
        if "done" in stored.columns:
            formed.append(stored.count())
        return stored

    monkeypatch.setattr(baskets, "checkpointed", seen)
    found = listed(spark, rows, depths)
    assert len(found) == size * depth
    assert 0 < sum(formed) < size * size / 40
    assert {r for r in found if r[0] < 30} == {r for r in brute(rows, dict.fromkeys(range(30), depth))}
