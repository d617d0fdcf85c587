"""Recommendations against brute force on small data, and the gate between the two models."""

import math
import random
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tillmark.operators.baskets import basket_items, product_pairs
from tillmark.plans import marts, recommend

SALES = (
    "SalesDate timestamp_ntz, CustomerID bigint, ProductID bigint, TotalPrice decimal(18,4), Quantity bigint, "
    "Discount decimal(18,4), TransactionNumber string"
)


def shop(seed, customers=12, products=25, lines=260):
    """Lines (customer, product, basket, quantity); customer 0 and product 0 hold about a third of them."""
    pick = random.Random(seed)
    rows = []
    for _ in range(lines):
        customer = 0 if pick.random() < 0.33 else pick.randrange(customers)
        product = 0 if pick.random() < 0.33 else pick.randrange(products)
        rows.append((customer, product, f"{customer}-{pick.randrange(6)}", pick.randrange(1, 5)))
    return rows


def sales_frame(spark, rows):
    frame = spark.createDataFrame(rows, "c bigint, p bigint, t string, q bigint")
    return frame.select(
        F.lit("2001-01-01").cast("timestamp_ntz").alias("SalesDate"),
        F.col("c").alias("CustomerID"),
        F.col("p").alias("ProductID"),
        (F.col("q") * 2).cast("decimal(18,4)").alias("TotalPrice"),
        F.col("q").alias("Quantity"),
        F.lit(0).cast("decimal(18,4)").alias("Discount"),
        F.col("t").alias("TransactionNumber"),
    )


@pytest.fixture(scope="module")
def labels(spark):
    products = spark.range(60).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("p"), "id").alias("product_name"),
        (F.col("id") % 3).alias("category_id"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("category_name"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("class"),
        F.when(F.col("id") % 4 == 0, "Budget").when(F.col("id") % 4 == 1, "Luxury").alias("price_category"),
    )
    customers = spark.range(60).select(F.col("id").alias("customer_id"), F.lit("n").alias("customer_name"))
    return products, customers


def brute_heuristic(rows, n):
    owned, together = defaultdict(set), Counter()
    for c, p, t, _ in rows:
        owned[c].add(p)
    for _, p1, t1, _ in rows:
        for _, p2, t2, _ in rows:
            if t1 == t2 and p1 != p2:
                together[p1, p2] += 1
    out = []
    for customer, has in owned.items():
        found = sorted((-k, b) for (a, b), k in together.items() if a in has and b not in has)
        out += [(customer, b, float(-k), rank + 1) for rank, (k, b) in enumerate(found[:n])]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("probe", [1, 3])
def test_heuristic(spark, labels, monkeypatch, seed, probe):
    monkeypatch.setattr(recommend, "PROBE_DEPTH", probe)
    rows = shop(seed)
    got = recommend.heuristic_recommendations(sales_frame(spark, rows), *labels).collect()
    assert sorted((r.customer_id, r.product_id, r.score, r.recommendation_rank) for r in got) == brute_heuristic(rows, 10)
    assert {r.model_type for r in got} == {"HEURISTIC_FALLBACK"}
    assert all(r.product_name == f"p{r.product_id}" for r in got)


def test_heuristic_takes_stored_pairs(spark, labels):
    sales = sales_frame(spark, shop(4))
    pairs = product_pairs(basket_items(sales, "TransactionNumber", "ProductID", "Quantity"))
    one = recommend.heuristic_recommendations(sales, *labels, pairs=pairs).collect()
    assert sorted(one) == sorted(recommend.heuristic_recommendations(sales, *labels).collect())


def brute_mart(rows):
    times, spent, owned = Counter(), Counter(), defaultdict(set)
    baskets, units = defaultdict(set), Counter()
    for c, p, t, q in rows:
        times[c, p] += 1
        spent[c, p] += 2 * q
        owned[c].add(p)
    for _, p1, t1, _ in rows:
        for _, p2, t2, q2 in rows:
            if t1 == t2 and p1 != p2:
                baskets[p1, p2].add(t1)
                units[p1, p2] += q2
    out = []
    for c, has in owned.items():
        top = sorted(has, key=lambda p: (-times[c, p], -spent[c, p], p))[:10]
        found = []
        for (a, b), shared in baskets.items():
            if a in top and b not in has and len(shared) >= 2:
                score = 0.45 * times[c, a] + 0.35 * len(shared) + 0.2 * math.log(1 + spent[c, a])
                found.append((-round(score, 9), -len(shared), a, b, units[a, b]))
        for rank, (score, support, a, b, u) in enumerate(sorted(found)[:10]):
            out.append((c, a, b, -support, u, round(-score, 6), rank + 1))
    return sorted(out)


@pytest.mark.parametrize("seed", [5, 6])
def test_mart_recommend(spark, labels, seed):
    rows = shop(seed, products=40, lines=400)
    lines = sales_frame(spark, rows).select(
        F.monotonically_increasing_id().cast("string").alias("sales_id"),
        F.col("CustomerID").alias("customer_id"),
        F.col("ProductID").alias("product_id"),
        F.col("Quantity").alias("quantity"),
        F.col("TotalPrice").alias("total_price"),
        F.col("SalesDate").alias("sales_date"),
        F.col("TransactionNumber").alias("transaction_number"),
    )
    got = marts.mart_recommend(lines, labels[0]).collect()
    found = sorted(
        (r.customer_id, r.purchased_product, r.recommended_product, r.co_purchase_txn_count, r.related_units_sold,
         round(r.recommendation_score, 6), r.recommendation_rank)
        for r in got
    )
    assert found and found == brute_mart(rows)
    for r in got:
        if r.purchased_product % 4 in (2, 3) or r.recommended_product % 4 in (2, 3):
            assert r.price_movement == "Downsell"  # a missing price tier


def test_sparse_data_falls_back(spark, labels):
    got = recommend.recommendations(sales_frame(spark, shop(1, customers=5)), *labels)
    assert {r.model_type for r in got.select("model_type").distinct().collect()} == {"HEURISTIC_FALLBACK"}


SMALL_GATE = replace(recommend.DEFAULTS, min_users=1, min_items=1, min_interactions=1, iterations=2, rank=3)


def test_factorisation_failure_falls_back(spark, labels, monkeypatch):
    def broken(*args):
        raise RuntimeError("fit failed")

    monkeypatch.setattr(recommend, "als_recommendations", broken)
    got = recommend.recommendations(sales_frame(spark, shop(2)), *labels, SMALL_GATE)
    assert got.select("model_type").distinct().collect()[0][0] == "HEURISTIC_FALLBACK"


def test_no_factorisation_result_falls_back(spark, labels):
    """Every customer owns every product: nothing is left to recommend, by either model."""
    rows = [(c, p, f"{c}", 1) for c in range(4) for p in range(3)]
    assert recommend.recommendations(sales_frame(spark, rows), *labels, SMALL_GATE).isEmpty()


@pytest.mark.parametrize("shift", [0, 2**40])
def test_factorisation_properties(spark, labels, shift):
    """The same with ids that do not fit 32 bits."""
    rows = [(c + shift, p + shift, t, q) for c, p, t, q in shop(7)]
    products, customers = labels
    sales = sales_frame(spark, rows)
    wide = [
        products.withColumn("product_id", F.col("product_id") + shift),
        customers.withColumn("customer_id", F.col("customer_id") + shift),
    ]
    got = recommend.recommendations(sales, *wide, SMALL_GATE).collect()
    assert got and {r.model_type for r in got} == {"ALS"}
    owned = {(c, p) for c, p, _, _ in rows}
    assert not owned & {(r.customer_id, r.product_id) for r in got}
    by_customer = defaultdict(list)
    for r in got:
        assert r.product_name == f"p{r.product_id - shift}"
        by_customer[r.customer_id].append((r.recommendation_rank, r.score))
    for ranks in by_customer.values():
        ranks.sort()
        assert [rank for rank, _ in ranks] == list(range(1, len(ranks) + 1)) and len(ranks) <= 10
        assert [s for _, s in ranks] == sorted((s for _, s in ranks), reverse=True)


def test_ratings(spark):
    rows = [(1, 2, "a", 3), (1, 2, "b", 4), (2, 2, "a", 1)]
    sales = sales_frame(spark, rows).withColumn(
        "TotalPrice", F.when(F.col("CustomerID") == 2, 0).otherwise(F.col("TotalPrice")).cast("decimal(18,4)")
    )
    got = {r.customer_id: (float(r.raw_rating), r.rating) for r in recommend.als_ratings(sales).collect()}
    assert got == {1: (14.0, pytest.approx(math.log(15))), 2: (1.0, pytest.approx(math.log(2)))}
