"""Largest inner products against all pairs, and against the factorisation's own full scoring."""

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tillmark.operators import inner_products
from tillmark.plans import recommend


def frame(spark, matrix, shift=0):
    rows = [(i + shift, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id int, features array<float>").repartition(3)


def brute(users, items, k):
    users, items = users.astype(np.float32).astype(float), items.astype(np.float32).astype(float)
    scores = (users @ items.T).astype(np.float32)
    out = set()
    for u, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda i: (-row[i], i))[:k]
        out |= {(u, i, place) for place, i in enumerate(order, 1)}
    return out


def places(df):
    return {(r.user, r.item, r.place) for r in df.collect()}


@pytest.mark.parametrize("signed", [False, True])
@pytest.mark.parametrize("first, longest, n, k", [(4, 16, 300, 5), (8, 8, 100, 10), (256, 4096, 700, 10), (4, 64, 3, 10), (2, 4, 50, 5)])
def test_equal_to_all_pairs(spark, monkeypatch, first, longest, n, k, signed):
    """Small bands, several shares of the users, fewer items than wanted, and a first band shorter than the list."""
    monkeypatch.setattr(inner_products, "USERS_A_SHARE", 20)
    rng = np.random.default_rng(n + k)
    users, items = rng.random((60, 6)) - 0.5 * signed, rng.random((n, 6)) - 0.5 * signed
    items *= rng.exponential(1, (n, 1))
    items[n // 2] = items[0]  # two of the same score for everyone
    users[7] = 0
    got = inner_products.largest_products(frame(spark, users), frame(spark, items), k, first, longest)
    assert places(got) == brute(users, items, k)


def test_no_user_and_no_item(spark):
    none = spark.createDataFrame([], "id int, features array<float>")
    some = frame(spark, np.ones((3, 2)))
    for users, items in ((none, some), (some, none)):
        assert inner_products.largest_products(users, items, 3).collect() == []


def test_few_pairs_are_scored_where_norms_are_spread(spark):
    """Popularity that falls off as in real catalogues: less than a tenth of all pairs is scored."""
    rng = np.random.default_rng(1)
    items = rng.random((6000, 8)) / np.arange(1, 6001)[:, None] ** 0.5
    users = rng.random((200, 8))
    banded = inner_products.banded(frame(spark, items)).cache()
    found = inner_products.probed(frame(spark, users), banded, 10)
    assert 0 < inner_products.scored_pairs(found, banded) < 200 * 6000 / 10
    got = inner_products.largest_products(frame(spark, users), frame(spark, items), 10)
    assert places(got) == brute(users, items, 10)


def test_bands_double_up_to_the_longest(spark):
    bands = spark.range(20_000).select(inner_products.band_of(F.col("id")).alias("b")).groupBy("b").count().orderBy("b")
    assert [r["count"] for r in bands.collect()] == [256, 256, 512, 1024, 2048, 4096, 4096, 4096, 20_000 - 4 * 4096]


@pytest.fixture(scope="module")
def ratings(spark, workspace):
    from tillmark.operators.durable import checkpointed

    return checkpointed(recommend.als_ratings(workspace.model_sales))


def test_recommendations_equal_full_scoring(spark, workspace, ratings):
    """The same fit again, all customers scored against all products: the same lists."""
    found = recommend.als_recommendations(ratings, workspace.product_labels, workspace.customer_labels)
    d = recommend.DEFAULTS
    coded = ratings.select(F.col("customer_id").cast("int"), F.col("product_id").cast("int"), "rating")
    model = ALS(
        userCol="customer_id", itemCol="product_id", ratingCol="rating", rank=d.rank, maxIter=d.iterations,
        regParam=d.regularisation, nonnegative=True, seed=d.seed, numUserBlocks=8, numItemBlocks=8, checkpointInterval=5,
    ).fit(coded)
    owned = {(r.customer_id, r.product_id) for r in ratings.collect()}
    want = {}
    for row in model.recommendForAllUsers(d.top_n).collect():
        fresh = [(i, s) for i, s in row.recommendations if (row.customer_id, i) not in owned]
        want |= {(row.customer_id, place): (i, s) for place, (i, s) in enumerate(sorted(fresh, key=lambda x: (-x[1], x[0])), 1)}
    got = {(r.customer_id, r.recommendation_rank): (r.product_id, r.score) for r in found.collect()}
    assert set(got) == set(want) and len(got) > 100
    for key, (item, score) in got.items():
        assert score == pytest.approx(want[key][1], rel=1e-5)
    assert sum(got[key][0] == want[key][0] for key in got) > 0.99 * len(got)  # rounding may swap two near scores


def test_users_are_sent_once(spark, monkeypatch):
    """Every pair is scored, as no norm is small; what meets is users once and items once a share, not users by band."""
    monkeypatch.setattr(inner_products, "USERS_A_SHARE", 100)
    sent = []
    own = inner_products._stream

    def mapped(self, func, *args, **kwargs):
        if getattr(func, "func", None) is own:
            sent.append(self.count())
        return original(self, func, *args, **kwargs)

    from pyspark.sql.classic.dataframe import DataFrame

    original = DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", mapped)
    rng = np.random.default_rng(3)
    users, items = 1 + rng.random((300, 4)) / 9, 1 + rng.random((900, 4)) / 9
    got = inner_products.largest_products(frame(spark, users), frame(spark, items), 5, 4, 8)
    assert places(got) == brute(users, items, 5)
    assert sent == [300 + 3 * (900 - 4)]
