import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import fixtures
from tillmark.llm import fingerprints, jaccard, words
from tillmark.llm.components import components


def shingles(text, size):
    own = fixtures.words(text, fixtures.SOLID)
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


def brute(rows, size, threshold):
    """(n, component) of every row; a component is named by its smallest id."""
    sets = [shingles(r[1], size) for r in rows]
    name = list(range(len(rows)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                name[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[root(i)] = min(least.get(root(i), row[0]), row[0])
    return [(r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


def family(seed, count, size, edits):
    rng = random.Random(seed)
    base = fixtures.sentence(rng, size).split()
    out = []
    for i in range(count):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = fixtures.sentence(rng, 1)
        out.append((1000 * seed + i, " ".join(own[: size - rng.randint(0, size // 12)]), "en", "a", 0))
    return out


@pytest.mark.parametrize("tile", [2_000_000, 1_500])
def test_components_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE_SHINGLES", tile)
    rows = fixtures.rows() + family(2, 60, 200, 8) + family(3, 40, 25, 2) + family(4, 30, 90, 3)
    documents = spark.createDataFrame(rows, fixtures.SCHEMA)
    got = jaccard.linked(documents).select("doc_id", "n_shingles", "component_id").collect()
    assert ordered(map(tuple, got)) == ordered(brute(rows, 3, Fraction(9, 10)))


def test_bands_with_another_threshold_equal_brute_force(spark):
    rows = fixtures.rows() + family(2, 60, 200, 14) + family(3, 40, 25, 3)
    documents = spark.createDataFrame(rows, fixtures.SCHEMA)
    got = fingerprints.near_duplicates(documents).select("doc_id", "n_shingles", "component_id").collect()
    assert ordered(map(tuple, got)) == ordered(brute(rows, 5, Fraction(8, 10)))


def test_linked_sets_share_a_part():
    """The pigeonhole argument holds at the threshold for all small sizes."""
    parts, rng = jaccard.Parts(Fraction(9, 10)), np.random.default_rng(1)
    for size in [1, 2, 9, 10, 11, 18, 19, 20, 21, 50, 90, 99, 100, 101, 190, 300]:
        for _ in range(5):
            one = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
            drop = len(one) // 10  # of n, n - n // 10 are left: similarity of at least 0.9
            other = np.sort(rng.choice(one, len(one) - drop, replace=False))
            swap = int(Fraction(1, 19) * len(one))  # so many exchanged, still at least 0.9
            third = one.copy()
            third[rng.choice(len(one), swap, replace=False)] = rng.integers(0, 2**63, swap).astype(np.uint64)
            for two in (other, np.unique(third)):
                both = len(np.intersect1d(one, two))
                if 10 * both < 9 * (len(one) + len(two) - both) or not len(two):
                    continue
                keys = [parts(None, s, np.array([0, len(s)]), np.array([True]))[0] for s in (one, two)]
                assert len(np.intersect1d(*keys)), (size, len(two))


def test_short_unrelated_sets_share_no_key():
    """An empty part is no key of its own: texts of ten shingles that have nothing in common do not meet."""
    parts, rng = jaccard.Parts(Fraction(9, 10)), np.random.default_rng(3)
    for size in (10, 20):
        sets = np.sort(rng.integers(0, 2**63, (20_000, size)).astype(np.uint64) * np.uint64(2), axis=1)
        bounds = np.arange(0, sets.size + 1, size)
        keys = np.concatenate(parts(None, sets.reshape(-1), bounds, np.ones(len(sets), bool)))
        assert len(np.unique(keys)) == len(keys)


def test_many_short_sets_of_one_group_are_tiled(spark):
    """Sets of one hot block count by their number: with few shingles each they still do not meet in one task."""
    members = spark.range(9_000).select(F.col("id").alias("set_id"), F.lit(1).alias("grp"), F.lit(12).alias("n"))
    places = jaccard._tiles(members, jaccard.Parts(Fraction(9, 10))).select("set_id", F.inline("places"))
    sizes = places.groupBy("tile").agg(F.count_distinct("set_id").alias("n")).collect()
    assert max(r.n for r in sizes) <= 2 * jaccard.TILE_SHINGLES / jaccard.SET_WEIGHT * 1.1
    assert places.select("set_id").distinct().count() == 9_000


def test_copies_of_one_set_are_spread(spark):
    """Neither a text of very many rows nor one repeated row gathers under one (set, salt)."""
    rows = [(None, "one two three four five", "en", "a", 0)] * 3000 + [(i, "six seven eight nine ten", "en", "a", 0) for i in range(3000)]
    documents = spark.createDataFrame(rows, fixtures.SCHEMA).repartition(3)
    found = jaccard.keyed(documents, "doc_id", "text", 3, jaccard.Parts(Fraction(9, 10)))
    assert max(r["count"] for r in found.groupBy("set_id", "salt").count().collect()) < 60
    out = jaccard.linked(documents).groupBy("component_id").count().collect()
    assert {r.component_id: r["count"] for r in out} == {None: 3000, 0: 3000}


def test_tree_join_equals_all_pairs():
    rng = np.random.default_rng(4)
    pool = words.mix(np.arange(4000, dtype=np.uint64))
    sets = []
    for _ in range(30):
        base = rng.choice(pool, rng.integers(5, 200), replace=False)
        sets += [np.unique(rng.choice(base, max(1, int(len(base) * rng.uniform(0.85, 1))), replace=False)) for _ in range(6)]
    ids = np.arange(len(sets))
    for bits in (1 << 10, 1 << 14):
        order = jaccard._ordered(ids, sets)
        tree, forest = jaccard.Tree([sets[i] for i in order], bits), jaccard.Forest(len(sets))
        jaccard.tree_join(tree, tree, 0, forest, 9, 10)
        want = jaccard.Forest(len(sets))
        for i in range(len(sets)):
            for j in range(i):
                a, b = sets[order[i]], sets[order[j]]
                both = len(np.intersect1d(a, b))
                if 10 * both >= 9 * (len(a) + len(b) - both):
                    want.join(i, j)
        assert (forest.roots(0, len(sets)) == want.roots(0, len(sets))).all()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(3, 3), (5, 1), (5, 1)]
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)} | {1: 1, 5: 1}
    assert sorted(map(tuple, found)) == sorted(want.items())


def test_one_of_each_group_stays(spark):
    documents = fixtures.clashing(spark)
    out = jaccard.deduplicated(documents)
    fixtures.kept_clashes(documents, out)
    want = {r[0] for r in brute(fixtures.rows(), 3, Fraction(9, 10)) if r[0] == r[2]} - {None}
    got = [r.doc_id for r in out.collect()]
    assert {d for d in got if d is not None} == want and len([d for d in got if d is not None]) == len(want)
    assert got.count(None) == 1  # the null text; the copy of a row with an id goes
    assert jaccard.deduplicated(fixtures.empty(spark)).count() == 0
    assert jaccard.linked(fixtures.empty(spark)).count() == 0
