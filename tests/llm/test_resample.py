"""Importance resampling against a plain computation of every feature."""

import hashlib
import math
import zlib
from collections import Counter

import fixtures
import pytest

from tillmark.llm import queries, resample


def features(text):
    own = fixtures.words(text, fixtures.LETTERS)
    runs = [" ".join(own[i : i + k]) for k in (1, 2, 3) for i in range(len(own) - k + 1)]
    return len(own), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute(documents, target):
    """doc_id, n_features, weight, score, rank from (doc_id, text) rows."""
    scanned = [features(text) for _, text in documents]
    s, t = Counter(b for _, f in scanned for b in f), Counter(b for text in target for b in features(text)[1])
    every_s, every_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (every_s + 10_000) / ((s[b] + 1) * (every_t + 10_000)))) for b in range(10_000)
    ]
    rows = []
    for (doc_id, _), (words, found) in zip(documents, scanned):
        key = f"42:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, words])
    able = sorted([r for r in rows if r[5] >= 20], key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for place, row in enumerate(able[: 5 * len(able) // 100], 1):
        row[4] = place
    return sorted([tuple(r[:5]) for r in rows], key=str)


def test_buckets_equal_all_runs():
    for _, text, *_ in fixtures.rows():
        words, found = features(text)
        assert resample.buckets((text or "").encode()) [0] == words
        assert Counter(resample.buckets((text or "").encode())[1]) == Counter(found)
    for text in ("a", "A  b", " .a.b.c. ", "a b c d", "É é x", "\x00a\x00", "---"):
        assert Counter(resample.buckets(text.encode())[1]) == Counter(features(text)[1])


def awkward(spark, extra):
    rows = [(100 + i, text, "en", None, 0) for i, text in enumerate(extra)]
    return fixtures.clashing(spark).unionByName(spark.createDataFrame(rows, fixtures.SCHEMA), allowMissingColumns=True)


@pytest.mark.parametrize("items", [[], [None, ""], ["one two three", fixtures.rows()[5][1]]])
def test_query_equals_brute_force(spark, tmp_path, items):
    extra = [" ".join(f"w{(i * j) % 17}" for j in range(25 + i % 3)) for i in range(150)]
    documents = awkward(spark, extra)
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted([tuple(r) for r in queries.op13_importance_resampling(spark, str(tmp_path)).collect()], key=str)
    assert got == brute([(r.doc_id, r.text) for r in documents.collect()], items)
    assert sum(r[4] is not None for r in got) > 5


def test_empty_table(spark):
    target = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert resample.resampled(fixtures.empty(spark), target).count() == 0


def test_a_text_like_the_target_is_drawn_first(spark):
    like, other = "alpha beta gamma delta " * 10, "zeta eta theta iota " * 10
    rows = [(i, like if i % 10 == 0 else other + str(i)) for i in range(100)]
    documents = spark.createDataFrame(rows, "name long, body string")
    target = spark.createDataFrame([("alpha beta gamma delta",)] * 50, "text string")
    got = resample.resampled(documents, target, id_column="name", text_column="body", share=(1, 10)).collect()
    assert {r.name for r in got if r["rank"]} == {i for i, text in rows if text == like}


def test_buckets_must_fit(spark):
    with pytest.raises(ValueError):
        resample.scanned(fixtures.documents(spark), fixtures.documents(spark)["text"], {}, 1 << 17)
