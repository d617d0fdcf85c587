import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import fixtures
from tillmark.llm import fingerprints, words


def exact(one, other, size=5):
    sets = []
    for text in (one, other):
        own = fixtures.words(text, fixtures.SOLID)
        sets.append({tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} if own else set())
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


@pytest.mark.parametrize("extra", [[], [(7, "again seven", "en", "a", 0), (-5, "first of all", "en", "a", 0)]])
def test_edited_texts_and_likeness(spark, extra):
    rows = sorted(fixtures.rows() + extra, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = fingerprints.edit_compared(fixtures.documents(spark, extra)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, row in enumerate(rows):
        text, following = row[1] or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        key = (row[0], len(text), hashlib.sha256(edited.encode()).hexdigest())
        want.setdefault(key, []).append((exact(text, edited), exact(text, following)))
    prints = {}
    for r in got:
        own = want[(r.doc_id, r.n_chars, r.edited_sha256)].pop()
        assert abs(r.near_edited - own[0]) < 0.2 and abs(r.near_next - own[1]) < 0.2
        prints.setdefault(r.fingerprint, set()).add(r.doc_id)
    assert {5, 6} <= next(ids for ids in prints.values() if 5 in ids)


def sent(documents, **more):
    rows = fingerprints.edit_compared(documents, **more).drop("fingerprint", "edited_fingerprint")
    return sorted(map(tuple, rows.collect()), key=repr)


def test_runs_change_nothing(spark):
    """Runs of a row each, ids of other types, and a row that a third of the table repeats."""
    hot = [(7, fixtures.rows()[7][1], "en", "a", 0)] * 25
    documents = fixtures.documents(spark, hot)
    want = sent(documents, run_bytes=1 << 40)
    assert len(want) == documents.count()
    assert sent(documents, run_bytes=1) == want
    assert sent(documents.repartition(13), run_bytes=3000) == want
    runs = fingerprints.with_next(documents, run_bytes=1)
    assert runs.rdd.getNumPartitions() > 40
    # A padded number sorts as the number does, and so does a time.
    plain = sorted(r[1:] for r in want)
    named = documents.withColumn("doc_id", F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    dated = documents.withColumn("doc_id", F.timestamp_seconds("doc_id"))
    for other in (named, dated):
        assert sorted(r[1:] for r in sent(other, run_bytes=3000)) == plain


def test_one_row_is_followed_by_itself(spark):
    one = spark.createDataFrame([(3, "abcd", "en", "a", 4)], fixtures.SCHEMA)
    row = fingerprints.edit_compared(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert fingerprints.edit_compared(fixtures.empty(spark)).count() == 0


def test_estimates_are_unbiased():
    rng = np.random.default_rng(2)
    names = [f"w{i}" for i in range(5000)]
    off = []
    for share in (0.2, 0.5, 0.8, 0.95):
        for _ in range(20):
            own = rng.choice(names, 400)
            other = np.concatenate([own[: int(400 * share)], rng.choice(names, 400 - int(400 * share))])
            pair = pa.array([" ".join(own), " ".join(other)])
            found = fingerprints.fingerprints(pair)
            off.append(fingerprints.likeness(found[0], found[1]) - exact(*pair.to_pylist()))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06


def test_long_words_and_chunk_borders():
    long = "a" * (words.CHUNK_BYTES + 5)
    texts = [long, f"b {long} c", None, "é ü", long + " b"]
    found = [b.hashes[x:y].tolist() for b in words.blocks(pa.array(texts), words.LETTERS) for x, y in zip(b.bounds[:-1], b.bounds[1:])]
    assert [len(f) for f in found] == [1, 3, 0, 2, 2]
    assert found[0][0] == found[1][1] == found[4][0] and found[1][0] == found[4][1]


def test_fingerprint_column_replaces_an_own_one(spark):
    documents = fixtures.clashing(spark).selectExpr("*", "1 as fingerprint")
    out = fingerprints.fingerprinted(documents)
    assert out.columns == documents.columns and out.where("length(fingerprint) = 256").count() == documents.count()
