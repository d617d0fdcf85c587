import numpy as np
import pytest
from pyspark.sql import functions as F

import fixtures
from tillmark.llm import quality, queries, toxicity, words
from tillmark.llm.learning import SparseRows, fold, sigmoid

FOLDER = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n = int((label == 1).sum())
    return (order[label == 1].sum() - n * (n + 1) / 2) / n / (len(label) - n)


def held_out(spark, name, label):
    found = queries.queries()[name](spark, FOLDER).where("held_out")
    return found.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").select("score", "predicted", label).toPandas()


def test_toxicity_on_held_out_rows(spark):
    rows = held_out(spark, "op9_toxicity", "toxic")
    assert rows.score.between(0, 1).all()
    assert auc(rows.score.values, rows.toxic.values) > 0.93
    caught = rows[rows.toxic == 1].predicted.mean()
    assert caught > 0.8 and rows[rows.toxic == 0].predicted.mean() < 0.01


def test_quality_on_held_out_rows(spark):
    rows = held_out(spark, "op7_quality_classifier", "quality")
    assert auc(rows.score.values, rows.quality.values) > 0.97
    assert rows[rows.quality == 1].predicted.mean() > 0.97 and rows[rows.quality == 0].predicted.mean() < 0.3


def test_unlabelled_risk_learns_from_hidden_positives():
    rng = np.random.default_rng(0)
    make = lambda toxic: np.flatnonzero(rng.random(40) < np.where(np.arange(40) < 5, 0.5 if toxic else 0.01, 0.2))
    positive = SparseRows([make(True) for _ in range(300)])
    unlabelled = SparseRows([make(rng.random() < 0.1) for _ in range(3000)])
    weights, bias = toxicity.train(positive, unlabelled, 40, 0.1)
    test = [make(i % 2 == 0) for i in range(600)]
    scores = sigmoid(SparseRows(test).times(weights) + bias)
    assert auc(scores, np.arange(600) % 2 == 0) > 0.95
    assert weights[:5].min() > np.abs(weights[5:]).max()


def test_words_are_counted_over_all_rows(spark):
    """A telling word that the sample for the training steps does not hold is found, and has a weight."""
    rows = [(i, f"plain text number n{i % 50} of many", 0) for i in range(3000)]
    rows += [(5000 + i, f"plain curse{i % 40} text n{i % 50}", 1) for i in range(400)]
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    confirmed = documents.where("doc_id >= 5000").select("doc_id")
    model = toxicity.fit(documents, confirmed, 0.1, max_toxic=20, max_unlabelled=500)
    told = np.array([words.hash_text(f"curse{i}", words.LETTERS)[0] for i in range(40)])
    assert set(told.tolist()) <= set(model.vocabulary.hashes.tolist())
    unseen = spark.createDataFrame([(i, f"a new text with curse{i}") for i in range(40)] + [(99, "a new text with n3")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.scored(unseen, model).collect()}
    assert min(scores[i] for i in range(40)) > 0.3 > 2 * scores[99]


def test_tallies_equal_plain_counts(spark):
    documents = fixtures.documents(spark)
    want = {}
    for text in [r.text for r in documents.collect()]:
        for word in set(fixtures.words(text, fixtures.LETTERS)):
            want[word] = want.get(word, 0) + 1
    got = {r.word: r.texts for r in toxicity._tallies(documents).collect()}
    hashes = {w: int(words.hash_text(w, words.LETTERS).view(np.int64)[0]) for w in want}
    assert got == {hashes[w]: n for w, n in want.items()}


def test_scores_follow_from_the_fitted_weights(spark):
    """Every score again, word by word."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit_labelled(documents, labels, fold("doc_id"))
    weights = dict(zip(model.vocabulary.hashes.tolist(), model.weights))
    for row in toxicity.scored(documents, model).collect():
        own = {int(words.hash_text(w, words.LETTERS)[0]) for w in set(fixtures.words(row.text, fixtures.LETTERS))}
        margin = model.bias + sum(weights.get(h, 0) for h in own)
        assert row.score == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)


def test_cotraining_helps_the_weaker_start():
    rng = np.random.default_rng(1)
    label = (rng.random(2000) < 0.6).astype(float)
    views = [rng.normal(size=(2000, 6)) + (label * 2 - 1)[:, None] * 0.8 for _ in range(2)]
    seed, rest = np.arange(16), np.arange(16, 2000)
    models = quality.cotrain([v[seed] for v in views], label[seed], [v[rest] for v in views])
    alone = quality.cotrain([v[seed] for v in views], label[seed], [v[rest] for v in views], rounds=0)
    accuracy = lambda ms: np.mean([((m.margin(v[rest]) > 0) == label[rest]).mean() for m, v in zip(ms, views)])
    assert accuracy(models) >= accuracy(alone) - 0.01 and accuracy(models) > 0.9


@pytest.mark.parametrize("awkward", [True, False])
def test_awkward_rows_and_missing_labels(spark, awkward):
    documents = fixtures.clashing(spark) if awkward else fixtures.empty(spark)
    ids = [(r[0], r[0] % 2, int(r[0] % 3 == 0)) for r in fixtures.rows() if r[0] is not None]
    labels = spark.createDataFrame(ids + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    for own in (labels, labels.where("false")):
        model = toxicity.fit_labelled(documents, own, fold("doc_id"))
        out = toxicity.scored(documents, model)
        good = quality.scored(documents, quality.fit(documents, own, fold("doc_id") != 0))
        for df in (out, good):
            assert df.count() == documents.count() and df.where("score between 0 and 1").count() == documents.count()
            if awkward:
                fixtures.kept_clashes(documents, df)


def test_fold_is_that_of_the_contract(spark):
    import zlib

    rows = spark.range(50).select("id", fold("id").alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)
    assert spark.range(1).select(F.lit(None).cast("long").alias("id")).select(fold("id").alias("f")).first().f == 0
