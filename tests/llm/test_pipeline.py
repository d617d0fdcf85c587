"""The pipeline, stage by stage, against brute force over each stage's own input."""

from fractions import Fraction

import fixtures
import test_decontaminate
import test_jaccard
from pyspark.sql import functions as F

import corpus_pipeline
from tillmark.llm import packing

FOLDER = "/root/testdata/sf0.001"
INSULTS = "idiot moron"  # of the test tables


def test_stages_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    before, seen = docs.collect(), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        seen[name] = (before, docs.collect())
        before = docs.collect()
        if name != "best-fit packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    was, now = seen["toxicity"]
    kept = {r.doc_id for r in now}
    assert 0 < len(was) - len(now) < 0.2 * len(was)
    assert not [r for r in was if all(w in r.text for w in INSULTS.split()) and r.doc_id in kept]
    was, now = seen["n-gram Jaccard join"]
    want = {i for i, _, name in test_jaccard.brute([tuple(r) for r in was], 5, Fraction(8, 10)) if i == name}
    assert {r.doc_id for r in now} == want
    was, now = seen["benchmark decontamination"]
    hits = {r.doc_id: h for r, h in zip(was, test_decontaminate.brute([r.text for r in was], items))}
    assert not any(h[1] for h in test_decontaminate.brute([r.text for r in now], items))
    after = {r.doc_id: r for r in now}
    for row in was:
        if not hits[row.doc_id][1]:
            assert after[row.doc_id] == row
    assert all(h[1] > 0.5 * h[0] for i, h in hits.items() if i not in after)
    was, now = seen["secret scans"]
    assert len(was) == len(now)
    was, now = seen["best-fit packing"]
    placed = {}
    for r in now:
        placed[r.doc_id] = placed.get(r.doc_id, 0) + r.n_tokens
    counted = spark.createDataFrame(was).select("doc_id", packing.word_tokens(F.col("text")).alias("n")).collect()
    assert placed == {r.doc_id: r.n for r in counted}


def test_awkward_tables(spark, tmp_path):
    fixtures.clashing(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 0
    fixtures.empty(spark).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
