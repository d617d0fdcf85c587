"""A corpus prepared for training, stage by stage: each stage reads what the one before it stored.

A stage is a function of (spark, docs, folder of the tables).  All but the last return the columns of documents.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import decontaminate, fingerprints, jaccard, packing, secrets, toxicity
from tillmark.llm.learning import fold
from tillmark.llm.shared import stored, table

TOXIC = 0.5
# Near-duplicates of the corpus: five-word shingles, four fifths in common.
SHINGLE, THRESHOLD = 5, Fraction(80, 100)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go.  Labels of held-out rows are not seen."""
    model = toxicity.fit_labelled(docs, table(spark, sf_dir, "labels"), fold("doc_id"))
    scores = toxicity.scored(docs, model, score_column="_toxicity")
    return scores.where(F.col("_toxicity") < TOXIC).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return jaccard.deduplicated(docs, size=SHINGLE, threshold=THRESHOLD, signer=fingerprints.Bands())


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go, and documents that mostly consist of them."""
    return _counted(decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that few sources have are masked; copied examples stay."""
    return _counted(secrets.redacted(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return packing.packed(docs, packing.word_tokens(F.col("text")))


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

# No SQL says what the learnt and iterative stages keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = stored(docs)
    return docs
