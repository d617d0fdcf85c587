"""Toxicity by non-negative positive-unlabelled learning.

Toxic examples are confirmed; everything else is unlabelled text, toxic or not.  A linear model over words is trained
to minimise ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``: the risk on unlabelled text, corrected by the share of
toxic text in it.  Where the corrected part turns negative the model has begun to learn the examples by heart, and
the step is taken against it.

Which words become features is counted in Spark, over up to ``MAX_COUNTED`` confirmed texts and over all documents.  The
steps of the training see a smaller sample (``MAX_TOXIC``, ``MAX_UNLABELLED`` rows); a feature that none of its examples
holds keeps the weight that its counts give it.  Samples are chosen by a hash of the id.  Confirmed texts are found by
their ids, which are sent to the documents: no text is shuffled.  Scoring passes over all rows once, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillmark.llm import words
from tillmark.llm.learning import Adam, SparseRows, bounded_sample, sigmoid
from tillmark.llm.shared import stored

MAX_COUNTED = 50_000
MAX_TOXIC = 4000
MAX_UNLABELLED = 12000
FEATURES = 1 << 16  # the size of a model: the words that tell most
LEAST_TOXIC = 4  # texts that a word must be in to count
LEAST_GAIN = 6.0  # standard errors: thousands of words are looked at, so a few by chance are far out
ROUNDS = 400
RATE = 0.05
DECAY = 1e-4
LEAST_PRIOR, MOST_PRIOR = 0.001, 0.5


@dataclass
class Model:
    vocabulary: words.Vocabulary
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        """Of every text, between 0 and 1; null and empty texts get what a text without telling words gets."""
        out = np.empty(len(column))
        for block in words.blocks(column, words.LETTERS):
            rows, numbers = present(block, self.vocabulary)
            total = np.bincount(rows, self.weights[numbers], block.last - block.first)
            out[block.first : block.last] = sigmoid(total + self.bias)
        return out


def present(block: words.Block, vocabulary: words.Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Text and number of every word of the vocabulary that a text holds, once per text."""
    places, numbers = vocabulary.find(block.hashes)
    rows = np.searchsorted(block.bounds, places, "right") - 1
    pairs = np.unique(rows * max(len(vocabulary), 1) + numbers)
    return np.divmod(pairs, max(len(vocabulary), 1))


def train(
    toxic: SparseRows, unlabelled: SparseRows, features: int, prior: float, start: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk under the logistic loss.

    ``start`` are weights for features that no toxic row holds: no step can tell them, so they stay as they are.
    """
    held = np.zeros(features + 1, bool)
    held[toxic.columns] = held[-1] = True
    weights = np.zeros(features + 1) if start is None else np.append(np.where(held[:-1], 0, start), 0.0)
    free = held if start is not None else np.ones(features + 1, bool)
    weights[-1] = np.log(prior / (1 - prior))
    step = Adam(features + 1, RATE)
    for _ in range(ROUNDS):
        p = sigmoid(toxic.times(weights) + weights[-1])
        u = sigmoid(unlabelled.times(weights) + weights[-1])
        negative = -np.log(1 - u + 1e-12).mean() - prior * -np.log(1 - p + 1e-12).mean()
        # Gradients of the losses by the margin: p - 1 for a toxic label, p for a clean one.
        by_p, by_u = prior * (p - 1) / toxic.count, np.zeros(unlabelled.count)
        if negative >= 0:
            by_p = by_p - prior * p / toxic.count
            by_u = u / unlabelled.count
        else:
            by_p, by_u = prior * p / toxic.count, -u / unlabelled.count
        gradient = np.append(toxic.gradient(by_p, features) + unlabelled.gradient(by_u, features), by_p.sum() + by_u.sum())
        gradient[:-1] += DECAY * weights[:-1]
        weights = weights - np.where(free, step.change(gradient), 0)
    return weights[:-1], float(weights[-1])


FILTER_BITS = 22


def _tallies(texts: DataFrame, maybe: np.ndarray | None = None) -> DataFrame:
    """word, texts: in how many texts a word is.  ``maybe`` tells by the first bits of a hash what can be left out."""

    def count(batches):
        for batch in batches:
            for block in words.blocks(batch.column(0), words.LETTERS):
                rows, hashes = block.rows(), block.hashes
                if maybe is not None:
                    wanted = maybe[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                    rows, hashes = rows[wanted], hashes[wanted]
                order = np.lexsort((rows, hashes))
                rows, hashes = rows[order], hashes[order]
                once = np.ones(len(rows), bool)
                once[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
                word, found = np.unique(hashes[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(found)], ["word", "texts"])

    counted = texts.select("text").mapInArrow(count, "word long, texts long")
    return counted.groupBy("word").agg(F.sum("texts").alias("texts"))


def telling_words(toxic: DataFrame, documents: DataFrame, n_toxic: int, n_documents: int) -> DataFrame:
    """word, gain and ratio (log of both shares) of the words that are clearly more frequent in toxic texts.

    Only words of enough toxic texts can be chosen; a bit for each first part of their hashes,
    as many bits at any size, keeps nearly all others out of the shuffle.
    """
    own = stored(_tallies(toxic).where(F.col("texts") >= LEAST_TOXIC).withColumnRenamed("texts", "p"))
    first = F.shiftrightunsigned("word", 64 - FILTER_BITS)
    maybe = np.zeros(1 << FILTER_BITS, bool)
    maybe[[r[0] for r in own.select(first.alias("b")).distinct().collect()]] = True
    every = _tallies(documents, maybe).withColumnRenamed("texts", "u")
    share_p = F.col("p") / n_toxic
    share_u = (F.coalesce("u", F.lit(0)) + 1) / n_documents
    # How far the share among toxic texts is above that among all, in standard errors.
    spread = F.sqrt(share_u * (1 - F.least(share_u, F.lit(0.999))) / n_toxic)
    told = own.join(every, "word", "left").withColumn("gain", (share_p - share_u) / spread)
    return told.where(F.col("gain") >= LEAST_GAIN).select("word", "gain", F.log(share_p / share_u).alias("ratio"))


def _rows(sample: DataFrame, vocabulary: words.Vocabulary) -> DataFrame:
    def rows(batches):
        for batch in batches:
            for block in words.blocks(batch.column(1), words.LETTERS):
                own, numbers = present(block, vocabulary)
                cuts = np.searchsorted(own, np.arange(block.last - block.first + 1)).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(cuts), pa.array(numbers.astype(np.int32)))
                toxic = batch.column(0).slice(block.first, block.last - block.first)
                yield pa.RecordBatch.from_arrays([toxic, listed], ["toxic", "features"])

    return sample.mapInArrow(rows, "toxic int, features array<int>")


def fit(
    documents: DataFrame,
    confirmed: DataFrame,
    prior: float,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_toxic: int = MAX_TOXIC,
    max_unlabelled: int = MAX_UNLABELLED,
) -> Model:
    """A model from the texts whose ids are in ``confirmed`` and from all ``documents`` as unlabelled text.

    Without a confirmed example, or without documents, the model gives every text the prior.
    """
    prior = min(max(prior, LEAST_PRIOR), MOST_PRIOR)
    documents = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    ids = bounded_sample(confirmed.select(F.col(id_column).alias("_id")).distinct(), MAX_COUNTED, "_id")
    every_toxic = documents.join(F.broadcast(ids), F.col("id") == F.col("_id"), "left_semi")  # MAX_COUNTED ids
    n_toxic, n_documents = every_toxic.count(), documents.count()
    if not n_toxic:
        return Model(words.Vocabulary(np.zeros(0, np.uint64)), np.zeros(1), float(np.log(prior / (1 - prior))))
    told = telling_words(every_toxic, documents, n_toxic, n_documents)
    chosen = told.orderBy(F.desc("gain"), "word").limit(FEATURES).select("word", "ratio").collect()
    hashes = np.array([r["word"] for r in chosen], np.int64).view(np.uint64)
    vocabulary = words.Vocabulary(hashes)
    start = np.array([r["ratio"] for r in chosen], float)[np.argsort(hashes)] if chosen else np.zeros(1)
    toxic = bounded_sample(every_toxic, max_toxic, "id")
    plain = bounded_sample(documents, max_unlabelled, "id")
    sample = toxic.select(F.lit(1).alias("toxic"), "text").unionByName(plain.select(F.lit(0).alias("toxic"), "text"))
    rows = _rows(sample, vocabulary).collect()  # as many as the sample has, of FEATURES numbers at most
    parts = [SparseRows([np.array(r["features"], np.int64) for r in rows if r["toxic"] == t]) for t in (1, 0)]
    weights, bias = train(*parts, max(len(vocabulary), 1), prior, start)
    return Model(vocabulary, weights, bias)


def scored(documents: DataFrame, model: Model, *, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """``documents`` with the score as a further column (an own column of that name is replaced)."""
    documents = documents.drop(score_column)
    schema = StructType([*documents.schema.fields, StructField(score_column, DoubleType())])

    def score(batches):
        for batch in batches:
            found = pa.array(model.score(batch.column(batch.schema.get_field_index(text_column))))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, score_column])

    return documents.mapInArrow(score, schema)


def fit_labelled(documents: DataFrame, labels: DataFrame, fold, *, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """``fit`` from a table of labels (1 toxic, 0 not), of which rows with ``fold`` 0 are not seen.

    The prior is the share of toxic rows among the labelled ones that may be seen; labels are used for nothing else.
    """
    seen = labels.where(fold != 0)
    share = seen.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    confirmed = seen.where(F.col("toxic") == 1)
    own = documents.where(fold != 0)
    return fit(own, confirmed, share or 0.0, id_column=id_column, text_column=text_column)
