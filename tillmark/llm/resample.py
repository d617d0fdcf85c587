"""Importance resampling towards a target distribution, over hashed n-gram features.

A text is folded, its separators are collapsed to single spaces, and one regular expression is run over it with
overlapping matches: every match starts at a word, and its groups are the spans of the runs of one, two and three
words there.  The checksum of a span's bytes, modulo the number of buckets, is the feature.  Buckets are counted over
the whole corpus and over all target texts; a bucket's gain is the logarithm of the ratio of both shares.  A document's
weight is the sum of the gains of its features, its score the weight plus Gumbel noise from a hash of its id, and the
highest scores are drawn, without replacement, as if in proportion to the importance weights.

Texts are scanned once: the buckets of a document are stored as two bytes for each feature, and both the counts and the
weights are taken from there.  What reaches the driver is one gain for each bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.shared import LOWER, UPPER, stored
from tillmark.operators.ranking import Ranks, asc, desc, with_ranks

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = (5, 100)
SEED = 42

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
# The separators of the contract's words, over UTF-8 bytes.
_SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# A word, and the two that may follow it; neither a word's inside nor a part of one is matched.
_RUNS = regex.compile(rb"(?<![^ ])([^ ]++)(?:( [^ ]++)( [^ ]++)?+)?+(?![^ ])")


def buckets(text: bytes, count: int = BUCKETS) -> tuple[int, list[int]]:
    """Number of words, and the bucket of every run of one to three words, repeats included."""
    spaced = _SEPARATORS.sub(b" ", text.translate(_FOLD)).strip(b" ")
    words, found = 0, []
    add = found.append
    for match in _RUNS.finditer(spaced, overlapped=True):
        first, second, third = match.groups()
        words += 1
        sum_ = crc32(first)
        add(sum_ % count)
        if second is not None:
            # The checksum goes on over the span's further bytes.
            sum_ = crc32(second, sum_)
            add(sum_ % count)
            if third is not None:
                add(crc32(third, sum_) % count)
    return words, found


def _scanned(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    """Kept columns, n_words, n_features, buckets; the text is the last column coming in."""
    for batch in batches:
        words, sizes, packed = [], [], []
        for text in batch.column(batch.num_columns - 1):
            n, found = buckets((text.as_py() or "").encode(), count)
            words.append(n)
            sizes.append(len(found))
            packed.append(np.array(found, "<u2").tobytes())
        arrays = [*batch.columns[:-1], pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], "n_words", "n_features", "buckets"])


def scanned(texts: DataFrame, text: Column, kept: dict[str, Column], count: int = BUCKETS) -> DataFrame:
    """The columns ``kept``, n_words, n_features and buckets (two bytes each, the low one first) of every row."""
    if not 0 < count <= 1 << 16:
        raise ValueError("a bucket must fit into two bytes")
    rows = texts.select(*[c.alias(name) for name, c in kept.items()], text.cast("string").alias("text"))
    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    schema = f"{own}n_words long, n_features long, buckets binary"
    return rows.mapInArrow(partial(_scanned, count=count), schema)


def _numbers(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), "<u2") for value in column]


def _tallied(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    """One row for each bucket that the task has met."""
    total = np.zeros(count, np.int64)
    for batch in batches:
        for found in _numbers(batch.column(0)):
            total += np.bincount(found, minlength=count) if len(found) > count else 0
            if len(found) <= count:
                np.add.at(total, found, 1)
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])


def tallies(features: DataFrame, count: int = BUCKETS) -> DataFrame:
    """bucket, n over all rows of ``scanned``; a task adds up its own rows first."""
    found = features.select("buckets").mapInArrow(partial(_tallied, count=count), "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, count: int = BUCKETS) -> np.ndarray:
    """Of every bucket, from the two ``tallies``: thousandths of the natural logarithm, rounded down."""
    both = source.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full")
    s, t = np.zeros(count), np.zeros(count)
    for row in both.select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in "st"]).collect():  # at most one a bucket
        s[row.bucket], t[row.bucket] = row.s, row.t
    share = ((t + 1) * (s.sum() + count)) / ((s + 1) * (t.sum() + count))
    return np.array([math.floor(1000 * math.log(x)) for x in share], np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], by_bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        weights = [int(by_bucket[found].sum()) for found in _numbers(batch.column(batch.num_columns - 1))]
        names = [*batch.schema.names[:-1], "weight"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(weights, pa.int64())], names)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of ``key``; a null key counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resampled(
    documents: DataFrame,
    target: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    share: tuple[int, int] = SHARE,
    least_words: int = LEAST_WORDS,
    count: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """id, n_words, n_features, weight, score and rank of every row of ``documents``.

    ``share`` (a part and a whole) of the rows with ``least_words`` words or more is drawn, rounded down; rank is 1 for
    the highest score, of equal ones for the smallest id, and null where a row is not drawn.  A null text has no words,
    and weight 0.  Rows of one id have the same noise; where they tie, the one of fewer features comes first.  An empty
    target makes rare buckets gain and frequent ones lose; an empty table gives no row.
    """
    features = stored(scanned(documents, F.col(text_column), {id_column: F.col(id_column)}, count))
    wanted = scanned(target, F.col(target_text), {}, count)
    by_bucket = gains(tallies(features, count), tallies(wanted, count), count)
    schema = f"`{id_column}` {features.schema[0].dataType.simpleString()}, n_words long, n_features long, weight long"
    weighed = features.mapInArrow(partial(_weighed, by_bucket=by_bucket), schema)
    weighed = stored(weighed.withColumn("score", F.col("weight") + noise(F.col(id_column), seed)))
    able = weighed.where(F.col("n_words") >= least_words)
    drawn = able.count() * share[0] // share[1]
    order = Ranks([desc("score")], tie_break=(id_column, "n_features"), row_number="rank")
    ranked = with_ranks(able, order)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = weighed.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)
