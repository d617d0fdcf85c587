"""Quality by co-training of two views.

One classifier sees what a text is made of (its byte trigrams), the other what is known about the page it stood on
(source, language, length, lines, shares of kinds of signs, how often words repeat).  Both start from the same labelled
rows.  In every round each names the unlabelled rows it is surest of, and the other one learns them as if they were
labelled.  At the end each view is calibrated on labelled rows that no round has trained on, and a row's score is the
calibrated mean of both, on the logarithmic scale.

Training sees bounded samples chosen by a hash of the id (``MAX_LABELLED``, ``MAX_UNLABELLED`` rows); scoring passes
over all rows once, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillmark.llm import words
from tillmark.llm.learning import Adam, bounded_sample, sigmoid

MAX_LABELLED = 4000
MAX_UNLABELLED = 4000
TRIGRAMS = 1024
SOURCES, LANGUAGES = 16, 16
SHAPE = 11
META = SHAPE + SOURCES + LANGUAGES
ROUNDS = 6
SHARE = 0.04  # of the unlabelled rows that each view names in a round
STEPS = 250
DECAY = 1e-3

_byte = np.arange(256)
_upper = (_byte >= 0x41) & (_byte <= 0x5A)
_digit = (_byte >= 0x30) & (_byte <= 0x39)
_sign = ((_byte >= 0x21) & (_byte <= 0x7E)) & ~words.LETTERS
_blank = (_byte <= 0x20) & (_byte != 0x0A)
_line = _byte == 0x0A
_KINDS = [_upper, _digit, _sign, _blank, _line]


def _trigrams(block: words.Block) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every byte trigram; a text of one or two bytes has none."""
    b = words.FOLD[block.data].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 10)
    rows = np.repeat(np.arange(block.last - block.first), np.diff(block.offsets))
    whole = rows[:-2] == rows[2:]
    return rows[:-2][whole], bucket[whole].astype(np.int64)


def _hash_bucket(column: pa.Array, buckets: int) -> np.ndarray:
    """Of short strings; null is a value of its own."""
    code = pc.dictionary_encode(pc.fill_null(column.cast(pa.string()), "\0"))
    names = [int(words.mix(words.hash_text(v, words.SOLID)).sum(dtype=np.uint64) % np.uint64(buckets)) for v in code.dictionary.to_pylist()]
    return np.array(names, np.int64)[np.asarray(code.indices)] if len(column) else np.zeros(0, np.int64)


def page_view(block: words.Block, source: np.ndarray, language: np.ndarray) -> np.ndarray:
    """One row of ``META`` numbers for each text of a block."""
    count = block.last - block.first
    size = np.diff(block.offsets)
    n = np.diff(block.bounds)
    out = np.zeros((count, META))
    safe = np.maximum(size, 1)
    for place, kind in enumerate(_KINDS):
        sums = np.concatenate(([0], np.cumsum(kind[block.data])))
        out[:, place] = (sums[block.offsets[1:]] - sums[block.offsets[:-1]]) / safe
    _, bounds = words.distinct_sets(block, 1)
    length = np.concatenate(([0], np.cumsum(block.ends - block.starts)))
    out[:, 5] = np.log1p(size)
    out[:, 6] = np.log1p(n)
    out[:, 7] = np.diff(bounds) / np.maximum(n, 1) ** 0.8
    out[:, 8] = (length[block.bounds[1:]] - length[block.bounds[:-1]]) / np.maximum(n, 1)
    out[:, 9] = n == 0
    out[:, 10] = np.log1p(size / (1 + out[:, 4] * size))
    at = np.arange(count)
    out[at, SHAPE + source[block.first : block.last]] = 1
    out[at, SHAPE + SOURCES + language[block.first : block.last]] = 1
    return out


@dataclass
class View:
    """A logistic model over standardised features, and its calibration."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (((x - self.mean) / self.spread) @ self.weights + self.bias) + self.shift

    def linear(self) -> tuple[np.ndarray, float]:
        """The same as one weight for each plain feature and a constant."""
        w = self.weights / self.spread
        return self.slope * w, self.slope * (self.bias - float(self.mean @ w)) + self.shift


def learn(x: np.ndarray, y: np.ndarray) -> View:
    """A view from 0/1 labels, both classes weighing as much as they are many."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - mean) / spread
    parameters = np.zeros(x.shape[1] + 1)
    step = Adam(len(parameters), 0.03)
    for _ in range(STEPS):
        off = sigmoid(z @ parameters[:-1] + parameters[-1]) - y
        gradient = np.append(off @ z / len(y) + DECAY * parameters[:-1], off.mean())
        parameters -= step.change(gradient)
    return View(mean, spread, parameters[:-1], float(parameters[-1]))


def calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the margins log-odds of the labels."""
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    parameters, step = np.array([1.0, 0.0]), Adam(2, 0.05)
    for _ in range(STEPS):
        off = sigmoid(parameters[0] * margins + parameters[1]) - y
        parameters -= step.change(np.array([(off * margins).mean() + 1e-3 * (parameters[0] - 1), off.mean()]))
    return float(max(parameters[0], 1e-3)), float(parameters[1])


def cotrain(views: list[np.ndarray], labels: np.ndarray, pools: list[np.ndarray], rounds: int = ROUNDS) -> list[View]:
    """Both views after some rounds of teaching each other rows of the unlabelled ``pools``.

    A quarter of the labelled rows only calibrates.
    """
    held = np.arange(len(labels)) % 4 == 3
    own = [[v[~held]] for v in views]
    targets = [[labels[~held]], [labels[~held]]]
    free = np.ones(len(pools[0]), bool)
    prior = labels.mean()
    for turn in range(rounds + 1):
        models = [learn(np.concatenate(own[k]), np.concatenate(targets[k])) for k in (0, 1)]
        if turn == rounds or not free.any():
            break
        for k in (0, 1):
            left = np.flatnonzero(free)
            margins = models[k].margin(pools[k][left])
            order = np.argsort(margins, kind="stable")
            wanted = max(2, int(SHARE * len(pools[0])))
            low, high = max(1, int(wanted * (1 - prior))), max(1, int(wanted * prior))
            bad, good = order[:low], order[max(low, len(order) - high) :]
            bad, good = bad[margins[bad] < 0], good[margins[good] > 0]
            chosen = left[np.concatenate([bad, good])]
            if len(chosen):
                own[1 - k].append(pools[1 - k][chosen])
                targets[1 - k].append(np.concatenate([np.zeros(len(bad)), np.ones(len(good))]))
                free[chosen] = False
    for k in (0, 1):
        if held.any():
            models[k].slope, models[k].shift = calibrate(models[k].margin(views[k][held]), labels[held])
    return models


@dataclass
class Model:
    text: View
    page: View

    def score(self, text: pa.Array, source: pa.Array, language: pa.Array) -> tuple[np.ndarray, ...]:
        """Text score, page score and the combined one, between 0 and 1."""
        weights, constant = self.text.linear()
        sources, languages = _hash_bucket(source, SOURCES), _hash_bucket(language, LANGUAGES)
        margins = np.empty((2, len(text)))
        for block in words.blocks(text, words.LETTERS):
            rows, buckets = _trigrams(block)
            count = block.last - block.first
            held = np.maximum(np.bincount(rows, minlength=count), 1)
            margins[0, block.first : block.last] = np.bincount(rows, weights[buckets], count) / held + constant
            margins[1, block.first : block.last] = self.page.margin(page_view(block, sources, languages))
        return sigmoid(margins[0]), sigmoid(margins[1]), sigmoid(margins.mean(axis=0))


def _features(sample: DataFrame) -> DataFrame:
    """label, text and page view of a sample (label, text, source, lang) as raw doubles."""

    def rows(batches):
        for batch in batches:
            text, source, language = (batch.column(i) for i in (1, 2, 3))
            sources, languages = _hash_bucket(source, SOURCES), _hash_bucket(language, LANGUAGES)
            for block in words.blocks(text, words.LETTERS):
                count = block.last - block.first
                page = page_view(block, sources, languages)
                own, buckets = _trigrams(block)
                cuts = np.searchsorted(own, np.arange(count + 1))
                raw = []
                for low, high in zip(cuts[:-1], cuts[1:]):
                    grams = np.bincount(buckets[low:high], minlength=TRIGRAMS).astype(np.float32)
                    raw.append((grams / np.float32(max(high - low, 1))).tobytes())
                arrays = [batch.column(0).slice(block.first, count), pa.array(raw, pa.binary())]
                arrays.append(pa.array([row.tobytes() for row in page], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, ["label", "grams", "page"])

    return sample.mapInArrow(rows, "label int, grams binary, page binary")


def fit(
    documents: DataFrame,
    labels: DataFrame,
    seen: Column,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    language_column: str = "lang",
    label_column: str = "quality",
) -> Model | None:
    """A model from ``labels`` (1 good, 0 bad) and other documents, of rows for which ``seen`` holds only.

    None where the labelled sample does not hold both classes: nothing can be learnt then.
    """
    named = labels.where(seen & F.col(label_column).isNotNull()).groupBy(F.col(id_column).alias("_id"))
    known = named.agg(F.max(F.col(label_column).cast("int")).alias("label"))
    known = bounded_sample(known, MAX_LABELLED, "_id")
    text = ["text", "source", "lang"]
    rows = documents.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.col(source_column).cast("string").alias("source"),
        F.col(language_column).cast("string").alias("lang"),
        seen.alias("seen"),
    )
    own = rows.join(F.broadcast(known), F.col("id") == F.col("_id"))  # MAX_LABELLED ids
    own = bounded_sample(own, MAX_LABELLED, "id")  # an id may repeat
    pool = bounded_sample(rows.where("seen"), MAX_UNLABELLED, "id")
    rows = _features(own.select("label", *text)).collect()
    free = _features(pool.select(F.lit(-1).alias("label"), *text)).collect()
    rows.sort(key=lambda r: (bytes(r["page"]), r["label"]))  # the same order at every run
    free.sort(key=lambda r: bytes(r["page"]))
    target = np.array([r["label"] for r in rows], float)
    if len(set(target.tolist())) < 2:
        return None

    def stacked(found):
        grams = np.array([np.frombuffer(r["grams"], np.float32) for r in found]).reshape(-1, TRIGRAMS)
        return [grams, np.array([np.frombuffer(r["page"]) for r in found]).reshape(-1, META)]

    mixed = np.random.default_rng(7).permutation(len(rows))
    return Model(*cotrain([v[mixed] for v in stacked(rows)], target[mixed], stacked(free)))


def scored(
    documents: DataFrame,
    model: Model | None,
    *,
    text_column: str = "text",
    source_column: str = "source",
    language_column: str = "lang",
) -> DataFrame:
    """``documents`` with text_score, page_score and score (own columns of these names are replaced).

    Without a model all three are 0.5.  Null and empty texts are scored by their page alone and an empty text view.
    """
    names = ["text_score", "page_score", "score"]
    documents = documents.drop(*names)
    schema = StructType([*documents.schema.fields, *[StructField(n, DoubleType()) for n in names]])

    def score(batches):
        for batch in batches:
            at = [batch.schema.get_field_index(c) for c in (text_column, source_column, language_column)]
            parts = model.score(*[batch.column(i) for i in at]) if model else [np.full(batch.num_rows, 0.5)] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, parts)], [*batch.schema.names, *names])

    return documents.mapInArrow(score, schema)
