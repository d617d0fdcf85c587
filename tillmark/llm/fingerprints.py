"""Document fingerprints: MinHash over word shingles.

``PERMUTATIONS`` universal hash functions (odd multiplier and offset modulo 2^32, hence permutations of all 32-bit
values) are applied to the shingles of a text; of the smallest value of each, one byte is kept.  Equal texts have equal
fingerprints, and the share of equal bytes, less what chance alone makes equal, estimates the Jaccard similarity.

For near-duplicates the smallest values are cut into bands; texts that agree in a band are candidates, found by a shuffle
on the band in Spark, and candidates are verified by the exact similarity of their shingle sets.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tillmark.llm import jaccard, words

SHINGLE = 5
PERMUTATIONS = 128
THRESHOLD = Fraction(80, 100)
_CHANCE = 1 / 256

_random = np.random.default_rng(20240501)
MULTIPLIERS = _random.integers(0, 1 << 32, 256, np.uint32) | np.uint32(1)
OFFSETS = _random.integers(0, 1 << 32, 256, np.uint32)
_PIECE = 1 << 16
# Text of one run of consecutive documents, as much as a task should read; rows of one batch that goes out.
RUN_BYTES = 64 << 20
_ROWS = 10_000
# So many code points order the rows of one id.
HEAD = 32


def _least(rows: np.ndarray, hashes: np.ndarray, count: int, permutations: int = PERMUTATIONS) -> np.ndarray:
    """The smallest value of every permutation for every text; all ones where a text has no shingle."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full((permutations, count), 0xFFFFFFFF, np.uint32)
    # Some tens of thousands of shingles at a time stay in the processor's cache over all permutations.
    for start in range(0, len(low), _PIECE):
        part, own = low[start : start + _PIECE], rows[start : start + _PIECE]
        opens = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        at, values = own[opens], np.empty(len(part), np.uint32)
        for p in range(permutations):
            np.multiply(part, MULTIPLIERS[p], out=values)
            values += OFFSETS[p]
            out[p, at] = np.minimum(out[p, at], np.minimum.reduceat(values, opens))
    return out.T


def _bytes(least: np.ndarray) -> np.ndarray:
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def fingerprints(column: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """One row of bytes for each text.  Null and empty texts have a fingerprint of their own."""
    out = np.empty((len(column), PERMUTATIONS), np.uint8)
    for block in words.blocks(column, words.SOLID):
        rows, hashes = words.shingles(block, size)
        order = np.argsort(rows, kind="stable") if len(rows) and (np.diff(rows) < 0).any() else slice(None)
        out[block.first : block.last] = _bytes(_least(rows[order], hashes[order], block.last - block.first))
    return out


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of fingerprints, between 0 and 1."""
    same = (one == other).mean(axis=-1)
    return np.clip((same - _CHANCE) / (1 - _CHANCE), 0.0, 1.0)


def fingerprinted(documents: DataFrame, *, text_column: str = "text", column: str = "fingerprint") -> DataFrame:
    """``documents`` with the fingerprint as hexadecimal text in ``column``, which is replaced if there is one."""
    documents = documents.drop(column)
    schema = StructType([*documents.schema.fields, StructField(column, StringType())])

    def add(batches):
        for batch in batches:
            found = [f.tobytes().hex() for f in fingerprints(batch.column(batch.schema.get_field_index(text_column)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, column])

    return documents.mapInArrow(add, schema)


class Bands:
    """Block keys for the Jaccard join: bands of ``rows`` smallest values each.

    Sets of similarity *s* share one of *b* bands of *r* values with a probability of 1 - (1 - s^r)^b; for 48 bands of
    4 and s = 0.8 all but one in 10^11 do.
    """

    def __init__(self, bands: int = 48, rows: int = 4):
        self.bands, self.rows = bands, rows

    def __call__(self, block: words.Block, hashes: np.ndarray, bounds: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        sizes = np.where(wanted, np.diff(bounds), 0)
        own = np.repeat(np.arange(len(sizes)), np.diff(bounds))
        keep = wanted[own]
        least = _least(own[keep], hashes[keep], len(sizes), self.bands * self.rows)
        keys = np.zeros((len(sizes), self.bands), np.uint64)
        keys += words.mix(np.arange(self.bands, dtype=np.uint64))
        for row in range(self.rows):
            keys = words.mix(keys ^ least[:, row :: self.rows].astype(np.uint64))
        return [keys[i] if sizes[i] else keys[i][:0] for i in range(len(sizes))]


def near_duplicates(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """One row per row of ``documents`` with its component of near-duplicates, as ``jaccard.linked`` returns them.

    Candidates are texts that share a band; every link is verified, a link is missed only where no band agrees.
    """
    return jaccard.linked(
        documents, id_column=id_column, text_column=text_column, size=size, threshold=threshold, signer=Bands()
    )


def with_next(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", run_bytes: int = RUN_BYTES
) -> DataFrame:
    """``documents`` sorted by id in runs: columns id, text, _copies, _run, _border.

    Every run is one stretch of the ascending order in one task, and ends in border rows, copies of the row that follows
    its last one (the very first row for the last run), which belongs to the next run.  A run holds some ``run_bytes`` of
    text, so their number follows the data.  Ids may be of any type that has an order; a null id comes first.  Rows of one
    id are ordered by the first ``HEAD`` code points of their text and then by its hash, so they may be in many runs.
    Equal rows are folded, batch by batch, into one that says how many they are.  The text is shuffled once, by run.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    order = ["id", "head", "hash"]
    rows = documents.select(
        F.col(id_column).alias("id"), F.left(text, F.lit(HEAD)).alias("head"), F.xxhash64(text).alias("hash"), text.alias("text")
    )
    narrow = rows.groupBy(*order).agg(F.max(F.octet_length("text")).alias("bytes"))
    narrow = narrow.repartitionByRange(*order).sortWithinPartitions(*order)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = run_bytes  # the first row of a task opens a run
        for batch in batches:
            at = []
            for place, size in enumerate(batch.column(3).to_pylist()):
                if held >= run_bytes:
                    at.append(place)
                    held = 0
                held += size
            yield batch.select(order).take(pa.array(at, pa.int64()))

    def key(row) -> tuple:
        return row[0] is not None, *row

    firsts = narrow.mapInArrow(opened, rows.select(*order).schema).toArrow()  # one short row for each run
    bounds = sorted(map(key, zip(*(firsts.column(c).to_pylist() for c in order))))
    runs = max(len(bounds), 1)
    schema = StructType(
        [
            *rows.schema.fields,
            StructField("_copies", LongType()),
            StructField("_run", IntegerType()),
            StructField("_border", BooleanType()),
        ]
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies: dict[tuple, list[int]] = {}
            for place, row in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                copies.setdefault(row, [place, 0])[1] += 1
            out = []
            for row, (place, count) in copies.items():
                own = key(row[:3])
                run = bisect_right(bounds, own) - 1
                out.append((place, count, run, False))
                if bounds[run] == own:
                    out.append((place, 1, (run - 1) % runs, True))
            if out:
                at, *added = map(list, zip(*out))
                added = [pa.array(v, t) for v, t in zip(added, (pa.int64(), pa.int32(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at)).columns, *added], schema.names)

    spread = rows.mapInArrow(placed, schema).repartitionById(runs, F.col("_run"))
    return spread.sortWithinPartitions("_run", "_border", *order, "text").drop("head", "hash")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the following text's first, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_compared(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", run_bytes: int = RUN_BYTES
) -> DataFrame:
    """Every row with its text's fingerprint, that of the text edited with the next row's, and their likeness.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.  The row after the
    last is the first, so a single row is followed by itself; a null text counts as empty; repeated rows follow each
    other, each with a row of its own in the result.  Order among rows of one id: see ``with_next``.  An empty table gives
    none; long texts are taken whole, and a row is held with its next one only.
    """
    rows = with_next(documents, id_column=id_column, text_column=text_column, run_bytes=run_bytes)
    schema = StructType(
        [
            StructField(id_column, rows.schema["id"].dataType),
            StructField("n_chars", LongType()),
            StructField("edited_sha256", StringType()),
            StructField("fingerprint", StringType()),
            StructField("edited_fingerprint", StringType()),
            StructField("near_edited", DoubleType()),
            StructField("near_next", DoubleType()),
        ]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # a row whose next one comes with the next batch
        for batch in batches:
            prints = fingerprints(batch.column(1))
            ids, texts, copies, runs, borders = (c.to_pylist() for c in batch.columns)
            if waiting is not None:
                for column, value in zip((ids, texts, copies, runs, borders), waiting):
                    column.insert(0, value)
                prints = np.concatenate([waiting[-1][None], prints])
            if len(ids):
                waiting = (ids[-1], texts[-1], copies[-1], runs[-1], borders[-1], prints[-1])
            at = [i for i in range(len(ids) - 1) if not borders[i] and runs[i] == runs[i + 1]]
            if not at:
                continue
            # All copies of a row but one are followed by a copy.
            pairs = [(i, i + 1, 1) for i in at] + [(i, i, copies[i] - 1) for i in at if copies[i] > 1]
            first, then, times = (np.array(column) for column in zip(*pairs))
            new = [edited(texts[i], texts[j]) for i, j, _ in pairs]
            changed = fingerprints(pa.array(new, pa.large_string()))
            own, following = prints[first], prints[then]
            columns = [
                pa.array([ids[i] for i in first], batch.schema.field(0).type),
                pa.array([len(texts[i]) for i in first], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]),
                pa.array([f.tobytes().hex() for f in own]),
                pa.array([f.tobytes().hex() for f in changed]),
                pa.array(likeness(own, changed)),
                pa.array(likeness(own, following)),
            ]
            found = pa.RecordBatch.from_arrays(columns, schema.names)
            ends = np.cumsum(times)
            for start in range(0, int(ends[-1]), _ROWS):
                asked = np.arange(start, min(start + _ROWS, ends[-1]))
                yield found.take(pa.array(np.searchsorted(ends, asked, side="right")))

    return rows.mapInArrow(compare, schema)
