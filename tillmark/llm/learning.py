"""What the classifiers of this subpackage share: bounded samples, linear models over sparse rows, scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SHARES = 1 << 24


def fold(id_column: str, folds: int = 5) -> Column:
    """The remainder that decides what is held out; a null id falls into fold 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds, F.lit(0))


def bounded_sample(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """At most ``most`` rows: all where there are no more, else chosen by a hash, the same ones at every run.

    The hash is of ``key`` and the whole row, so that rows of one key, or without one, are chosen apart; rows that are
    alike in every column count once.  No column may be a map.
    """
    if rows.count() <= most:
        return rows
    hashed = rows.withColumn("_hash", F.xxhash64(*key, *[c for c in rows.columns if c not in key]))
    different = hashed.agg(F.approx_count_distinct("_hash", 0.02)).first()[0]
    # Somewhat more than are wanted, so that few rows are compared and sorted.
    share = F.pmod("_hash", F.lit(_SHARES))
    some = hashed.where(share < int(1.5 * _SHARES * most / different) + 1).dropDuplicates(["_hash"])
    return some.orderBy(F.pmod("_hash", F.lit(_SHARES)), "_hash").limit(most).drop("_hash")


class SparseRows:
    """0/1 rows as feature numbers one after the other."""

    def __init__(self, rows: list[np.ndarray]):
        sizes = np.array([len(r) for r in rows], np.int64)
        self.count = len(rows)
        self.columns = np.concatenate(rows).astype(np.int64) if rows and sizes.sum() else np.zeros(0, np.int64)
        self.rows = np.repeat(np.arange(self.count), sizes)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.count)

    def gradient(self, by_row: np.ndarray, features: int) -> np.ndarray:
        return np.bincount(self.columns, by_row[self.rows], features)


class Adam:
    def __init__(self, size: int, rate: float):
        self.rate, self.step = rate, 0
        self.first, self.second = np.zeros(size), np.zeros(size)

    def change(self, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.first += 0.1 * (gradient - self.first)
        self.second += 0.001 * (gradient * gradient - self.second)
        first = self.first / (1 - 0.9**self.step)
        second = self.second / (1 - 0.999**self.step)
        return self.rate * first / (np.sqrt(second) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))
