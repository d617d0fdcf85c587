"""The items with the largest inner product for every user, exactly, without scoring all pairs.

Items are put in bands by descending norm, each twice as long as the one before up to a limit.  An inner product is at
most the product of both norms, so a user whose k-th best score so far exceeds the own norm times the largest norm of a
band needs neither that band nor any after it.  All users score the first band, of some hundred items, and learn how
far they have to go; a user then meets the needed bands and no others.

Users are dealt to shares and sent once, with what they have found; every share gets the further items by descending
norm, and holds its users and their k best while the items stream by.  What a user has found so far is the floor of
what comes next, so the user is done as soon as no norm to come can reach it, and nothing but the final lists leaves a
task.  How much is spared depends on how the norms are spread; in the worst case all pairs are scored, never more.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.operators.durable import checkpointed
from tillmark.operators.ranking import Ranks, desc, with_ranks

FIRST_BAND, LONGEST_BAND = 256, 4096
# Users that a task holds, some 400 bytes each, and those that are worth a share of their own.
USERS_A_SHARE, LEAST_SHARE = 250_000, 5_000
_ROWS = 1024  # users scored at a time
_FOUND = 1 << 18  # scores near a floor or above it that are worked out at a time
# A computed score may exceed the product of the computed norms by rounding; a band is left out only beyond this.
_SLACK = 1 + 1e-5

PROBED = "user int, features array<float>, last int, items array<int>, scores array<float>"


def band_of(place: Column, first: int = FIRST_BAND, longest: int = LONGEST_BAND) -> Column:
    """Band of a place, counted from 0, in the order of norms."""
    doubling = F.ceil(F.log2((place + 1) / first))
    steps = int(np.log2(longest // first))
    return F.when(place < longest, F.greatest(F.lit(0), doubling)).otherwise(F.lit(steps) + F.floor(place / longest)).cast("int")


def norm(features: Column) -> Column:
    squares = F.transform(features, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, b: a + b))


def banded(items: DataFrame, first: int = FIRST_BAND, longest: int = LONGEST_BAND) -> DataFrame:
    """item, features, norm and band of (id, features); the numbering is distributed."""
    rows = items.select(F.col("id").alias("item"), "features", norm(F.col("features")).alias("norm"))
    ranked = with_ranks(rows, Ranks([desc("norm")], ["item"], row_number="_place"))
    return ranked.select("item", "features", "norm", band_of(F.col("_place") - 1, first, longest).alias("band"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None):
    """(row, id, score) of each row's k largest scores, of equal ones the smallest ids; none below the row's floor."""
    least = np.full(len(scores), -np.inf, np.float32) if floor is None else floor
    if scores.shape[1] > k:
        least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
    rows, places = np.nonzero(scores >= least[:, None])
    own, values = ids[places], scores[rows, places]
    order = np.lexsort((own, -values, rows))
    rows, own, values = rows[order], own[order], values[order]
    starts = np.searchsorted(rows, rows)
    kept = np.arange(len(rows)) - starts < k
    return rows[kept], own[kept], values[kept]


def _probe(batches: Iterator[pa.RecordBatch], ids: np.ndarray, factors: np.ndarray, norms: np.ndarray, k: int):
    """Best items of the first band, and the last band that may hold a better one (0: none)."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            users = _matrix(part.column(1))
            scores = (users @ factors.T).astype(np.float32)
            rows, own, values = _best(scores, ids, k)
            bounds = np.searchsorted(rows, np.arange(part.num_rows + 1))
            floor = np.full(part.num_rows, -np.inf)
            full = np.flatnonzero(np.diff(bounds) == k)
            floor[full] = values[bounds[full + 1] - 1]
            most = np.linalg.norm(users, axis=1)[:, None] * norms[None, :] * _SLACK
            last = (most >= floor[:, None]).sum(axis=1)  # norms descend, so the needed bands come first
            offsets = pa.array(bounds, pa.int32())
            columns = [part.column(0), part.column(1), pa.array(last, pa.int32())]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(own, pa.int32()))]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(values, pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, ["user", "features", "last", "items", "scores"])


class _Share:
    """The users of a share and their k best items so far."""

    def __init__(self, batches: list[pa.RecordBatch], k: int):
        self.k = k
        self.ids = np.concatenate([np.asarray(b.column("id")) for b in batches])
        self.users = np.concatenate([_matrix(b.column("features")) for b in batches])
        self.norms = np.linalg.norm(self.users, axis=1)
        self.narrow = self.users.astype(np.float32)
        # Rows of a user that has found fewer than k end in places of no item.
        self.items = np.full((len(self.ids), k), -1, np.int32)
        self.scores = np.full((len(self.ids), k), -np.inf, np.float32)
        counts = np.concatenate([np.diff(np.asarray(b.column("items").offsets)) for b in batches])
        rows = np.repeat(np.arange(len(counts)), counts)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.items[rows, places] = np.concatenate([np.asarray(b.column("items").flatten()) for b in batches])
        self.scores[rows, places] = np.concatenate([np.asarray(b.column("scores").flatten()) for b in batches])

    def meet(self, ids: np.ndarray, factors: np.ndarray, largest: float) -> None:
        """Items whose norm is at most ``largest``.  Single precision says which scores are near a floor or above it."""
        narrow = factors.astype(np.float32)
        going = np.flatnonzero(self.norms * largest * _SLACK >= self.scores[:, -1])
        for at in range(0, len(going), _ROWS):
            own = going[at : at + _ROWS]
            # The most that rounding can take from a score of so many terms.
            slack = self.norms[own] * largest * (4 + factors.shape[1]) * 2.5e-7
            floor = (self.scores[own, -1] - slack).astype(np.float32)
            places = np.flatnonzero((self.narrow[own] @ narrow.T) >= floor[:, None])
            rows, columns = own[places // len(ids)], places % len(ids)
            for part in range(0, len(rows), _FOUND):
                self._take(rows[part : part + _FOUND], columns[part : part + _FOUND], ids, factors)

    def _take(self, rows: np.ndarray, columns: np.ndarray, ids: np.ndarray, factors: np.ndarray) -> None:
        values = np.einsum("ij,ij->i", self.users[rows], factors[columns]).astype(np.float32)
        near = values >= self.scores[rows, -1]
        rows, own, values = rows[near], ids[columns[near]], values[near]
        touched = np.unique(rows)
        rows = np.concatenate([np.repeat(touched, self.k), rows])
        own = np.concatenate([self.items[touched].ravel(), own])
        values = np.concatenate([self.scores[touched].ravel(), values])
        order = np.lexsort((own, -values, rows))
        rows, own, values = rows[order], own[order], values[order]
        places = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = places < self.k
        self.items[rows[kept], places[kept]] = own[kept]
        self.scores[rows[kept], places[kept]] = values[kept]

    def lists(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.ids), _ROWS):
            rows, places = np.nonzero(np.isfinite(self.scores[at : at + _ROWS]))
            columns = [self.ids[at + rows], self.items[at + rows, places], self.scores[at + rows, places]]
            columns += [(places + 1).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["user", "item", "score", "place"])


def _stream(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by share, kind and descending norm: a share's users, then the items.  The users' lists."""
    share, waiting, held = None, [], None
    for batch in batches:
        shares, kinds = np.asarray(batch.column("share")), np.asarray(batch.column("kind"))
        edges = np.flatnonzero((np.diff(shares) != 0) | (np.diff(kinds) != 0)) + 1
        for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
            if start == stop:
                continue
            part = batch.slice(start, stop - start)
            if shares[start] != share:
                if held or waiting:
                    yield from (held or _Share(waiting, k)).lists()
                share, waiting, held = shares[start], [], None
            if kinds[start] == 0:
                waiting.append(part)
                continue
            if held is None and waiting:
                held, waiting = _Share(waiting, k), []
            for at in range(0, part.num_rows if held else 0, LONGEST_BAND):
                items = part.slice(at, LONGEST_BAND)
                held.meet(np.asarray(items.column("id")), _matrix(items.column("features")), items.column("norm")[0].as_py())
    if held or waiting:
        yield from (held or _Share(waiting, k)).lists()


def probed(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """What every user finds in the first band of ``banded`` items, and the last band to go to; stored.

    Of the items the driver holds the first band and one norm for each further one.
    """
    first = items.where("band = 0").orderBy("item").collect()
    norms = [r[0] for r in items.where("band > 0").groupBy("band").agg(F.max("norm").alias("n")).orderBy("band").select("n").collect()]
    ids = np.array([r.item for r in first], np.int32)
    factors = np.array([r.features for r in first], np.float64).reshape(len(first), -1)
    probe = partial(_probe, ids=ids, factors=factors, norms=np.array(norms), k=k)
    return checkpointed(users.select(F.col("id").cast("int"), "features").mapInArrow(probe, PROBED))


def largest_products(users: DataFrame, items: DataFrame, k: int, first: int = FIRST_BAND, longest: int = LONGEST_BAND) -> DataFrame:
    """user, item, score and place (1 to ``k``) from two tables of (id, features).

    Scores are single-precision, as computed in double; of equal ones the smaller item comes first.  Fewer items than
    ``k`` give shorter lists; no item gives none.
    """
    ranked = checkpointed(banded(items, first, longest))
    if ranked.isEmpty():
        return users.select(*[F.lit(0).cast(t).alias(c) for c, t in (("user", "int"), ("item", "int"), ("score", "float"), ("place", "int"))]).limit(0)
    found = probed(users, ranked, k)
    # Every share is sent all further items: as few shares as keep the cluster busy and fit a task.
    rows, cores = found.count(), users.sparkSession.sparkContext.defaultParallelism
    shares = max(-(-rows // USERS_A_SHARE), min(cores, -(-rows // LEAST_SHARE)), 1)
    wanted = found.where("last > 0").select(
        F.pmod(F.xxhash64("user"), F.lit(shares)).cast("int").alias("share"),
        F.lit(0).alias("kind"),
        F.lit(0.0).alias("norm"),
        F.col("user").alias("id"),
        "features",
        "items",
        "scores",
    )
    offered = ranked.where("band > 0").select(
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
        F.lit(1).alias("kind"),
        "norm",
        F.col("item").cast("int").alias("id"),
        "features",
        F.lit(None).cast("array<int>").alias("items"),
        F.lit(None).cast("array<float>").alias("scores"),
    )
    met = wanted.unionByName(offered).repartitionById(shares, F.col("share"))
    met = met.sortWithinPartitions("share", "kind", F.desc("norm"), "id")
    further = met.mapInArrow(partial(_stream, k=k), "user int, item int, score float, place int")
    done = found.where("last = 0").select("user", F.posexplode(F.arrays_zip("items", "scores")).alias("at", "hit"))
    done = done.select("user", F.col("hit.items").alias("item"), F.col("hit.scores").alias("score"), (F.col("at") + 1).alias("place"))
    return done.unionByName(further)


def scored_pairs(probed_users: DataFrame, banded_items: DataFrame) -> int:
    """How many inner products are computed: a user's bands up to the last one needed."""
    sizes = banded_items.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    upto = sizes.select("band", F.sum("n").over(Window.orderBy("band")).alias("n"))  # one row a band
    return probed_users.join(upto, F.col("last") == F.col("band")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
