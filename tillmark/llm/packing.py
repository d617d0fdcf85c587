"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the longest permitted sequence are cut into pieces that fill it; every piece is placed whole.
Pieces are packed longest first: each goes to the open bin that it fills best.  If none has room, a bin is opened whose
length costs least for the tokens it can still be filled with, given what is left to place.  At the end every bin is
downsized to the shortest permitted length that holds its contents.

Only lengths travel, never texts: rows of some tens of bytes are dealt evenly to tasks of at most ``SHARD`` pieces, so
no task grows with the input, and each task packs its share on its own.  A bin holds pieces of one shard only, which
costs at most a few open bins for every ``SHARD`` pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tillmark.llm import words
from tillmark.llm.shared import stored

CAPACITIES = (512, 1024, 2048, 4096)
SHARD = 100_000
# What a sequence costs, in tokens: one for each token, attention that grows with the square of the length, and a
# constant for being a sequence at all.  The length that costs least per token lies between the extremes.
ATTENTION = 32_768
OVERHEAD = 32
# Printable ASCII that is neither a letter, a digit nor a space.
_byte = np.arange(256)
SIGNS = (_byte > 0x20) & (_byte < 0x7F) & ~words.LETTERS


def token_counts(column: pa.Array) -> np.ndarray:
    """Words and single signs of every text, and one token for its end; a null or empty text has none."""
    counts = []
    for data, offsets in words.buffers(column):
        inside = words.LETTERS[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        firsts = offsets[:-1][np.diff(offsets) > 0]
        opens[firsts] = inside[firsts]
        opens |= SIGNS[data]
        upto = np.zeros(len(data) + 1, np.int64)
        np.cumsum(opens, out=upto[1:])
        counts.append(np.diff(upto[offsets]))
    found = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return np.where(found > 0, found + 1, 0)


def word_tokens(text: Column) -> Column:
    """``token_counts`` of a text column: one array pass over the bytes of each batch, whatever the length of a text."""

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array(token_counts(texts))

    return counted(text)


def default_cost(capacity: int) -> float:
    return capacity + capacity * capacity / ATTENTION + OVERHEAD


def opened(piece: int, left: int, capacities: tuple[int, ...], cost: Callable[[int], float] = default_cost) -> int:
    """The permitted length that costs least per token for a piece, if ``left`` further tokens could fill it up."""
    fitting = [c for c in capacities if c >= piece]
    return min(fitting, key=lambda c: (cost(c) / min(c, piece + left), c))


class OpenBins:
    """Open bins by free room; the one with the least room that is enough is found by a bit mask of rooms in use."""

    def __init__(self) -> None:
        self.mask = 0
        self.by_room: dict[int, list[int]] = {}

    def add(self, room: int, number: int) -> None:
        heapq.heappush(self.by_room.setdefault(room, []), number)
        self.mask |= 1 << room

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, bin) of the fullest bin with ``least`` room, of equals the first opened one; it is taken out."""
        above = self.mask >> least
        if not above:
            return None
        room = least + (above & -above).bit_length() - 1
        bins = self.by_room[room]
        number = heapq.heappop(bins)
        if not bins:
            self.mask ^= 1 << room
        return room, number


def pack(sizes: np.ndarray, capacities: tuple[int, ...], cost: Callable[[int], float] = default_cost):
    """Bin of each piece, its offset there, and the downsized capacity of each bin.

    ``sizes`` are at most the largest capacity; pieces of size 0 share a bin as well, at no cost in room.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    used: list[int] = []
    capacity: list[int] = []
    left = int(sizes.sum())
    free = OpenBins()
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        left -= size
        found = free.take(size)
        if found is None:
            number = len(used)
            used.append(0)
            capacity.append(opened(size, left, capacities, cost))
            room = capacity[-1]
        else:
            room, number = found
        bins[i], offsets[i] = number, used[number]
        used[number] += size
        free.add(room - size, number)
    held = [next(c for c in capacities if c >= u) for u in used]
    return bins, offsets, np.array(held, np.int64)


def pieces(documents: DataFrame, id_column: str, tokens: Column, longest: int) -> DataFrame:
    """doc, piece, first_token, n_tokens: documents cut to pieces of at most ``longest`` tokens; an empty one is one."""
    rows = documents.select(F.col(id_column).alias("doc"), F.coalesce(tokens, F.lit(0)).cast("long").alias("total"))
    last = F.greatest(F.ceil(F.col("total") / longest).cast("int"), F.lit(1)) - 1
    rows = rows.select("doc", "total", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * longest
    return rows.select(
        "doc", "piece", start.alias("first_token"), F.least(F.col("total") - start, F.lit(longest)).alias("n_tokens")
    )


def packed(
    documents: DataFrame,
    tokens: Column,
    *,
    id_column: str = "doc_id",
    capacities: tuple[int, ...] = CAPACITIES,
    cost: Callable[[int], float] = default_cost,
) -> DataFrame:
    """Where every piece of every row of ``documents`` goes: id, piece, first_token, n_tokens, bin_id, bin_offset,
    bin_capacity.

    ``tokens`` gives a row's length; null counts as 0, and a row of no tokens is placed as an empty piece.  Repeated
    rows and ids are placed each on their own.  An empty table gives none.
    """
    capacities = tuple(sorted(set(capacities)))
    if not capacities or capacities[0] < 1:
        raise ValueError("capacities must be positive")
    rows = stored(pieces(documents, id_column, tokens, capacities[-1]))
    shards = -(-rows.count() // SHARD) or 1
    # Dealt in turn, so that neither a key nor a length decides where a row goes.
    dealt = rows.repartition(shards).withColumn("shard", F.spark_partition_id())
    schema = StructType(
        [
            StructField(id_column, rows.schema["doc"].dataType),
            StructField("piece", IntegerType()),
            StructField("first_token", LongType()),
            StructField("n_tokens", LongType()),
            StructField("bin_id", StringType()),
            StructField("bin_offset", LongType()),
            StructField("bin_capacity", LongType()),
        ]
    )

    def place(batches):
        held = list(batches)
        if not held:
            return
        whole = pa.Table.from_batches(held).sort_by([("doc", "ascending"), ("piece", "ascending"), ("n_tokens", "ascending")])
        sizes = np.asarray(whole["n_tokens"])
        bins, offsets, capacity = pack(sizes, capacities, cost)
        shard = whole["shard"][0].as_py()
        names = pa.array([f"{shard}-{b}" for b in bins])
        columns = [whole[c].combine_chunks() for c in ("doc", "piece", "first_token", "n_tokens")]
        columns += [names, pa.array(offsets), pa.array(capacity[bins])]
        yield from pa.Table.from_arrays(columns, names=schema.names).to_batches()

    return dealt.mapInArrow(place, schema)
