"""Ranks over a whole table, or over groups that may be as large as one.

A window without partition columns, or with few large partitions, sorts each of them in a single task.  Here rows are
range-partitioned on the complete order (a unique tie-break keeps equal keys from piling up in one task), each task
numbers its sorted run in one pass, and a summary of one row per task and group turns local positions into global ones.

The input is stored once.  Only narrow rows are sorted: a row's number and the columns that decide an order.  They carry
the ranks they have from one order to the next, so several orders need no join between them, and the full rows are
shuffled at most once, when they meet all their ranks.  There is one way for every size.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillmark.operators.durable import checkpointed

PLACES = ("_number", "_local")


def asc(name: str) -> tuple[str, bool]:
    return name, True


def desc(name: str) -> tuple[str, bool]:
    return name, False


@dataclass(frozen=True)
class Ranks:
    """What to add for one order.

    ``rank`` follows ``order_by`` alone, so equal keys share a rank.  ``row_number`` and ``ntiles`` (column -> number
    of tiles) follow ``order_by`` and then ``tie_break`` ascending, which together must be unique, so that a rerun
    gives the same numbers.  Nulls are smallest.
    """

    order_by: Sequence[tuple[str, bool]]
    tie_break: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    rank: str | None = None
    row_number: str | None = None
    ntiles: Mapping[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [c for c in (self.row_number, *self.ntiles, self.rank) if c]

    @property
    def ties(self) -> Sequence[str]:
        """What follows ``order_by``: where only the rank is wanted, any unique column does, and the row's number is short."""
        return self.tie_break if self.row_number or self.ntiles else ("_row",)

    @property
    def key_order(self) -> list[Column]:
        return _ordered(self.order_by)

    @property
    def complete_order(self) -> list[Column]:
        return self.key_order + _ordered([asc(c) for c in self.tie_break])

    @property
    def whole_order(self) -> list[Column]:
        return _ordered([asc(c) for c in self.partition_by]) + self.key_order + _ordered([asc(c) for c in self.ties])


def _ordered(columns: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in columns]


def ntile_of(row_number: Column, total: Column, tiles: int) -> Column:
    """Tile of a row from its number: the first ``total % tiles`` tiles hold one row more than the others."""
    size = F.floor(total / tiles)
    larger = total % tiles
    in_larger = larger * (size + 1)
    # size is 0 when there are fewer rows than tiles; every row then lies in a larger tile
    rest = larger + F.ceil((row_number - in_larger) / F.greatest(size, F.lit(1)))
    return F.when(row_number <= in_larger, F.ceil(row_number / (size + 1))).otherwise(rest).cast("int")


def with_ranks(df: DataFrame, *wanted: Ranks) -> DataFrame:
    """``df`` with the columns of every entry of ``wanted``.  Runs jobs: the rows are stored first, named by a number."""
    whole = checkpointed(df.withColumn("_row", F.monotonically_increasing_id()))
    narrow, added = whole.select("_row", *_used(wanted)), []
    for place, ranks in enumerate(wanted):
        narrow = _ranked(narrow, ranks)
        added += ranks.columns
        # What no later order asks for is left behind.
        narrow = narrow.select("_row", *_used(wanted[place + 1 :]), *added)
    return whole.join(narrow.select("_row", *added), "_row").select(*df.columns, *added)


def _used(wanted: Sequence[Ranks]) -> list[str]:
    return sorted({c for r in wanted for c in (*r.partition_by, *r.ties, *[name for name, _ in r.order_by])} - {"_row"})


def _same(columns: Sequence[str]) -> Column:
    """A value that is equal where all columns are; a null is told from every other value."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c).isNull(), F.col(c))]) if columns else F.lit(0).cast("long")


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position within the group and first position of the key, counted from 1, over one sorted run.

    The columns of the marks come last; what stands before them is passed on.
    """
    seen, group, key, group_start, key_start = 0, None, None, 0, 0
    for batch in batches:
        groups, keys = np.asarray(batch.column("_group")), np.asarray(batch.column("_key"))
        if not len(groups):
            continue
        opens = np.ones(len(groups), bool)
        opens[1:] = groups[1:] != groups[:-1]
        opens[0] = group is None or groups[0] != group
        fresh = opens.copy()
        fresh[1:] |= keys[1:] != keys[:-1]
        fresh[0] |= key is None or keys[0] != key
        at = np.arange(seen, seen + len(groups))
        starts = np.maximum.accumulate(np.where(opens, at, group_start))
        firsts = np.maximum.accumulate(np.where(fresh, at, key_start))
        arrays = [*batch.columns, pa.array(at - starts + 1), pa.array(firsts - starts + 1)]
        yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *PLACES])
        seen += len(groups)
        group, key, group_start, key_start = groups[-1], keys[-1], int(starts[-1]), int(firsts[-1])


def numbered(narrow: DataFrame, ranks: Ranks) -> DataFrame:
    """``narrow`` with task, group and key, and number and first number of the key within the task's run of the group."""
    tasks = max(2, int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ranks.whole_order
    run = narrow.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    marked = run.select(
        *narrow.columns,
        F.spark_partition_id().alias("_task"),
        _same(ranks.partition_by).alias("_group"),
        _same([c for c, _ in ranks.order_by]).alias("_key"),
    )
    return marked.mapInArrow(_number, StructType(marked.schema.fields + [StructField(c, LongType()) for c in PLACES]))


def _ranked(narrow: DataFrame, ranks: Ranks) -> DataFrame:
    """``narrow`` with the columns of ``ranks``."""
    # The task numbers are read twice below and must not be drawn twice: the range bounds come from a sample.
    placed = checkpointed(numbered(narrow, ranks))
    runs = placed.groupBy("_task", "_group").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min_by("_key", "_number").alias("_first_key"),
        F.max_by("_key", "_number").alias("_last_key"),
        F.max("_local").alias("_last_local"),
    )
    # Rows of a run that share its last key; summed over the runs that end with that key they tell how far the ties of
    # the next run's first key reach back.
    runs = runs.withColumn("_tied", F.col("_rows") - F.col("_last_local") + 1)
    in_group = Window.partitionBy("_group").orderBy("_task")
    same_end = Window.partitionBy("_group", "_last_key").orderBy("_task").rowsBetween(Window.unboundedPreceding, 0)
    runs = (
        runs.withColumn("_tied_so_far", F.sum("_tied").over(same_end))
        .withColumn("_before", F.sum("_rows").over(in_group) - F.col("_rows"))
        .withColumn("_total", F.sum("_rows").over(Window.partitionBy("_group")))
        .withColumn("_previous_key", F.lag("_last_key").over(in_group))
        .withColumn("_previous_tied", F.lag("_tied_so_far").over(in_group))
        .withColumn(
            "_carry",
            F.when(F.col("_first_key") == F.col("_previous_key"), F.col("_previous_tied")).otherwise(F.lit(0)),
        )
        .select("_task", "_group", "_before", "_total", "_carry")
    )
    if not ranks.partition_by:
        runs = F.broadcast(runs)  # one row per task
    number = F.col("_before") + F.col("_number")
    values: dict[str, Column] = {}
    if ranks.row_number:
        values[ranks.row_number] = number
    for name, tiles in ranks.ntiles.items():
        values[name] = ntile_of(number, F.col("_total"), tiles)
    if ranks.rank:
        carry = F.when(F.col("_local") == 1, F.col("_carry")).otherwise(F.lit(0))
        values[ranks.rank] = (F.col("_before") + F.col("_local") - carry).cast("bigint")
    lifted = placed.join(runs, ["_task", "_group"])
    return lifted.select(*narrow.columns, *[values[name].alias(name) for name in ranks.columns])
