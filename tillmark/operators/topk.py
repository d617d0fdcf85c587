"""The first ranks of an order, without numbering the whole table.

A rank is decided by the keys before it.  Each task keeps the best ``k`` different keys of every group with the number
of its rows that have them; what the tasks kept is added up, and the keys whose rank is within ``k`` are looked up in
the table.  A key with any number of rows is one row here, so ties cost nothing, and no row is sorted or shuffled.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillmark.operators.durable import checkpointed
from tillmark.operators.ranking import Ranks, ntile_of


def _sorted(table: pa.Table, groups: list[str], order: list[tuple[str, bool]]) -> pa.Table:
    """By group and order; nulls are smallest."""
    keys = [(name, "ascending") for name in groups]
    for place, (name, up) in enumerate(order):
        table = table.append_column(f"_null{place}", pc.cast(pc.is_null(table[name]), pa.int8()))
        keys += [(f"_null{place}", "descending" if up else "ascending"), (name, "ascending" if up else "descending")]
    return table.sort_by(keys).drop_columns([f"_null{place}" for place in range(len(order))])


def _opens(table: pa.Table, groups: list[str]) -> np.ndarray:
    """Where a group begins in a table sorted by groups."""
    opens = np.zeros(len(table), bool)
    opens[:1] = True
    for name in groups:
        codes = np.asarray(pc.fill_null(table[name].combine_chunks().dictionary_encode().indices, -1))
        opens[1:] |= codes[1:] != codes[:-1]
    return opens


def _best(batches: Iterator[pa.RecordBatch], groups: list[str], order: list[tuple[str, bool]], k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` different keys of every group of a task, and their rows."""
    names = [*groups, *[name for name, _ in order]]
    kept = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]).append_column("_n", pa.array(np.ones(batch.num_rows, np.int64)))
        rows = rows if kept is None else pa.concat_tables([kept, rows])
        rows = rows.group_by(names, use_threads=False).aggregate([("_n", "sum")]).rename_columns({"_n_sum": "_n"})
        rows = _sorted(rows.select([*names, "_n"]), groups, order)
        at = np.arange(len(rows))
        place = at - np.maximum.accumulate(np.where(_opens(rows, groups), at, 0)) if len(rows) else at
        kept = rows.filter(pa.array(place < k))
    if kept is not None:
        yield from kept.combine_chunks().to_batches()


def first_ranks(df: DataFrame, ranks: Ranks, k: int) -> DataFrame:
    """The rows of ``df`` whose rank, with ties, is at most ``k``, and that rank.

    ``df`` is stored first: give it the columns that are wanted, no more.
    """
    if not ranks.rank or ranks.row_number or ranks.ntiles:
        raise ValueError("only a rank can be found by its key")
    whole = checkpointed(df)
    groups, order = list(ranks.partition_by), list(ranks.order_by)
    names = [*groups, *[name for name, _ in order]]
    narrow = whole.select(names)
    schema = StructType(narrow.schema.fields + [StructField("_n", LongType())])
    best = narrow.mapInArrow(partial(_best, groups=groups, order=order, k=k), schema)
    counted = best.groupBy(names).agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy(groups).orderBy(ranks.key_order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("_rank", F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).where(F.col("_rank") <= k)
    keys = ranked.select(*[F.col(c).alias(f"_key_{c}") for c in names], F.col("_rank").alias(ranks.rank))
    same = reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in names])
    return whole.join(keys, same).select(*df.columns, ranks.rank)


def first_rows(df: DataFrame, ranks: Ranks, k: int) -> DataFrame:
    """The first ``k`` rows of an order over the whole table, with what ``ranks`` asks for, as if all were ranked.

    All that decides the rank of these rows is among them; their tile needs the number of rows besides.
    """
    if ranks.partition_by:
        raise ValueError("an order over the whole table is needed")
    whole = checkpointed(df)
    first = whole.orderBy(*ranks.complete_order).limit(k)
    number = F.row_number().over(Window.orderBy(*ranks.complete_order)).cast("long")  # of k rows
    total = whole.agg(F.count(F.lit(1))).scalar()
    first = first.withColumns({"_number": number, "_total": total})
    values = {}
    if ranks.row_number:
        values[ranks.row_number] = F.col("_number")
    for name, tiles in ranks.ntiles.items():
        values[name] = ntile_of(F.col("_number"), F.col("_total"), tiles)
    if ranks.rank:
        values[ranks.rank] = F.rank().over(Window.orderBy(*ranks.key_order)).cast("long")
    return first.select(*df.columns, *[values[name].alias(name) for name in ranks.columns])
