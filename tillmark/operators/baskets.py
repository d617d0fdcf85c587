"""Products bought together.

Lines are first folded to one row per basket and product, so repeated lines and very long baskets shrink to at most
the number of distinct products.  Each unordered pair is counted once and mirrored afterwards.

A basket with more than ``TILE`` products is long.  Where all pairs are the result, a long basket is cut into tiles, so
that no task meets more than two tiles' worth of it.  Where only pairs of two or more baskets count, a long basket is
not paired up at all: it is looked up for the pairs that ordinary baskets have, and only products that occur in
several long baskets are paired among those.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.operators.durable import checkpointed
from tillmark.operators.ranking import Ranks, desc, with_ranks

TILE = 2000
# Bins of baskets for every ``TILE`` items: rows of short baskets fill a bin to a quarter of what a long one has.
BINS_A_TILE = 4
# Items of short baskets whose pairs one task adds up before it sends them, and the most rows of a product whose partners
# one task adds up afterwards.
ITEMS_A_BIN, MOST_A_PRODUCT = 500_000, 250_000
# Entries of a long basket that its products meet before it is known who has to look further; any number gives the
# same result.
HEAD = 64
SALTS = 32
MEASURES = ("baskets", "line_pairs", "low_units", "high_units")


def basket_items(lines: DataFrame, basket: str, product: str, quantity: str) -> DataFrame:
    """One row per basket and product with its number of lines and its units.

    A null basket or product joins with nothing, so it is left out before the shuffle.
    """
    return (
        lines.where(F.col(basket).isNotNull() & F.col(product).isNotNull())
        .groupBy(F.col(basket).alias("basket"), F.col(product).alias("product"))
        .agg(F.count(F.lit(1)).alias("lines"), F.sum(quantity).alias("units"))
    )


def product_pairs(items: DataFrame, min_baskets: int = 1, tile: int = TILE) -> DataFrame:
    """Ordered pairs of different products that share at least ``min_baskets`` baskets.

    Columns: anchor, related, baskets (number of shared baskets), line_pairs (pairs of lines over all of them) and
    related_units (units of the related product, once for each line of the anchor).

    The items are checkpointed: both sides of the join read them, and whether there is a long basket is asked first.
    """
    short, long = _by_size(checkpointed(items), tile)
    ordinary = _meet(short, ["basket"])
    if long is None:
        pairs = _summed(ordinary)
    else:
        if min_baskets < 2:
            pairs = _summed(ordinary.unionByName(_meet_tiled(long, tile)))
        else:
            known = checkpointed(_summed(ordinary))
            several = long.groupBy("product").count().where("count > 1").select("product")
            only_long = _meet_tiled(long.join(several, "product", "left_semi"), tile).join(
                known, ["low", "high"], "left_anti"
            )
            pairs = _summed(known.unionByName(_looked_up(known, long)).unionByName(only_long))
    both_ways = pairs.where(F.col("baskets") >= min_baskets).select(
        "baskets",
        "line_pairs",
        F.explode(
            F.array(
                F.struct(F.col("low").alias("anchor"), F.col("high").alias("related"), F.col("high_units").alias("units")),
                F.struct(F.col("high").alias("anchor"), F.col("low").alias("related"), F.col("low_units").alias("units")),
            )
        ).alias("way"),
    )
    return both_ways.select(
        "way.anchor", "way.related", "baskets", "line_pairs", F.col("way.units").alias("related_units")
    )


def _by_size(items: DataFrame, tile: int) -> tuple[DataFrame, DataFrame | None]:
    """The stored items of baskets of at most ``tile`` rows, and those of longer ones with their ``_size``.

    Only the long baskets are looked up, and those are few: no item is sent anywhere to learn that its basket is short,
    and most baskets are not counted one by one: bins of baskets are, and only those of a bin that holds more rows than
    a basket may have.  There is at most one such bin for every ``tile`` rows.
    """
    sizes = _frequent(items, "basket", tile)
    if sizes is None:
        return items, None
    sizes = sizes.withColumnRenamed("_rows", "_size")
    return items.join(sizes, "basket", "left_anti"), items.join(sizes, "basket")


def _frequent(items: DataFrame, key: str, most: int) -> DataFrame | None:
    """The values of ``key`` that more than ``most`` of the stored items have, with their ``_rows``; None if there is none."""
    bins = math.ceil(items.count() * BINS_A_TILE / most)
    if not bins:
        return None
    binned = items.select(key, F.pmod(F.xxhash64(key), F.lit(bins)).alias("_bin"))
    full = checkpointed(binned.groupBy("_bin").count().where(F.col("count") > most).select("_bin"))
    if full.isEmpty():
        return None
    # Counted and joined, not windowed: a placeholder basket with a third of all lines is no window of one task.
    rows = binned.join(full, "_bin", "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    rows = checkpointed(rows.where(F.col("_rows") > most))
    return None if rows.isEmpty() else rows


def partner_lists(items: DataFrame, depths: DataFrame, tile: int = TILE, head: int = HEAD) -> DataFrame:
    """For every anchor of ``depths`` (anchor, depth) its first ``depth`` partners: anchor, related, line_pairs, place.

    The order is by line pairs, the smaller product first among equals; one shared basket is enough.  Pairs of baskets
    of at most ``tile`` products are all formed.  A longer one is a posting list of its products, most lines first:
    an anchor meets only the heads of its lists.  What stands behind all heads has at most the line pairs of the next
    entries together, so an anchor is done once its list is full of better partners; the others look further.

    The items are read several times: give stored ones.  A basket may hold a product in several rows; as line pairs are
    products of sums, the short baskets need no folding.
    """
    short, long = _by_size(items.select("basket", "product", "lines"), tile)
    known = _partners(short, items)
    if long is None:
        return _listed(known, depths).where(F.col("place") <= F.col("depth")).drop("depth")
    known = checkpointed(known)
    places = Ranks([desc("lines")], ["product"], ["basket"], row_number="at")
    long = long.groupBy("basket", "product").agg(F.sum("lines").alias("lines"))
    postings = checkpointed(with_ranks(long, places))
    inside = postings.select(F.col("product").alias("anchor")).distinct()
    parts = [_listed(known, depths.join(inside, "anchor", "left_anti")).where(F.col("place") <= F.col("depth"))]
    searching = checkpointed(depths.join(inside, "anchor"))
    while not searching.isEmpty():
        found = checkpointed(_searched(searching, known, postings, head))
        parts.append(found.where(F.col("done") & (F.col("place") <= F.col("depth"))).select("anchor", "related", "line_pairs", "place", "depth"))
        settled = found.where("done").select("anchor").distinct()
        searching = checkpointed(searching.join(settled, "anchor", "left_anti"))
        head *= 8
    return reduce(DataFrame.unionByName, parts).drop("depth")


def _partners(short: DataFrame, items: DataFrame) -> DataFrame:
    """All pairs of the short baskets, both ways, with the sum of their line pairs: anchor, related, line_pairs.

    Baskets meet in bins, where the pairs of a bin are added up, so that a pair is sent once, and to its anchor: there
    the bins are added up, and the partners can be ranked.  Where a product has too many rows for that, pairs are sent
    to be added up first, each by itself.
    """
    if _frequent(items, "product", MOST_A_PRODUCT) is None:
        bins = math.ceil(items.count() / ITEMS_A_BIN) or 1
        binned = short.where(F.col("basket").isNotNull()).withColumn("_bin", F.pmod(F.xxhash64("basket"), F.lit(bins)))
        # Dealt by the bin alone, rows lie right for every grouping that the bin is part of.  Their bytes do not tell how
        # many pairs they make, so bins are not put together; among four times as many tasks, few share one.
        whole = binned.repartition(4 * bins, "_bin").groupBy("_bin", "basket").agg(F.collect_list(F.struct("product", "lines")).alias("_all"))
        met = whole.select("_bin", "_all", F.explode("_all").alias("l")).select("_bin", "l", F.explode("_all").alias("h"))
        met = met.where(F.col("l.product") < F.col("h.product")).select("_bin", *_pair("l", "h", ("line_pairs",)))
        pairs = met.groupBy("_bin", "low", "high").agg(F.sum("line_pairs").alias("line_pairs"))
        # A window, not two hash tables: its sort serves the join with the depths too.
        same = Window.partitionBy("anchor", "related")
        sent = _both_ways(pairs).repartition("anchor").withColumn("_at", F.row_number().over(same.orderBy("line_pairs")))
        return sent.withColumn("line_pairs", F.sum("line_pairs").over(same)).where(F.col("_at") == 1).drop("_at")
    met = _meet(short, ["basket"], measures=("line_pairs",))
    return _both_ways(met.groupBy("low", "high").agg(F.sum("line_pairs").alias("line_pairs")))


def _both_ways(pairs: DataFrame) -> DataFrame:
    ways = F.array(F.struct(F.col("low").alias("a"), F.col("high").alias("b")), F.struct(F.col("high").alias("a"), F.col("low").alias("b")))
    return pairs.select(F.explode(ways).alias("w"), "line_pairs").select(
        F.col("w.a").alias("anchor"), F.col("w.b").alias("related"), "line_pairs"
    )


def _listed(pairs: DataFrame, depths: DataFrame) -> DataFrame:
    """Partners numbered; an anchor has no more of them than there are products."""
    order = Window.partitionBy("anchor").orderBy(F.desc("line_pairs"), F.asc("related"))
    return pairs.join(depths, "anchor").withColumn("place", F.row_number().over(order))


def _searched(searching: DataFrame, known: DataFrame, postings: DataFrame, head: int) -> DataFrame:
    """The anchors' partners among the first ``head`` entries of their posting lists and the pairs of ordinary baskets,
    and whether those lists are done: nothing behind the heads can be among the first ``depth``."""
    salt = lambda column: F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")
    own = searching.join(postings.select(F.col("product").alias("anchor"), "basket", F.col("lines").alias("own_lines")), "anchor")
    # All products of a long basket meet its head: salted, as such a basket may hold a third of all lines.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    heads = postings.where(F.col("at") <= head).select("basket", F.col("product").alias("related"), salts.alias("salt"))
    met = own.select("anchor", "basket", salt("anchor").alias("salt")).join(heads, ["basket", "salt"])
    mine = known.join(searching.select("anchor"), "anchor")
    pairs = met.where(F.col("anchor") != F.col("related")).select("anchor", "related").unionByName(mine.select("anchor", "related"))
    pairs = pairs.distinct()
    theirs = postings.select("basket", F.col("product").alias("related"), "lines")
    shared = pairs.join(own.select("anchor", "basket", "own_lines"), "anchor").join(theirs, ["basket", "related"])
    shared = shared.select("anchor", "related", (F.col("own_lines") * F.col("lines")).alias("line_pairs"))
    summed = shared.unionByName(mine).groupBy("anchor", "related").agg(F.sum("line_pairs").alias("line_pairs"))
    # The entries that follow the heads: their line pairs together are the most that an unseen partner has, and the
    # largest of their ids is the least that an unseen partner of so many has.
    following = postings.where(F.col("at") == head + 1).select("basket", F.col("product").alias("_next"), "lines")
    beyond = own.join(following, "basket").groupBy("anchor").agg(
        F.sum(F.col("own_lines") * F.col("lines")).alias("_most"), F.max("_next").alias("_least")
    )
    listed = _listed(summed, searching)
    better = (F.col("line_pairs") > F.col("_most")) | ((F.col("line_pairs") == F.col("_most")) & (F.col("related") < F.col("_least")))
    full = listed.where(F.col("place") == F.col("depth")).join(beyond, "anchor").where(better).select("anchor")
    ended = searching.select("anchor").join(beyond.select("anchor"), "anchor", "left_anti")
    done = full.unionByName(ended).distinct().withColumn("done", F.lit(True))
    whole = listed.join(done, "anchor", "left").withColumn("done", F.coalesce("done", F.lit(False)))
    # An anchor that is alone in all its baskets has no row, and is done.
    empty = searching.select("anchor").join(beyond.select("anchor"), "anchor", "left_anti").join(summed.select("anchor").distinct(), "anchor", "left_anti")
    none = empty.select("anchor", *[F.lit(None).cast(whole.schema[c].dataType).alias(c) for c in whole.columns[1:-1]], F.lit(True).alias("done"))
    return whole.unionByName(none)


FIRST_BAND = 16


def depth_band(depth: Column) -> Column:
    """Band of a place in a partner list: 0 for the first 16 places, then twice as many places as before in each."""
    return F.greatest(F.lit(0), F.ceil(F.log2(depth / FIRST_BAND))).cast("int")


def bands_to(depth: Column) -> Column:
    """The bands that hold all places up to ``depth``; together they hold at most about twice as many.

    A join on (anchor, band) meets only partners near the wanted depth, however long the list of a popular anchor is.
    """
    return F.sequence(F.lit(0), depth_band(depth))


def _summed(met: DataFrame) -> DataFrame:
    return met.groupBy("low", "high").agg(*[F.sum(m).alias(m) for m in MEASURES])


def _pair(low: str, high: str, measures: Sequence[str] = MEASURES) -> list[Column]:
    """One meeting of two items in a basket."""
    values = {
        "baskets": lambda: F.lit(1).cast("bigint"),
        "line_pairs": lambda: F.col(f"{low}.lines") * F.col(f"{high}.lines"),
        "low_units": lambda: F.col(f"{high}.lines") * F.col(f"{low}.units"),
        "high_units": lambda: F.col(f"{low}.lines") * F.col(f"{high}.units"),
    }
    ends = [F.col(f"{low}.product").alias("low"), F.col(f"{high}.product").alias("high")]
    return ends + [values[m]().alias(m) for m in measures]


def _meet(items: DataFrame, keys: list[str], extra: Column | None = None, measures: Sequence[str] = MEASURES) -> DataFrame:
    condition = F.col("l.product") < F.col("h.product")
    for key in keys:
        condition = condition & (F.col(f"l.{key}") == F.col(f"h.{key}"))
    if extra is not None:
        condition = condition & extra
    return items.alias("l").join(items.alias("h"), condition).select(*_pair("l", "h", measures))


def _looked_up(known: DataFrame, long: DataFrame) -> DataFrame:
    """Meetings, in long baskets, of products that are a pair already."""
    low = known.select("low", "high").alias("k").join(long.alias("l"), F.col("k.low") == F.col("l.product"))
    same = [F.col("h.basket") == F.col("l.basket"), F.col("h.product") == F.col("k.high")]
    return low.join(long.alias("h"), same).select(*_pair("l", "h"))


def _meet_tiled(items: DataFrame, tile: int) -> DataFrame:
    """Products of one block share many tiles; they count only in the tile of that block with itself."""
    once = (F.col("l._row") == F.col("l._col")) | (F.col("l._block") != F.col("h._block"))
    return _meet(_tiles(items, tile), ["basket", "_row", "_col"], once)


def _tiles(items: DataFrame, tile: int) -> DataFrame:
    """Copy each item to the tiles its block takes part in: with b blocks, b copies instead of b*b."""
    blocks = F.ceil(F.col("_size") / tile)
    cut = items.withColumn("_blocks", blocks).withColumn(
        "_block", F.pmod(F.xxhash64("product"), F.col("_blocks"))
    )
    others = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1),
        lambda other: F.struct(
            F.least(F.col("_block"), other).alias("row"), F.greatest(F.col("_block"), other).alias("col")
        ),
    )
    return (
        cut.withColumn("_tile", F.explode(others))
        .withColumns({"_row": F.col("_tile.row"), "_col": F.col("_tile.col")})
        .drop("_tile", "_blocks")
    )
