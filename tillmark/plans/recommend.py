"""Product recommendations of the model job: matrix factorisation, and co-purchase counts as the fallback.

``sales`` is the repaired sale-line table (raw column names), ``products`` has product_id, product_name, category_id
and category_name, ``customers`` has customer_id and customer_name.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tillmark.operators.baskets import bands_to, depth_band, partner_lists
from tillmark.operators.durable import checkpointed, iteration_checkpoints
from tillmark.operators.inner_products import largest_products
from tillmark.operators.ranking import Ranks, asc, with_ranks

log = logging.getLogger(__name__)

INT_MAX = 2**31 - 1
ID_COLUMNS = ("customer_id", "product_id")
RATINGS_PER_BLOCK = 1_000_000

# Partners that each anchor offers before it is known which anchors have to offer more; any number gives the same
# result.
PROBE_DEPTH = 3
# Purchases, with what they are offered first, that one task judges.
PURCHASES_A_TASK = 250_000


@dataclass(frozen=True)
class ModelSettings:
    """Defaults of the model job."""

    top_n: int = 10
    rank: int = 20
    iterations: int = 10
    regularisation: float = 0.1
    min_users: int = 50
    min_items: int = 50
    min_interactions: int = 500
    seed: int = 42


DEFAULTS = ModelSettings()


def purchases(sales: DataFrame) -> DataFrame:
    """Distinct (customer, product)."""
    return sales.select(F.col("CustomerID").alias("customer_id"), F.col("ProductID").alias("product_id")).distinct()


def _bought(sales: DataFrame) -> DataFrame:
    """(customer_id, product_id, basket, lines, first): lines folded; ``first`` marks one row of a customer's product.

    Customers' products are marked, not folded from the lines once more: lines that come from a join with the products
    are where they have to be for both steps, others are sent to their customer and product once.
    """
    lines = sales.select(
        F.col("CustomerID").alias("customer_id"),
        F.col("ProductID").alias("product_id"),
        F.col("TransactionNumber").alias("basket"),
    )
    place = F.row_number().over(Window.partitionBy("product_id", "customer_id").orderBy("basket"))
    return (
        lines.withColumn("first", place == 1)
        .groupBy("customer_id", "product_id", "basket")
        .agg(F.count(F.lit(1)).alias("lines"), F.max("first").alias("first"))
    )


def als_ratings(sales: DataFrame) -> DataFrame:
    """Log-damped spend per customer and product; lines without a positive total count by quantity."""
    worth = F.when(F.col("TotalPrice") > 0, F.col("TotalPrice")).otherwise(F.coalesce("Quantity", F.lit(0)))
    return (
        sales.groupBy(F.col("CustomerID").alias("customer_id"), F.col("ProductID").alias("product_id"))
        .agg(F.sum(worth.cast("decimal(24,4)")).alias("raw_rating"), F.count(F.lit(1)).alias("lines"))
        .withColumn("rating", F.ln(1 + F.col("raw_rating").cast("double")))
    )


def _ranked(candidates: DataFrame, top_n: int) -> DataFrame:
    best = Window.partitionBy("customer_id").orderBy(F.desc("score"), F.asc("product_id"))
    return candidates.withColumn("recommendation_rank", F.row_number().over(best)).where(
        F.col("recommendation_rank") <= top_n
    )


def _labelled(ranked: DataFrame, products: DataFrame, customers: DataFrame, model_type: str) -> DataFrame:
    return (
        ranked.join(products.select("product_id", "product_name", "category_id", "category_name"), "product_id", "left")
        .join(customers.select("customer_id", "customer_name"), "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            "product_id",
            "product_name",
            "category_id",
            "category_name",
            "score",
            "recommendation_rank",
            F.lit(model_type).alias("model_type"),
        )
    )


def _profile(ratings: DataFrame) -> Row:
    """Number of ratings and the largest ids, in one job."""
    largest = [F.coalesce(F.max(F.abs(c)), F.lit(0)).alias(c) for c in ID_COLUMNS]
    return ratings.agg(F.count(F.lit(1)).alias("ratings"), *largest).first()


def _int_codes(ratings: DataFrame, column: str) -> DataFrame:
    """(id, 32-bit code) for ids that do not fit the factorisation's 32-bit keys; more ids than codes are an error."""
    if ratings.agg(F.approx_count_distinct(column)).first()[0] > 0.9 * INT_MAX:
        raise ValueError(f"{column} has more values than the factorisation has keys")
    numbered = with_ranks(ratings.select(column).distinct(), Ranks([asc(column)], row_number="_code"))
    return numbered.select(column, F.col("_code").cast("int").alias(f"_{column}"))


def als_recommendations(
    ratings: DataFrame, products: DataFrame, customers: DataFrame, settings: ModelSettings = DEFAULTS
) -> DataFrame:
    """Top products per customer by matrix factorisation of ``als_ratings``.

    The list is cut to ``top_n`` before owned products are removed, so fewer may remain.  The fit reads the ratings
    again and again: give it stored or checkpointed ones.
    """
    iteration_checkpoints(ratings.sparkSession)
    profile = _profile(ratings)
    codes = {c: _int_codes(ratings, c) for c in ID_COLUMNS if profile[c] > INT_MAX}
    coded = ratings
    for column in ID_COLUMNS:
        if column in codes:
            coded = coded.join(codes[column], column)
        else:
            coded = coded.withColumn(f"_{column}", F.col(column).cast("int"))
    blocks = max(8, math.ceil(profile.ratings / RATINGS_PER_BLOCK))
    model = ALS(
        userCol="_customer_id",
        itemCol="_product_id",
        ratingCol="rating",
        rank=settings.rank,
        maxIter=settings.iterations,
        regParam=settings.regularisation,
        nonnegative=True,
        coldStartStrategy="drop",
        seed=settings.seed,
        # A block of either side holds all ratings of its ids, so both counts follow the ratings.
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        # Cuts the lineage of the factors, so that a lost executor does not cost all iterations, and frees the shuffle
        # files of the iteration before: each sends all factors to the blocks that need them, which is the most that the
        # fit has on disk.
        checkpointInterval=1,
    ).fit(coded)
    best = largest_products(model.userFactors, model.itemFactors, settings.top_n)
    flat = best.select(
        F.col("user").alias("_customer_id"), F.col("item").alias("_product_id"), F.col("score").cast("double").alias("score")
    )
    for column in ID_COLUMNS:
        if column in codes:
            flat = flat.join(codes[column], f"_{column}")
        else:
            flat = flat.withColumn(column, F.col(f"_{column}").cast("bigint"))
    fresh = flat.select("customer_id", "product_id", "score").join(
        ratings.select("customer_id", "product_id"), ["customer_id", "product_id"], "left_anti"
    )
    # Scoring is the dearest step: it runs once, whatever reads the result.
    return _labelled(checkpointed(_ranked(fresh, settings.top_n)), products, customers, "ALS")


def heuristic_recommendations(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    settings: ModelSettings = DEFAULTS,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Top products per customer by how often they were bought together with something the customer owns.

    A candidate is a pair (owned anchor, product not owned), so one product may hold several ranks.  ``pairs`` may be
    a stored result of ``product_pairs``.

    Joining every owned product with all of its partners would produce far more candidates than can be ranked among
    the first ``top_n``.  Instead each anchor first offers its few best partners.  The ``top_n``-th product that is
    left for a customer after removing owned ones is a floor; an anchor is asked for more only where the last partner
    it offered is still better than that floor, and then only for partners above it.  This drops no candidate that
    could be ranked.

    Folded sale lines, purchases, partner lists, first candidates and the anchors that are asked for more are read several
    times, or decide how others are read, so each is checkpointed.
    """
    n = settings.top_n
    if pairs is None:
        # Read for purchases and baskets: joined with orders, prices and products once.
        bought = checkpointed(_bought(sales))
        mine = bought.where("first").select(*ID_COLUMNS)
    else:
        mine = purchases(sales)
    # Of one anchor no more than the first n + owned partners can count: that many of them are excluded at most.
    deepest = F.count(F.lit(1)).over(Window.partitionBy("customer_id")) + n
    owned = checkpointed(mine.withColumn("_deepest", deepest))
    if pairs is None:
        depths = owned.groupBy(F.col("product_id").alias("anchor")).agg(F.max("_deepest").alias("depth"))
        items = bought.select("basket", F.col("product_id").alias("product"), "lines").na.drop(subset=["basket", "product"])
        listed = partner_lists(items, depths)
    else:
        nearest = Window.partitionBy("anchor").orderBy(F.desc("line_pairs"), F.asc("related"))
        listed = pairs.withColumn("place", F.row_number().over(nearest))
    partners = checkpointed(
        listed.select(
            "anchor",
            F.col("related").alias("product_id"),
            F.col("line_pairs").cast("double").alias("score"),
            F.col("place").alias("_depth"),
        ).withColumn("_band", depth_band(F.col("_depth")))
    )

    def above_floor(score: str, product: str):
        higher = F.col(score) > F.col("_floor.score")
        tied = (F.col(score) == F.col("_floor.score")) & (F.col(product) < F.col("_floor.product_id"))
        return F.col("_floor").isNull() | higher | tied

    # What the anchors offer first and what their customers own are sent to the customer together, once, in one row for
    # each purchase: which offers are owned, the first n of the others, the floor and the anchors above it all follow
    # there.
    probes = partners.where(F.col("_depth") <= PROBE_DEPTH).groupBy("anchor")
    probes = probes.agg(F.array_sort(F.collect_list(F.struct("_depth", "product_id", "score"))).alias("_offers"))
    probes = probes.select("anchor", F.col("_offers.product_id").alias("_products"), F.col("_offers.score").alias("_scores"))
    anchors = owned.select("customer_id", F.col("product_id").alias("anchor"))
    # Shuffled at every size: millions of purchases make a small file, and no small table once they are broadcast.
    met = anchors.join(probes.hint("merge"), "anchor", "left")
    # The packed rows grow fourfold in the task that judges them, so their bytes do not tell how many it can take.
    met = met.repartition(math.ceil(owned.count() / PURCHASES_A_TASK) or 1, "customer_id")
    # Place 0 is the purchase itself.
    place, offered = F.col("_place"), F.coalesce(F.array_size("_products"), F.lit(0))
    offers = met.withColumn("_place", F.explode(F.sequence(F.lit(0), offered))).select(
        "customer_id",
        F.when(place == 0, F.col("anchor")).otherwise(F.get("_products", place - 1)).alias("product_id"),
        F.get("_scores", place - 1).alias("score"),
        F.when(place == PROBE_DEPTH, F.col("anchor")).alias("_last_of"),
        (place == 0).cast("int").alias("_owns"),
    )
    own = Window.partitionBy("customer_id")
    best = own.orderBy(F.asc("_mine"), F.desc("score"), F.asc("product_id"))
    floor = F.when((F.col("_mine") == 0) & (F.col("_number") == n), F.struct("score", "product_id"))
    offers = (
        offers.withColumn("_mine", F.max("_owns").over(Window.partitionBy("customer_id", "product_id")))
        .withColumn("_deepest", F.sum("_owns").over(own) + n)
        .where(F.col("_owns") == 0)
        .withColumn("_number", F.row_number().over(best))
        .withColumn("_floor", F.max(floor).over(own))
        .withColumn("_first", (F.col("_mine") == 0) & (F.col("_number") <= n))
        .withColumn("_open", F.col("_last_of").isNotNull() & above_floor("score", "product_id"))
    )
    judged = checkpointed(offers.where(F.col("_first") | F.col("_open")).drop("_owns", "_mine", "_number"))
    first = judged.where("_first").select("customer_id", "product_id", "score")

    # Stored, as few anchors are open as a rule: Spark then knows how few, and sends neither all partners nor all
    # purchases to meet them.
    reaching = checkpointed(
        judged.where("_open").select(
            "customer_id", F.col("_last_of").alias("anchor"), "_deepest", "_floor", F.explode(bands_to(F.col("_deepest"))).alias("_band")
        )
    )
    # Their ids alone are fewer and narrower still: partners of other anchors are left out before any is sent.
    asked = checkpointed(reaching.select("anchor").distinct())
    further = partners.where(F.col("_depth") > PROBE_DEPTH).join(asked, "anchor", "left_semi")
    within = F.col("_depth") <= F.col("_deepest")
    deeper = reaching.join(further, ["anchor", "_band"]).where(within).where(above_floor("score", "product_id"))
    deeper = checkpointed(deeper.select("customer_id", "product_id", "score"))
    same = ["customer_id", "product_id"]
    mine = owned.select(*same).join(deeper.select(*same), same, "left_semi")
    both = first.unionByName(deeper.join(mine, same, "left_anti"))
    return _labelled(_ranked(both, n), products, customers, "HEURISTIC_FALLBACK")


def als_checks(recommendations: DataFrame, ratings: DataFrame, products: DataFrame, top_n: int = DEFAULTS.top_n) -> DataFrame:
    """One row that counts what a factorisation result must not hold, and whether it holds anything."""
    known = products.select("product_id").distinct()
    owned = recommendations.join(ratings.select("customer_id", "product_id"), ["customer_id", "product_id"], "left_semi")
    by_rank = Window.partitionBy("customer_id").orderBy("recommendation_rank")
    step = F.col("recommendation_rank") - F.lag("recommendation_rank", 1, 0).over(by_rank)
    rise = F.col("score") > F.lag("score").over(by_rank)
    counts = recommendations.select("customer_id", "recommendation_rank", "model_type", step.alias("step"), rise.alias("rise")).agg(
        (F.count(F.lit(1)) > 0).alias("has_rows"),
        F.count_if(F.col("recommendation_rank") > top_n).alias("ranks_beyond"),
        F.count_if(F.col("step") != 1).alias("rank_gaps"),
        F.count_if(F.col("rise")).alias("scores_out_of_order"),
        F.count_if(F.col("model_type") != "ALS").alias("other_models"),
    )
    strangers = recommendations.join(known, "product_id", "left_anti")
    return counts.withColumns(
        {
            "owned_recommended": owned.agg(F.count(F.lit(1))).scalar(),
            "unknown_products": strangers.agg(F.count(F.lit(1))).scalar(),
        }
    )


def model_gate(ratings: DataFrame) -> DataFrame:
    """One row: users, items and interactions (sale lines) behind the ratings."""
    return ratings.agg(
        F.count_distinct("customer_id").alias("users"),
        F.count_distinct("product_id").alias("items"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("interactions"),
    )


def recommendations(
    sales: DataFrame, products: DataFrame, customers: DataFrame, settings: ModelSettings = DEFAULTS
) -> DataFrame:
    """Factorisation where there is enough data and it works, co-purchase counts otherwise.

    The gate reads one aggregate row of the ratings, which are folded from the sales once for gate and fit.  Both run
    while the result is being defined; a failure while the result is written later is not covered by the fallback.
    """
    ratings = checkpointed(als_ratings(sales))
    profile = model_gate(ratings).first()
    enough = (
        profile.users >= settings.min_users
        and profile.items >= settings.min_items
        and profile.interactions >= settings.min_interactions
    )
    if enough:
        try:
            result = als_recommendations(ratings, products, customers, settings)
            if not result.isEmpty():
                return result
            log.warning("factorisation left no recommendation; using co-purchase counts")
        except Exception:
            log.warning("factorisation failed; using co-purchase counts", exc_info=True)
    else:
        log.info("too little data for factorisation (%s); using co-purchase counts", profile)
    return heuristic_recommendations(sales, products, customers, settings)
