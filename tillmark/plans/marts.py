"""Business-facing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions import labels
from tillmark.functions.keys import surrogate_key
from tillmark.functions.money import exact_avg, per_unit, percent
from tillmark.operators.baskets import bands_to, basket_items, depth_band, product_pairs
from tillmark.operators.ranking import Ranks, asc, desc, with_ranks
from tillmark.operators.topk import first_ranks, first_rows
from tillmark.plans.facts import only, sale_count

# Weights of the recommendation score, smallest support and list lengths.
WEIGHT_FREQUENCY = 0.45
WEIGHT_SUPPORT = 0.35
WEIGHT_SPEND = 0.20
MIN_SUPPORT = 2
TOP_ANCHORS = 10
TOP_RECOMMENDATIONS = 10


def customer_spend(sales: DataFrame) -> DataFrame:
    """What customers spent: the part of their lifetime value that their own lines decide."""
    return sales.groupBy("customer_id").agg(
        sale_count().alias("total_orders"),
        F.count_distinct(F.col("sales_date").cast("date")).alias("days_active"),
        F.sum("total_price").alias("total_spent"),
        exact_avg("total_price").alias("avg_order_value"),
        F.max("sales_date").alias("last_purchase_date"),
        F.min("sales_date").alias("first_purchase_date"),
    )


def customer_lifetime_value(sales: DataFrame, customers: DataFrame, first: int | None = None) -> DataFrame:
    """Value and global spend rank per customer; with ``first``, of so many customers who spent most."""
    return ranked_lifetime_value(customer_spend(sales), customers, first)


def updated_lifetime_value(old: DataFrame, sales: DataFrame, customers: DataFrame, touched: DataFrame) -> DataFrame:
    """The same from the stored table: only lines of touched customers are read, then all customers are ranked.

    A customer whose name occurs twice has two stored rows, and meets both names again.
    """
    fresh = customer_spend(only(sales, touched, "customer_id"))
    kept = only(old, touched, "customer_id", "left_anti").select(fresh.columns).dropDuplicates(["customer_id"])
    return ranked_lifetime_value(kept.unionByName(fresh), customers)


def ranked_lifetime_value(spent: DataFrame, customers: DataFrame, first: int | None = None) -> DataFrame:
    """``estimated_clv`` is spend per order times orders, that is: the spend."""
    by_spend = Ranks(
        [desc("total_spent")], ["customer_id"], rank="customer_spend_rank", ntiles={"value_quintile": 5}
    )
    ranked = with_ranks(spent, by_spend) if first is None else first_rows(spent, by_spend, first)
    tenure = F.datediff("last_purchase_date", "first_purchase_date")
    named = ranked.join(customers.select("customer_id", "full_name", "first_name", "last_name"), "customer_id", "left")
    return named.select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        "first_name",
        "last_name",
        "total_orders",
        "days_active",
        "total_spent",
        "avg_order_value",
        "last_purchase_date",
        "first_purchase_date",
        tenure.alias("customer_tenure_days"),
        per_unit(F.col("total_spent"), tenure + 1).alias("daily_avg_spent"),
        F.when(F.col("total_orders") > 0, F.round("total_spent", 2)).alias("estimated_clv"),
        "value_quintile",
        labels.value_tier(F.col("value_quintile")).alias("customer_value_tier"),
        "customer_spend_rank",
    )


def rfm_scores(df: DataFrame, recency: str, frequency: str, monetary: str) -> DataFrame:
    """Quintile scores 1..5 over the whole table; 5 is best (few days since the last purchase, many, much)."""
    orders = (("_old", recency), ("frequency_score", frequency), ("monetary_score", monetary))
    wanted = [Ranks([asc(column)], ["customer_id"], ntiles={score: 5}) for score, column in orders]
    df = with_ranks(df, *wanted)
    return df.withColumn("recency_score", 6 - F.col("_old")).drop("_old")


def mart_customer_behavior(behavior: DataFrame, customers: DataFrame) -> DataFrame:
    """Behaviour with scores, segment and suggested action.  The source has no birth date, gender or registration."""
    who = customers.select(
        "customer_id",
        "first_name",
        "last_name",
        "full_name",
        F.col("city_name").alias("customer_city"),
        F.col("country_name").alias("customer_country"),
        F.col("country_code").alias("customer_country_code"),
    )
    scored = rfm_scores(
        behavior.withColumn("days_since_last_purchase", F.datediff("data_as_of_date", "last_purchase_date")),
        "days_since_last_purchase",
        "purchase_count",
        "total_spend",
    )
    scores = [F.col(f"{name}_score") for name in ("recency", "frequency", "monetary")]
    return scored.join(who, "customer_id", "left").select(
        "customer_behavior_id",
        "customer_id",
        "first_name",
        "last_name",
        "full_name",
        "customer_city",
        "customer_country",
        "customer_country_code",
        F.lit(None).cast("date").alias("date_of_birth"),
        F.lit(None).cast("string").alias("gender"),
        F.lit(None).cast("date").alias("registration_date"),
        "purchase_count",
        "distinct_products_purchased",
        "total_quantity",
        "total_spend",
        "avg_transaction_value",
        "customer_value_segment",
        "engagement_status",
        "data_as_of_date",
        "last_purchase_date",
        "first_purchase_date",
        "days_between_first_last_purchase",
        "total_discount_received",
        "avg_discount_per_transaction",
        "days_since_last_purchase",
        F.datediff("data_as_of_date", "first_purchase_date").alias("customer_tenure_days"),
        per_unit(F.col("total_spend"), F.col("days_between_first_last_purchase") + 1).alias("daily_avg_spend"),
        F.lit(None).cast("bigint").alias("age"),
        F.lit("Unknown").alias("age_group"),
        "recency_score",
        "frequency_score",
        "monetary_score",
        labels.score_text(*scores).alias("rfm_score"),
        labels.mart_segment(*scores).alias("rfm_segment"),
        labels.marketing_action(*scores).alias("marketing_action"),
    )


def mart_employee_performance(performance: DataFrame) -> DataFrame:
    """Employee scorecard.  The country total is grouped and joined back, so a large country needs no large window."""
    totals = performance.groupBy(F.col("employee_country").alias("_country")).agg(
        F.sum("total_sales_revenue").alias("_country_revenue")
    )
    shared = performance.join(totals, F.col("employee_country").eqNullSafe(F.col("_country")), "left").withColumn(
        "pct_country_revenue", percent(F.col("total_sales_revenue"), F.col("_country_revenue"))
    )
    by_revenue = [desc("total_sales_revenue")]
    ranked = with_ranks(
        shared,
        Ranks(by_revenue, ["employee_id"], partition_by=["employee_country"], rank="country_rank"),
        Ranks(by_revenue, ["employee_id"], rank="company_rank"),
    )
    return ranked.drop("_country", "_country_revenue").withColumn(
        "performance_tier", labels.performance_tier(F.col("total_sales_revenue"))
    )


def top_employees(performance: DataFrame, first: int) -> DataFrame:
    """So many employees with the highest revenue, with rank and tier in the company."""
    by_revenue = Ranks([desc("total_sales_revenue")], ["employee_id"], rank="company_rank")
    return first_rows(performance, by_revenue, first).withColumn(
        "performance_tier", labels.performance_tier(F.col("total_sales_revenue"))
    )


SALES_GRAIN = (
    "year", "month", "day", "day_of_week", "customer_country", "customer_country_code", "salesperson_country",
    "product_id",
)


def sales_totals(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Totals per day, customer country, salesperson country and product: the sales mart without its ranks.

    Product labels hang on the product id and the calendar fields on the day, so both are added to the totals instead
    of widening every shuffled line.  ``unique_products`` is 1 wherever there is a product, as the product is part of the grain.

    Few lines share a day, two places and a product, so lines are sent to their group as they are, once: different ids
    are told by a mark on the first line of each, not by a copy of the line for every kind of id.
    """
    places = ("customer_country", "customer_country_code", "salesperson_country", "product_id")
    day = F.make_date("year", "month", "day").alias("_day")
    ids = ("sales_id", "customer_id", "salesperson_id")
    measures = ("quantity", "total_price", "estimated_profit", "discount")
    lines = fact.select(day, *places, *ids, *measures).repartition("_day", *places)

    def first_of(column: str) -> Column:
        """1 on one line of each id of a group, 0 elsewhere and where there is no id."""
        number = F.row_number().over(Window.partitionBy("_day", *places, column).orderBy(column))
        return F.when(F.col(column).isNotNull() & (number == 1), 1).otherwise(0)

    marked = lines.withColumns({f"_first_{c}": first_of(c) for c in ids})
    totals = marked.groupBy("_day", *places).agg(
        F.sum("_first_sales_id").alias("transaction_count"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("total_price").alias("total_revenue"),
        F.sum("estimated_profit").alias("total_profit"),
        exact_avg("total_price").alias("avg_transaction_value"),
        F.min("total_price").alias("min_transaction_value"),
        F.max("total_price").alias("max_transaction_value"),
        F.sum("_first_customer_id").alias("unique_customers"),
        F.sum("_first_salesperson_id").alias("unique_salespeople"),
        F.sum("discount").alias("total_discounts_given"),
    )
    # A product row that occurs more than once multiplies its lines, as a join before the grouping would.
    label = products.groupBy("product_id", "product_name", "category_name", "class", "price_category").agg(
        F.count(F.lit(1)).alias("_times")
    )
    times = F.coalesce("_times", F.lit(1))
    summed = ("total_units_sold", "total_revenue", "total_profit", "total_discounts_given")
    labelled = totals.join(label, "product_id", "left")
    labelled = labelled.withColumns({c: (F.col(c) * times).cast(totals.schema[c].dataType) for c in summed})
    calendar = {"year": F.year("_day"), "month": F.month("_day"), "day": F.dayofmonth("_day")}
    return labelled.withColumns(calendar).withColumns(_derived()).select(*TOTALS)


TOTALS = (
    *SALES_GRAIN, "product_name", "category_name", "class", "price_category", "transaction_count", "total_units_sold",
    "total_revenue", "total_profit", "avg_transaction_value", "min_transaction_value", "max_transaction_value",
    "unique_customers", "unique_products", "unique_salespeople", "total_discounts_given", "day_name", "quarter",
    "profit_margin_percentage", "revenue_per_customer", "units_per_customer", "discount_percentage",
)


def _derived() -> dict[str, Column]:
    """The columns of the totals that follow from the others in their row."""
    revenue, customers = F.col("total_revenue"), F.col("unique_customers")
    weekday = F.dayofweek(F.make_date("year", "month", "day"))
    return {
        "day_of_week": weekday,
        "unique_products": F.when(F.col("product_id").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
        "day_name": labels.day_name(weekday),
        "quarter": labels.season(F.col("month")),
        "profit_margin_percentage": percent(F.col("total_profit"), revenue),
        "revenue_per_customer": per_unit(revenue, customers),
        "units_per_customer": per_unit(F.col("total_units_sold"), customers),
        "discount_percentage": percent(F.col("total_discounts_given"), revenue),
    }


HOT_SELLING = Ranks(
    [desc("total_units_sold"), desc("total_revenue")],
    SALES_GRAIN,
    partition_by=["year", "month"],
    rank="monthly_hot_selling_product_rank",
)
CATEGORY_REVENUE = Ranks(
    [desc("total_revenue")],
    SALES_GRAIN,
    partition_by=["year", "month", "category_name"],
    rank="monthly_category_revenue_rank",
)


def mart_sales_summary(totals: DataFrame) -> DataFrame:
    """Sales totals with the two monthly ranks.  The ranks compare the daily rows of a month, not monthly totals.

    What follows from a row's other columns is not stored and shuffled with it, but added when it has its ranks.
    """
    derived = _derived()
    ranked = with_ranks(totals.drop(*derived), HOT_SELLING, CATEGORY_REVENUE)
    return ranked.withColumns(derived).select(*totals.columns, HOT_SELLING.rank, CATEGORY_REVENUE.rank)


def hot_selling(totals: DataFrame, top: int) -> DataFrame:
    """The rows of the mart with a hot-seller rank within ``top``, with what the reports on them show."""
    shown = totals.select("year", "month", "product_id", "product_name", "total_units_sold", "total_revenue")
    return first_ranks(shown, HOT_SELLING, top)


def category_leaders(totals: DataFrame, top: int) -> DataFrame:
    """The daily rows with a revenue rank within ``top`` in their month and category."""
    shown = totals.select("year", "month", "category_name", "product_id", "product_name", "total_revenue")
    return first_ranks(shown, CATEGORY_REVENUE, top)


def customer_products(sales: DataFrame) -> DataFrame:
    """What each customer bought, ranked by how often and for how much; ties go to the smaller product id.

    ``products_owned`` is the length of the customer's list.  A window group here is a list of distinct products, not
    of sale lines, so even the largest customer has no more rows than the catalogue.
    """
    bought = sales.groupBy("customer_id", "product_id").agg(
        sale_count().alias("purchase_frequency"),
        F.sum("quantity").alias("total_units_bought"),
        F.sum("total_price").alias("total_spent_on_product"),
        F.max("sales_date").alias("last_purchase_date"),
    )
    own = Window.partitionBy("customer_id")
    favourite = own.orderBy(
        F.desc("purchase_frequency"), F.desc_nulls_last("total_spent_on_product"), F.asc("product_id")
    )
    return bought.withColumns(
        {"products_owned": F.count(F.lit(1)).over(own), "product_rank": F.row_number().over(favourite)}
    )


def mart_recommend(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Up to ten recommendations per customer from products bought together with the customer's favourites.

    ``sales`` is any sale-line table (the enriched fact, or the lines it is made of: no label of it is read).  Only a
    customer's ten top products act as anchors, while everything the customer owns is excluded; one product may hold
    several ranks, one per anchor.

    For one customer and one anchor the score falls with the support, so only the anchor's best partners can be
    among the ten: at most ten plus as many as the customer owns, since no more than those can be excluded.
    """
    bought = customer_products(sales)

    items = basket_items(sales, "transaction_number", "product_id", "quantity")
    pairs = product_pairs(items, min_baskets=MIN_SUPPORT)
    nearest = Window.partitionBy("anchor").orderBy(F.desc("baskets"), F.asc("related"))
    partners = pairs.select(
        "anchor",
        "related",
        F.col("baskets").alias("co_purchase_txn_count"),
        F.col("related_units").alias("related_units_sold"),
        F.row_number().over(nearest).alias("_depth"),
    ).withColumn("_band", depth_band(F.col("_depth")))

    deepest = F.col("products_owned") + TOP_RECOMMENDATIONS
    favourites = bought.where(F.col("product_rank") <= TOP_ANCHORS).select(
        F.col("product_id").alias("anchor"),
        "customer_id",
        "purchase_frequency",
        "total_spent_on_product",
        deepest.alias("_deepest"),
        F.explode(bands_to(deepest)).alias("_band"),
    )
    spend = F.ln(1 + F.col("total_spent_on_product").cast("double"))
    score = (
        WEIGHT_FREQUENCY * F.col("purchase_frequency")
        + WEIGHT_SUPPORT * F.col("co_purchase_txn_count")
        + WEIGHT_SPEND * spend
    )
    candidates = (
        favourites.join(partners, ["anchor", "_band"])
        .where(F.col("_depth") <= F.col("_deepest"))
        .select(
            "customer_id",
            F.col("anchor").alias("purchased_product"),
            F.col("related").alias("recommended_product"),
            "co_purchase_txn_count",
            "related_units_sold",
            score.alias("recommendation_score"),
        )
    )
    has = sales.select("customer_id", F.col("product_id").alias("recommended_product")).distinct()
    best = Window.partitionBy("customer_id").orderBy(
        F.desc_nulls_last("recommendation_score"),
        F.desc("co_purchase_txn_count"),
        F.asc("purchased_product"),
        F.asc("recommended_product"),
    )
    top = (
        candidates.join(has, ["customer_id", "recommended_product"], "left_anti")
        .withColumn("recommendation_rank", F.row_number().over(best))
        .where(F.col("recommendation_rank") <= TOP_RECOMMENDATIONS)
    )

    def label(side: str) -> DataFrame:
        return products.select(
            F.col("product_id").alias(f"{side}_product"),
            F.col("product_name").alias(f"{side}_product_name"),
            F.col("category_name").alias(f"{side}_category"),
            F.col("class").alias(f"{side}_class"),
            F.col("price_category").alias(f"{side}_price_category"),
        )

    labelled = top.join(label("purchased"), "purchased_product", "left").join(
        label("recommended"), "recommended_product", "left"
    )
    rank = F.col("recommendation_rank")
    return labelled.select(
        surrogate_key("customer_id", "purchased_product", "recommended_product").alias("recommendation_id"),
        "customer_id",
        "purchased_product",
        "purchased_product_name",
        "purchased_category",
        "purchased_class",
        "purchased_price_category",
        "recommended_product",
        "recommended_product_name",
        "recommended_category",
        "recommended_class",
        "recommended_price_category",
        "co_purchase_txn_count",
        "related_units_sold",
        "recommendation_score",
        "recommendation_rank",
        labels.recommendation_priority(rank).alias("recommendation_priority"),
        labels.recommendation_type(
            F.col("purchased_category"),
            F.col("recommended_category"),
            F.col("purchased_class"),
            F.col("recommended_class"),
        ).alias("recommendation_type"),
        labels.price_movement(F.col("purchased_price_category"), F.col("recommended_price_category")).alias(
            "price_movement"
        ),
    )
