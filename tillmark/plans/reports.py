"""Report queries over the marts and the model outputs.

The sales reports need no rank unless they say so; give them ``sales_totals`` to spare the ranking.  Sorted reports
return the sorted rows; the ``top`` argument is the length of a top-k list.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions import labels


def controls(
    df: DataFrame,
    *,
    start: datetime.date | None = None,
    end: datetime.date | None = None,
    countries: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    customer_id: int | None = None,
    max_rank: int | None = None,
    model_type: str | None = None,
    segments: Sequence[str] | None = None,
) -> DataFrame:
    """Report controls as plain filters.  A control that is not set keeps every row.

    A date limit is put in terms of the year, month and day columns, so that it prunes tables stored by year and month.
    """
    year, month, day = F.col("year"), F.col("month"), F.col("day")
    if start is not None:
        later = (month > start.month) | ((month == start.month) & (day >= start.day))
        df = df.where((year >= start.year) & ((year > start.year) | (month >= start.month)))
        df = df.where((year > start.year) | later)
    if end is not None:
        earlier = (month < end.month) | ((month == end.month) & (day <= end.day))
        df = df.where((year <= end.year) & ((year < end.year) | (month <= end.month)))
        df = df.where((year < end.year) | earlier)
    if countries is not None:
        df = df.where(F.col("customer_country").isin(*countries))
    if categories is not None:
        df = df.where(F.col("category_name").isin(*categories))
    if customer_id is not None:
        df = df.where(F.col("customer_id") == customer_id)
    if max_rank is not None:
        df = df.where(F.col("recommendation_rank").between(1, max_rank))
    if model_type is not None:
        df = df.where(F.col("model_type") == model_type)
    if segments is not None:
        df = df.where(F.col("rfm_segment" if "rfm_segment" in df.columns else "segment_name").isin(*segments))
    return df


# --- customers and salespeople ---------------------------------------------------------------------------------------


def top_customers(lifetime_value: DataFrame, top: int = 10) -> DataFrame:
    return (
        lifetime_value.select(
            "customer_id", "total_spent", "estimated_clv", "customer_value_tier", "customer_spend_rank"
        )
        .orderBy(F.desc_nulls_last("total_spent"), F.asc("customer_id"))
        .limit(top)
    )


def top_salespeople(employees: DataFrame, top: int = 10) -> DataFrame:
    return (
        employees.select(
            "employee_id",
            "employee_name",
            "employee_country",
            "total_sales_revenue",
            "company_rank",
            "performance_tier",
        )
        .orderBy(F.asc("company_rank"), F.asc("employee_id"))
        .limit(top)
    )


def customers_by_rank(lifetime_value: DataFrame) -> DataFrame:
    return lifetime_value.select(
        "customer_id", "customer_value_tier", "total_spent", "estimated_clv", "customer_spend_rank"
    ).orderBy(F.asc("customer_spend_rank"), F.asc("customer_id"))


def campaign_list(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "full_name", "rfm_score", "rfm_segment", "marketing_action", "engagement_status"
    ).orderBy(F.asc("rfm_segment"), F.desc("rfm_score"), F.asc("customer_id"))


def segment_table(customers: DataFrame) -> DataFrame:
    return customers.groupBy("rfm_segment", "marketing_action").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.try_divide(F.sum("total_spend").cast("double"), F.count("total_spend")).alias("avg_total_spend"),
    )


def segment_sizes(customers: DataFrame) -> DataFrame:
    return customers.groupBy("rfm_segment").agg(F.count_distinct("customer_id").alias("customers"))


def engagement_sizes(customers: DataFrame) -> DataFrame:
    return customers.groupBy("engagement_status").agg(F.count_distinct("customer_id").alias("customers"))


def employee_table(employees: DataFrame) -> DataFrame:
    return employees.select(
        "employee_name",
        "employee_country",
        "performance_tier",
        "total_sales_revenue",
        "total_sales_transactions",
        "unique_customers_served",
        "company_rank",
    ).orderBy(F.asc("company_rank"), F.asc("employee_name"))


def employee_bars(employees: DataFrame, top: int = 10) -> DataFrame:
    """Ten names with the highest revenue; employees who share a name share a bar."""
    return (
        employees.groupBy("employee_name")
        .agg(F.sum("total_sales_revenue").alias("total_sales_revenue"))
        .orderBy(F.desc_nulls_last("total_sales_revenue"), F.asc("employee_name"))
        .limit(top)
    )


def employee_countries(employees: DataFrame) -> DataFrame:
    revenue = F.sum("total_sales_revenue")
    return employees.groupBy("employee_country").agg(
        revenue.alias("total_revenue"),
        F.try_divide(revenue.cast("double"), F.count("total_sales_revenue")).alias("avg_revenue"),
    )


# --- sales -----------------------------------------------------------------------------------------------------------


def monthly_category_revenue(totals: DataFrame) -> DataFrame:
    return (
        totals.groupBy("year", "month", "category_name")
        .agg(F.sum("total_revenue").alias("revenue"))
        .orderBy("year", "month", F.desc_nulls_last("revenue"))
    )


def category_trend(totals: DataFrame) -> DataFrame:
    return totals.groupBy(
        labels.year_month(F.col("year"), F.col("month")).alias("year_month"), "category_name"
    ).agg(F.sum("total_revenue").alias("revenue"))


def hot_sellers(sales_mart: DataFrame, top: int = 10) -> DataFrame:
    """Rows of the ranked mart with a hot-seller rank within ``top``."""
    return (
        sales_mart.where(F.col("monthly_hot_selling_product_rank") <= top)
        .select(
            "year",
            "month",
            "product_id",
            "product_name",
            "total_units_sold",
            "monthly_hot_selling_product_rank",
        )
        .orderBy(F.desc("year"), F.desc("month"), F.asc("monthly_hot_selling_product_rank"))
    )


def hot_seller_units(sales_mart: DataFrame, top: int = 10) -> DataFrame:
    """Units per product name over the rows with a hot-seller rank within ``top``."""
    return (
        sales_mart.where(F.col("monthly_hot_selling_product_rank") <= top)
        .groupBy("product_name")
        .agg(F.sum("total_units_sold").alias("total_units_sold"))
    )


def scorecards(totals: DataFrame) -> DataFrame:
    revenue, profit = F.sum("total_revenue"), F.sum("total_profit")
    return totals.agg(
        revenue.alias("total_revenue"),
        profit.alias("total_profit"),
        F.try_divide(profit.cast("double"), revenue.cast("double")).alias("profit_margin_pct"),
    )


def monthly_revenue(totals: DataFrame) -> DataFrame:
    """Revenue and profit per month next to the month before.  The window runs over one row per month."""
    monthly = totals.groupBy("year", "month").agg(
        F.sum("total_revenue").alias("revenue"), F.sum("total_profit").alias("profit")
    )
    calendar = Window.orderBy("year", "month")
    return monthly.select(
        labels.year_month(F.col("year"), F.col("month")).alias("year_month"),
        "revenue",
        "profit",
        F.lag("revenue").over(calendar).alias("previous_revenue"),
        F.lag("profit").over(calendar).alias("previous_profit"),
    )


def _revenue_by(totals: DataFrame, *columns: str) -> DataFrame:
    return totals.groupBy(*columns).agg(
        F.sum("total_units_sold").alias("units"),
        F.sum("total_revenue").alias("revenue"),
        F.sum("total_profit").alias("profit"),
    )


def country_revenue(totals: DataFrame) -> DataFrame:
    return _revenue_by(totals, "customer_country").drop("units")


def price_category_revenue(totals: DataFrame) -> DataFrame:
    return _revenue_by(totals, "price_category").select("price_category", "revenue")


def product_table(totals: DataFrame) -> DataFrame:
    return _revenue_by(totals, "product_name", "category_name").orderBy(
        F.desc_nulls_last("units"), F.asc("product_name"), F.asc("category_name")
    )


def product_scatter(totals: DataFrame) -> DataFrame:
    return _revenue_by(totals, "product_name")


# --- recommendations and segments of the model job -------------------------------------------------------------------


def customer_recommendations(mart: DataFrame, customer_id: int) -> DataFrame:
    """Recommendations of one customer, best first."""
    return (
        mart.where(F.col("customer_id") == customer_id)
        .orderBy("recommendation_rank")
        .select(
            "customer_id",
            "recommended_product",
            "recommended_product_name",
            "recommendation_score",
            "recommendation_priority",
            "recommendation_type",
            "price_movement",
        )
    )


def recommendation_table(recommendations: DataFrame) -> DataFrame:
    return recommendations.select(
        "customer_id", "customer_name", "recommendation_rank", "product_name", "category_name", "score"
    ).orderBy(F.desc("score"), F.asc("customer_id"), F.asc("recommendation_rank"))


def first_choices(recommendations: DataFrame) -> DataFrame:
    return recommendations.where(F.col("recommendation_rank") == 1).select(
        "customer_id", "customer_name", "product_name", "category_name", "score"
    )


def segment_distribution(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("segment_name")
        .agg(F.count_distinct("customer_id").alias("customers"))
        .orderBy(F.desc("customers"), F.asc("segment_name"))
    )


def _mean(column: str):
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def segment_means(segments: DataFrame) -> DataFrame:
    """Customers and means per segment; the two money means with two digits, as the validation query shows them."""
    return (
        segments.groupBy("segment_id", "segment_name")
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            F.round(_mean("monetary"), 2).alias("avg_spend"),
            F.round(F.avg("avg_order_value"), 2).alias("avg_order_value"),
            _mean("frequency").alias("avg_frequency"),
            _mean("recency_days").alias("avg_recency_days"),
        )
        .orderBy("segment_id")
    )


def recommendation_scorecards(recommendations: DataFrame) -> DataFrame:
    def share(model_type: str):
        hit = F.when(F.col("model_type") == model_type, 1).otherwise(0)
        return F.try_divide(F.sum(hit).cast("double"), F.count("product_id"))

    return recommendations.agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count("product_id").alias("recommendations"),
        F.avg("score").alias("avg_score"),
        share("ALS").alias("als_coverage"),
        share("HEURISTIC_FALLBACK").alias("fallback_coverage"),
    )


def most_recommended(recommendations: DataFrame, top: int = 20) -> DataFrame:
    return (
        recommendations.groupBy("product_name", "category_id", "model_type")
        .agg(F.count(F.lit(1)).alias("recommendation_count"), F.round(F.avg("score"), 2).alias("avg_score"))
        .orderBy(
            F.desc("recommendation_count"), F.asc("product_name"), F.asc("category_id"), F.asc("model_type")
        )
        .limit(top)
    )


def most_recommended_products(recommendations: DataFrame, top: int = 20) -> DataFrame:
    """Products by how often they are recommended, with their category's name, whatever model did so."""
    return (
        recommendations.groupBy("product_name", "category_name")
        .agg(F.count("product_id").alias("recommendations"), F.avg("score").alias("avg_score"))
        .orderBy(F.desc("recommendations"), F.asc("product_name"), F.asc("category_name"))
        .limit(top)
    )


def recommendation_explorer(recommendations: DataFrame, max_rank: int = 5) -> DataFrame:
    return (
        controls(recommendations, max_rank=max_rank)
        .select(
            "customer_id",
            "customer_name",
            "recommendation_rank",
            "product_name",
            "category_name",
            "model_type",
            "score",
        )
        .orderBy("customer_id", "recommendation_rank")
    )
