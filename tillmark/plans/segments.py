"""Sales repair and customer segments of the model job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions import labels
from tillmark.functions.money import MONEY, exact_avg, line_total, money
from tillmark.plans.marts import rfm_scores

# The repaired total is required too, but it is never null: leaving it out lets Spark skip the price work where a
# reader needs no total.
REQUIRED = ("SalesDate", "CustomerID", "ProductID", "Quantity", "TransactionNumber")


def repaired_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sale lines with a usable total and no gap in a required column.

    A total that is missing or not positive is worked out again from price, quantity and discount (missing parts count
    as 0); a result below 0 becomes 0.  ``products`` has product_id and product_price.
    """
    zero = F.lit(0)
    price = products.select(F.col("product_id").alias("_product"), money("product_price").alias("_price"))
    again = line_total(
        F.coalesce("_price", zero), F.coalesce("Quantity", zero), F.coalesce("Discount", zero)
    )
    total = F.when(F.col("TotalPrice") > 0, money("TotalPrice")).otherwise(again)
    return (
        sales.join(price, F.col("ProductID") == F.col("_product"), "left")
        .select(
            "SalesDate",
            "CustomerID",
            "ProductID",
            F.greatest(total, zero).cast(MONEY).alias("TotalPrice"),
            "Quantity",
            "Discount",
            "TransactionNumber",
        )
        .na.drop(subset=list(REQUIRED))
    )


def rfm_segments(sales: DataFrame) -> DataFrame:
    """Recency, frequency (baskets, not lines) and spend per customer, scored and segmented.

    The snapshot day is the last sale in the input, taken as a scalar subquery instead of being collected.
    """
    snapshot = sales.agg(F.max("SalesDate")).scalar()
    base = sales.groupBy(F.col("CustomerID").alias("customer_id")).agg(
        F.count_distinct("TransactionNumber").alias("frequency"),
        F.sum("TotalPrice").alias("monetary"),
        exact_avg("TotalPrice").alias("avg_order_value"),
        exact_avg("Quantity").alias("avg_quantity"),
        F.max("SalesDate").alias("last_purchase_date"),
    )
    dated = base.withColumn("snapshot_date", snapshot).withColumn(
        "recency_days", F.datediff("snapshot_date", "last_purchase_date")
    )
    scores = [F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")]
    return (
        rfm_scores(dated, "recency_days", "frequency", "monetary")
        .withColumn("rfm_score", labels.score_text(*scores))
        .withColumn("segment_name", labels.model_segment(*scores))
        .withColumn("segment_id", labels.segment_number(F.col("segment_name")))
    )
