"""Fact tables: one row per sale line, customer and employee."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions import labels
from tillmark.functions.keys import surrogate_key
from tillmark.functions.money import exact_avg, line_profit, per_unit
from tillmark.operators.durable import checkpointed
from tillmark.plans.staging import calendar


def sale_count() -> Column:
    """Number of different sales in a group: an id that a join has repeated counts once."""
    return F.count_distinct("sales_id")


def fct_sales_summary(
    sales: DataFrame, products: DataFrame, customers: DataFrame, employees: DataFrame
) -> DataFrame:
    """Sale lines with product, customer and salesperson labels and the estimated profit.

    Whether a dimension is broadcast is left to Spark, which sees its size at run time, when the lines are already sent to meet
    it.  The employees, the smallest, are stored first: the plan knows their size, and the lines, by then at their widest,
    are not sent for them.  The product join comes first: lines that were
    just priced by product are still partitioned by it where that join had to be shuffled.  The calendar fields follow
    from the time of the sale, so no join carries them.
    """
    sales = sales.drop("year", "month", "day", "day_of_week")
    product = products.select("product_id", "product_name", "category_name", "class", "price_category", "price")
    customer = customers.select(
        "customer_id",
        F.col("city_name").alias("customer_city"),
        F.col("country_name").alias("customer_country"),
        F.col("country_code").alias("customer_country_code"),
    )
    salesperson = checkpointed(
        employees.select(
            F.col("employee_id").alias("salesperson_id"),
            F.col("full_name").alias("salesperson_name"),
            F.col("city_name").alias("salesperson_city"),
            F.col("country_name").alias("salesperson_country"),
        )
    )
    star = (
        sales.join(product, "product_id", "left")
        .join(customer, "customer_id", "left")
        .join(salesperson, "salesperson_id", "left")
    )
    return star.select(
        surrogate_key("sales_id").alias("sales_summary_id"),
        "sales_id",
        "salesperson_id",
        "salesperson_name",
        "salesperson_city",
        "salesperson_country",
        "customer_id",
        "customer_city",
        "customer_country",
        "customer_country_code",
        "product_id",
        "product_name",
        "category_name",
        "class",
        "price_category",
        "quantity",
        "discount",
        "total_price",
        line_profit(F.col("total_price"), F.col("price"), F.col("quantity")).alias("estimated_profit"),
        "sales_date",
        "transaction_number",
        *calendar("sales_date"),
    )


def fct_customer_behavior(sales: DataFrame) -> DataFrame:
    """Purchase behaviour per customer, measured against the last day of the whole data set.

    ``purchase_count`` counts sale lines, not baskets.
    """
    bought = sales.groupBy("customer_id").agg(
        sale_count().alias("purchase_count"),
        F.count_distinct("product_id").alias("distinct_products_purchased"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_price").alias("total_spend"),
        exact_avg("total_price").alias("avg_transaction_value"),
        F.max("sales_date").alias("last_purchase_date"),
        F.min("sales_date").alias("first_purchase_date"),
        F.sum("discount").alias("total_discount_received"),
        exact_avg("discount").alias("avg_discount_per_transaction"),
    )
    return _anchored(
        bought.select(
            surrogate_key("customer_id").alias("customer_behavior_id"),
            "customer_id",
            "purchase_count",
            "distinct_products_purchased",
            "total_quantity",
            "total_spend",
            "avg_transaction_value",
            "last_purchase_date",
            "first_purchase_date",
            F.datediff("last_purchase_date", "first_purchase_date").alias("days_between_first_last_purchase"),
            "total_discount_received",
            "avg_discount_per_transaction",
            F.lit(None).cast("date").alias("data_as_of_date"),
            labels.value_segment(F.col("purchase_count")).alias("customer_value_segment"),
            F.lit(None).cast("string").alias("engagement_status"),
        )
    )


def _anchored(behavior: DataFrame) -> DataFrame:
    """Behaviour against the last day of all customers: a scalar subquery over their own last days, no join."""
    last_day = behavior.agg(F.max(F.col("last_purchase_date").cast("date"))).scalar()
    idle_days = F.datediff("data_as_of_date", "last_purchase_date")
    anchored = behavior.withColumn("data_as_of_date", last_day)
    return anchored.withColumn("engagement_status", labels.engagement_status(idle_days))


def only(rows: DataFrame, keys: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """The rows whose ``column`` is in ``keys`` (null included), or is not (``left_anti``)."""
    return rows.join(keys.select(F.col(column).alias("_only")), F.col(column).eqNullSafe(F.col("_only")), how)


def updated_customer_behavior(old: DataFrame, fresh: DataFrame, touched: DataFrame) -> DataFrame:
    """A stored table with the rows of touched customers replaced; a later last day shows in every row."""
    return _anchored(only(old, touched, "customer_id", "left_anti").unionByName(fresh))


def fct_employee_performance(employees: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales per employee, employees without a sale included (counts 0, sums null).

    Sales are folded to one row per salesperson before they meet the employees.
    """
    sold = sales.groupBy(F.col("salesperson_id").alias("employee_id")).agg(
        sale_count().alias("_sales"),
        F.count_distinct("customer_id").alias("_customers"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("total_price").alias("total_sales_revenue"),
        exact_avg("total_price").alias("avg_transaction_value"),
        F.sum("discount").alias("total_discounts_given"),
    )
    counted = (
        employees.join(sold, "employee_id", "left")
        .withColumn("total_sales_transactions", F.coalesce("_sales", F.lit(0)))
        .withColumn("unique_customers_served", F.coalesce("_customers", F.lit(0)))
    )
    return counted.select(
        surrogate_key("employee_id").alias("employee_performance_id"),
        "employee_id",
        F.col("full_name").alias("employee_name"),
        F.col("city_name").alias("employee_city"),
        F.col("country_name").alias("employee_country"),
        "experience_level",
        "total_sales_transactions",
        "unique_customers_served",
        "total_units_sold",
        "total_sales_revenue",
        "avg_transaction_value",
        "total_discounts_given",
        "years_employed",
        per_unit(F.col("total_sales_revenue"), F.col("total_sales_transactions")).alias("revenue_per_transaction"),
    )
