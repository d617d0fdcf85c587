"""The registered queries: one per table, operator, check and report, over the test tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, ShortType, TimestampNTZType, TimestampType

from tillmark.operators.baskets import basket_items, product_pairs
from tillmark.operators.durable import checkpointed, fresh_place
from tillmark.plans import geography, marts, quality, recommend, reports, segments
from tillmark.plans.workspace import REFRESH_ORDER, Workspace
from tillmark.session import tune
from tillmark.sources import readers, sinks, testtables

Query = Callable[[SparkSession, str], DataFrame]

# Whose recommendations the point lookup shows.
LOOKUP_CUSTOMER = 123


def comparable(df: DataFrame) -> DataFrame:
    """Types on which engines agree: decimals as double, whole numbers as bigint, dates and times as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (IntegerType, ShortType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(columns)


def _table(name: str) -> Query:
    return lambda spark, folder: getattr(Workspace.of_test_tables(tune(spark), folder), name)


def _report(report: Callable[..., DataFrame], table: str, *args, **kwargs) -> Query:
    return lambda spark, folder: report(_table(table)(spark, folder), *args, **kwargs)


def _first(report: Callable[..., DataFrame], rows: str, top: int = 10) -> Query:
    """A report that shows no rank beyond ``top``: only so many are found."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return report(getattr(Workspace.of_test_tables(tune(spark), folder), rows)(top), top)

    return run


def _category_leaders(spark: SparkSession, folder: str) -> DataFrame:
    return marts.category_leaders(Workspace.of_test_tables(tune(spark), folder).sales_totals, 3)


def _geo(build: Callable[..., DataFrame], *inputs: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(*[getattr(testtables, name)(tune(spark), folder) for name in inputs])

    return run


def _repaired_raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    space = Workspace.of_test_tables(tune(spark), folder)
    return segments.repaired_sales(space.source("sales"), space.product_labels)


def _sales_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """No curated table in the folder, so the raw one is read: here the lines under the raw column names."""
    return readers.sales_source(spark, f"{folder}/st_sales.parquet", testtables.sales(tune(spark), folder))


def _upserted_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Lines sold by an odd salesperson come again with one unit more, and each of them once under a new id."""
    lines = _table("st_sales")(spark, folder)
    again = lines.where(F.col("salesperson_id") % 2 == 1).withColumn("quantity", F.col("quantity") + 1)
    fresh = again.withColumn("sales_id", F.concat(F.lit("new-"), F.col("sales_id")))
    return sinks.upsert(lines, again.unionByName(fresh), "sales_id")


FACTS = REFRESH_ORDER[: REFRESH_ORDER.index("fct_sales_summary") + 1]


def _refreshed_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Stored staging and fact tables, and the sales mart's totals on them."""
    space = Workspace.of_test_tables(tune(spark), folder)
    space.refresh(fresh_place(spark), FACTS)
    return space.sales_totals.groupBy("year", "month", "customer_country").agg(
        F.sum("transaction_count").alias("transactions"), F.sum("total_revenue").alias("revenue")
    )


def _published_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The same from the tables that readers see after a publication."""
    place = fresh_place(spark)
    Workspace.of_test_tables(tune(spark), folder).publish(place, FACTS)
    seen = sinks.published(spark, place)
    return marts.sales_totals(seen["fct_sales_summary"], seen["st_products"]).groupBy(
        "year", "month", "customer_country"
    ).agg(F.sum("transaction_count").alias("transactions"), F.sum("total_revenue").alias("revenue"))


def _measured_writes(spark: SparkSession, folder: str) -> DataFrame:
    """What the writes of a refresh found, one row per table and measure."""
    space = Workspace.of_test_tables(tune(spark), folder)
    space.refresh(fresh_place(spark), FACTS)
    rows = [(table, name, value) for table, own in space.measured.items() for name, value in own.items()]
    return spark.createDataFrame(rows, "table_name string, measure string, value bigint")


def _upserted_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Lines sold by an odd salesperson come again with one unit more."""
    space = Workspace.of_test_tables(tune(spark), folder)
    place = fresh_place(spark)
    space.refresh(place, FACTS)
    odd = space.source("sales").where(F.col("SalesPersonID") % 2 == 1)
    stored = space.upsert_sales(place, odd.withColumn("Quantity", F.col("Quantity") + 1))
    return stored["fct_sales_summary"].drop("dbt_loaded_at")


def _upserted_mart(name: str, below: str | None = None) -> Query:
    """A stored mart after a batch: customers of the last digit 3 have one unit more in every line, and every second of
    these lines was sold 40 days later.  Only what the mart needs is stored before."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        space = Workspace.of_test_tables(tune(spark), folder)
        place = fresh_place(spark)
        space.refresh(place, (*FACTS, *((below,) if below else ()), name))
        sales = space.source("sales")
        later = F.when(F.col("SalesID") % 2 == 0, F.col("SalesDate") + F.expr("interval 40 days")).otherwise(F.col("SalesDate"))
        batch = sales.where(F.col("CustomerID") % 10 == 3).withColumns(
            {"Quantity": F.col("Quantity") + 1, "SalesDate": later.cast(sales.schema["SalesDate"].dataType)}
        )
        return space.upsert_sales(place, batch)[name].drop("dbt_loaded_at")

    return run


def _curated_sales(spark: SparkSession, folder: str) -> DataFrame:
    """A curated table that is there is read instead of the raw one."""
    place = fresh_place(spark)
    sinks.write_table(_table("st_sales")(spark, folder), place, ("year", "month"))
    return readers.sales_source(spark, place, f"{place}-none")


def _als_checks(spark: SparkSession, folder: str) -> DataFrame:
    space = Workspace.of_test_tables(tune(spark), folder)
    ratings = checkpointed(recommend.als_ratings(space.model_sales))
    found = checkpointed(
        recommend.als_recommendations(ratings, space.product_labels, space.customer_labels, space.settings)
    )
    return recommend.als_checks(found, ratings, space.product_labels)


def _sparse_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    """The gate asks for more customers than there are, so it falls back."""
    space = Workspace.of_test_tables(tune(spark), folder)
    settings = replace(space.settings, min_users=1 << 40)
    return recommend.recommendations(space.model_sales, space.product_labels, space.customer_labels, settings)


def _both_models(spark: SparkSession, folder: str) -> DataFrame:
    """Recommendations of which those of even customers carry the name of the other model."""
    model = F.when(F.col("customer_id") % 2 == 0, "ALS").otherwise(F.col("model_type"))
    return _table(_HEURISTIC)(spark, folder).withColumn("model_type", model)


def _controlled_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    kept = reports.controls(_both_models(spark, folder), model_type="ALS", max_rank=3)
    return reports.recommendation_table(kept)


def _controlled_revenue(spark: SparkSession, folder: str) -> DataFrame:
    kept = reports.controls(
        _table("sales_totals")(spark, folder),
        start=datetime.date(1995, 3, 15),
        end=datetime.date(1996, 11, 20),
        countries=["AFRICA", "ASIA"],
        categories=["PROMO", "SMALL"],
    )
    return reports.monthly_category_revenue(kept)


def _misspelt_codes(spark: SparkSession, folder: str) -> DataFrame:
    code = F.when(F.col("CountryID") % 2 == 0, F.lower("CountryCode")).when(F.col("CountryID") == 1, None)
    return quality.malformed_country_codes(
        testtables.countries(tune(spark), folder).withColumn("CountryCode", code.otherwise(F.col("CountryCode")))
    )


def _hot_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """A third of all lines share a basket, and a third of them a product; pairs of at least two baskets.

    Baskets of over 40 products count as long, so that all ways of pairing are used.
    """
    lines = _table("st_sales")(spark, folder).select(
        F.when(F.col("day") % 3 == 0, F.lit("hot")).otherwise(F.col("transaction_number")).alias("basket"),
        F.when(F.col("day") % 3 == 1, F.lit(0)).otherwise(F.col("product_id") % 97).alias("product"),
        "quantity",
    )
    pairs = product_pairs(basket_items(lines, "basket", "product", "quantity"), min_baskets=2, tile=40)
    return pairs.select("anchor", "related", "baskets", "line_pairs", "related_units")


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table("st_sales")(spark, folder)
    return product_pairs(basket_items(lines, "transaction_number", "product_id", "quantity")).select(
        F.col("anchor").alias("anchor_product_id"),
        F.col("related").alias("related_product_id"),
        F.col("baskets").alias("co_purchase_txn_count"),
        F.col("line_pairs").alias("co_purchase_count"),
        F.col("related_units").alias("related_units_sold"),
    )


def _rounded(query: Query, *columns: str) -> Query:
    """Logarithms differ between engines in the last bit; six digits are compared."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(spark, folder).withColumns({c: F.round(c, 6) for c in columns})

    return run


_HEURISTIC = "heuristic_recommendations"

_QUERIES: dict[str, Query] = {
    # sources and sinks
    "dim_categories": _table("dim_categories"),
    "dim_cities": _table("dim_cities"),
    "dim_countries": _table("dim_countries"),
    "product_labels": _table("product_labels"),
    "customer_labels": _table("customer_labels"),
    "sales_source_fallback": _sales_fallback,
    "curated_sales": _curated_sales,
    "upserted_sales": _upserted_sales,
    "upserted_fact": _upserted_fact,
    "refreshed_sales_totals": _refreshed_totals,
    "published_sales_totals": _published_totals,
    "measured_writes": _measured_writes,
    "upserted_sales_mart": _upserted_mart("mart_sales_summary"),
    "upserted_lifetime_value": _upserted_mart("customer_lifetime_value"),
    "upserted_customer_mart": _upserted_mart("mart_customer_behavior", "fct_customer_behavior"),
    "upserted_employee_mart": _upserted_mart("mart_employee_performance", "fct_employee_performance"),
    # staging, facts, marts
    "st_customers": _table("st_customers"),
    "st_employees": _table("st_employees"),
    "st_products": _table("st_products"),
    "st_sales": _table("st_sales"),
    "fct_sales_summary": _table("fct_sales_summary"),
    "fct_customer_behavior": _table("fct_customer_behavior"),
    "fct_employee_performance": _table("fct_employee_performance"),
    "customer_lifetime_value": _table("customer_lifetime_value"),
    "mart_customer_behavior": _table("mart_customer_behavior"),
    "mart_employee_performance": _table("mart_employee_performance"),
    "mart_sales_summary": _table("mart_sales_summary"),
    "product_pairs": _pairs,
    "hot_basket_pairs": _hot_pairs,
    "mart_recommend": _rounded(_table("mart_recommend"), "recommendation_score"),
    # customer models
    "repaired_sales": _repaired_raw_sales,
    "customer_segments": _table("customer_segments"),
    "als_ratings": _rounded(_report(recommend.als_ratings, "model_sales"), "rating"),
    "model_gate": _report(lambda sales: recommend.model_gate(recommend.als_ratings(sales)), "model_sales"),
    "heuristic_recommendations": _table(_HEURISTIC),
    "als_recommendations": _table("als_recommendations"),
    "customer_recommendations": _table("customer_recommendations"),
    "als_checks": _als_checks,
    "sparse_recommendations": _sparse_recommendations,
    # geography
    "normalized_countries": _geo(geography.normalized_countries, "countries", "iso_countries"),
    "city_codes": _geo(geography.city_codes, "world_cities"),
    "completed_countries": _geo(
        geography.completed_countries, "cities", "countries", "iso_countries", "world_cities"
    ),
    "normalized_cities": _geo(geography.normalized_cities, "cities", "countries", "iso_countries", "world_cities"),
    "geography_counters": _geo(geography.geography_counters, "cities", "countries", "iso_countries", "world_cities"),
    # checks
    "forbidden_cities": _report(quality.forbidden_cities, "dim_cities", ("NATION_3", "NATION_11", "Kansas")),
    "wrong_country_codes": _report(quality.wrong_country_codes, "dim_countries", {"AFRICA": "AF", "ASIA": "IN", "India": "IN"}),
    "rank_violations": _report(quality.rank_violations, _HEURISTIC),
    "stricter_rank_violations": _report(quality.rank_violations, _HEURISTIC, 7),
    "segment_counts": _report(quality.segment_counts, "customer_segments"),
    "recommendation_counts": _report(quality.recommendation_counts, _HEURISTIC),
    "malformed_country_codes": _report(quality.malformed_country_codes, "dim_countries"),
    "misspelt_country_codes": _misspelt_codes,
    # reports
    "top_customers": _first(reports.top_customers, "top_lifetime_value"),
    "customers_by_rank": _report(reports.customers_by_rank, "customer_lifetime_value"),
    "top_salespeople": _first(reports.top_salespeople, "top_employees"),
    "employee_table": _report(reports.employee_table, "mart_employee_performance"),
    "employee_bars": _report(reports.employee_bars, "mart_employee_performance"),
    "employee_countries": _report(reports.employee_countries, "mart_employee_performance"),
    "monthly_category_revenue": _report(reports.monthly_category_revenue, "sales_totals"),
    "category_trend": _report(reports.category_trend, "sales_totals"),
    "hot_sellers": _first(reports.hot_sellers, "hot_selling"),
    "hot_seller_units": _first(reports.hot_seller_units, "hot_selling"),
    "category_leaders": _category_leaders,
    "scorecards": _report(reports.scorecards, "sales_totals"),
    "controlled_revenue": _controlled_revenue,
    "monthly_revenue": _report(reports.monthly_revenue, "sales_totals"),
    "country_revenue": _report(reports.country_revenue, "sales_totals"),
    "price_category_revenue": _report(reports.price_category_revenue, "sales_totals"),
    "product_table": _report(reports.product_table, "sales_totals"),
    "product_scatter": _report(reports.product_scatter, "sales_totals"),
    "campaign_list": _report(reports.campaign_list, "mart_customer_behavior"),
    "segment_table": _report(reports.segment_table, "mart_customer_behavior"),
    "segment_sizes": _report(reports.segment_sizes, "mart_customer_behavior"),
    "engagement_sizes": _report(reports.engagement_sizes, "mart_customer_behavior"),
    "recommendations_of_customer": _rounded(
        _report(reports.customer_recommendations, "mart_recommend", LOOKUP_CUSTOMER), "recommendation_score"
    ),
    "recommendation_table": _report(reports.recommendation_table, _HEURISTIC),
    "first_choices": _report(reports.first_choices, _HEURISTIC),
    "segment_distribution": _report(reports.segment_distribution, "customer_segments"),
    "segment_means": _report(reports.segment_means, "customer_segments"),
    "recommendation_scorecards": _report(reports.recommendation_scorecards, _HEURISTIC),
    "both_model_scorecards": lambda spark, folder: reports.recommendation_scorecards(_both_models(spark, folder)),
    "controlled_recommendations": _controlled_recommendations,
    "most_recommended_products": _report(reports.most_recommended_products, _HEURISTIC),
    "most_recommended": _report(reports.most_recommended, _HEURISTIC),
    "recommendation_explorer": _report(reports.recommendation_explorer, _HEURISTIC),
}


def _compared(query: Query) -> Query:
    return lambda spark, folder: comparable(query(spark, folder))


def queries() -> dict[str, Query]:
    return {name: _compared(query) for name, query in _QUERIES.items()}
