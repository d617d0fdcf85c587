"""Data-quality checks.  A check that passes returns no row, unless it is a summary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the checks.
FORBIDDEN_CITIES = ("Colorado", "Kansas", "Oklahoma", "Jersey", "Washington")
CORE_COUNTRY_CODES = {
    "United States": "US",
    "Canada": "CA",
    "Germany": "DE",
    "United Kingdom": "GB",
    "India": "IN",
    "Australia": "AU",
}


def forbidden_cities(cities: DataFrame, forbidden: Iterable[str] = FORBIDDEN_CITIES) -> DataFrame:
    bad = cities.sparkSession.createDataFrame([(name,) for name in forbidden], "city_name string")
    return cities.select(F.col("CityName").alias("city_name")).join(bad, "city_name")


def wrong_country_codes(countries: DataFrame, expected: Mapping[str, str] = CORE_COUNTRY_CODES) -> DataFrame:
    """Expected countries that are missing or carry another code."""
    wanted = countries.sparkSession.createDataFrame(
        list(expected.items()), "country_name string, expected_country_code string"
    )
    actual = countries.select(
        F.col("CountryName").alias("country_name"), F.col("CountryCode").alias("actual_country_code")
    )
    same = F.col("actual_country_code").eqNullSafe(F.col("expected_country_code"))
    return wanted.join(actual, "country_name", "left").where(~same)


def rank_violations(recommendations: DataFrame, max_rank: int = 10) -> DataFrame:
    """Customers with a recommendation ranked beyond ``max_rank``."""
    return (
        recommendations.groupBy("customer_id")
        .agg(F.max("recommendation_rank").alias("max_rank"), F.count(F.lit(1)).alias("recommendation_count"))
        .where(F.col("max_rank") > max_rank)
    )


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.agg(
        F.count(F.lit(1)).alias("segment_rows"), F.count_distinct("customer_id").alias("customers_segmented")
    )


def recommendation_counts(recommendations: DataFrame) -> DataFrame:
    return recommendations.agg(
        F.count(F.lit(1)).alias("recommendation_rows"),
        F.count_distinct("customer_id").alias("customers_with_reco"),
        F.avg("score").alias("avg_reco_score"),
        F.count_distinct("model_type").alias("model_types_present"),
    )


def malformed_country_codes(countries: DataFrame) -> DataFrame:
    """Countries whose code is not two capital letters."""
    return countries.where(~_shaped("CountryCode"))


def measures(table: str) -> dict[str, Column]:
    """What the checks look at, as aggregates that the write of ``table`` gathers while it runs.

    Each is the number of rows that the check of that name finds, where it is one; a table without checks has its rows
    counted.
    """
    found = {"rows": F.count(F.lit(1))}
    if table == "dim_cities":
        found["forbidden_cities"] = F.count_if(F.col("CityName").isin(*FORBIDDEN_CITIES))
    elif table == "dim_countries":
        found["malformed_country_codes"] = F.count_if(~_shaped("CountryCode"))
        wrong = F.lit(0)
        for name, code in CORE_COUNTRY_CODES.items():
            here = F.col("CountryName") == name
            missing = F.when(F.count_if(here) == 0, 1).otherwise(0)
            wrong = wrong + missing + F.count_if(here & ~F.col("CountryCode").eqNullSafe(F.lit(code)))
        found["wrong_country_codes"] = wrong
    elif table == "customer_segments":
        found["customers_segmented"] = F.count("customer_id")  # a customer is one row
    elif table in ("customer_recommendations", "mart_recommend"):
        found["rows_beyond_rank"] = F.count_if(F.col("recommendation_rank") > 10)
        if table == "customer_recommendations":
            found["customers_with_reco"] = F.count_if(F.col("recommendation_rank") == 1)
            found["avg_reco_score"] = F.avg("score")
    return found


# Limits under which a refresh goes on: the most that a measure of a table may be, and tables that need a row.
MOST = {
    ("dim_cities", "forbidden_cities"): 0,
    ("dim_countries", "malformed_country_codes"): 0,
    ("dim_countries", "wrong_country_codes"): 0,
    ("mart_recommend", "rows_beyond_rank"): 0,
    ("customer_recommendations", "rows_beyond_rank"): 0,
}
NOT_EMPTY = ("st_products", "st_sales")


def require_limits(table: str, measured: Mapping[str, float], most: Mapping[tuple[str, str], float] = MOST) -> None:
    """Stop where a measure of ``table`` is beyond its limit, or a table that all depends on has no row."""
    if table in NOT_EMPTY and not measured["rows"]:
        raise ValueError(f"{table} is empty; nothing can be built from it")
    for name, value in measured.items():
        if (limit := most.get((table, name))) is not None and value > limit:
            raise ValueError(f"{table}: {name} is {value}, allowed is {limit}")


def _shaped(code: str) -> Column:
    return F.coalesce(F.col(code).rlike("^[A-Z]{2}$"), F.lit(False))
