"""Lookup tables, dimensions and the sales fact in their cleaned form.

Joins carry no broadcast hint: Spark broadcasts a source table by the size of its files, and one that grows beyond the
threshold falls back to a shuffled join.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions import labels
from tillmark.functions.keys import full_name, surrogate_key
from tillmark.functions.money import line_total, money
from tillmark.sources import schemas
from tillmark.sources.readers import typed


def dim_categories(categories: DataFrame) -> DataFrame:
    return typed(categories, schemas.struct(schemas.SEEDS["categories"]))


def dim_cities(cities: DataFrame) -> DataFrame:
    return typed(cities, schemas.struct(schemas.SEEDS["cities"]))


def dim_countries(countries: DataFrame) -> DataFrame:
    return typed(countries, schemas.struct(schemas.SEEDS["countries"]))


def places(cities: DataFrame, countries: DataFrame) -> DataFrame:
    """City with its country; joined once, for customers and employees alike."""
    return cities.join(countries, "CountryID", "left").select(
        F.col("CityID").alias("_place"),
        F.col("CityName").alias("city_name"),
        F.col("Zipcode").alias("zipcode"),
        F.col("CountryName").alias("country_name"),
        F.col("CountryCode").alias("country_code"),
    )


def with_load_time(df: DataFrame, column: str) -> DataFrame:
    """Load time of a stored table; the builders leave it out, so that their results can be compared."""
    return df.withColumn(column, F.current_timestamp())


def st_customers(customers: DataFrame, cities: DataFrame, countries: DataFrame) -> DataFrame:
    located = customers.join(places(cities, countries), F.col("cityID") == F.col("_place"), "left")
    return located.select(
        surrogate_key("CustomerID").alias("customer_key"),
        F.col("CustomerID").alias("customer_id"),
        full_name("FirstName", "MiddleInitial", "LastName").alias("full_name"),
        F.col("FirstName").alias("first_name"),
        F.col("MiddleInitial").alias("middle_initial"),
        F.col("LastName").alias("last_name"),
        F.col("cityID").alias("city_id"),
        "city_name",
        "zipcode",
        "country_name",
        "country_code",
        F.col("Address").alias("address"),
    )


def st_employees(
    employees: DataFrame, cities: DataFrame, countries: DataFrame, as_of: datetime.date | None = None
) -> DataFrame:
    """``years_employed`` is the difference of the calendar years only.  ``as_of`` defaults to today."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    years = F.year(today) - F.year("HireDate")
    located = employees.join(places(cities, countries), F.col("CityID") == F.col("_place"), "left")
    return located.select(
        surrogate_key("EmployeeID").alias("employee_key"),
        F.col("EmployeeID").alias("employee_id"),
        full_name("FirstName", "MiddleInitial", "LastName").alias("full_name"),
        F.col("FirstName").alias("first_name"),
        F.col("MiddleInitial").alias("middle_initial"),
        F.col("LastName").alias("last_name"),
        F.col("BirthDate").alias("birth_date"),
        F.col("Gender").alias("gender"),
        F.col("CityID").alias("city_id"),
        "city_name",
        "zipcode",
        "country_name",
        "country_code",
        F.col("HireDate").alias("hire_date"),
        years.alias("years_employed"),
        labels.experience_level(years).alias("experience_level"),
    )


def st_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """A product without a price is labelled like the most expensive ones."""
    return products.join(categories, "CategoryID", "left").select(
        surrogate_key("ProductID").alias("product_key"),
        F.col("ProductID").alias("product_id"),
        F.col("ProductName").alias("product_name"),
        money("Price").alias("price"),
        F.col("CategoryID").alias("category_id"),
        F.col("CategoryName").alias("category_name"),
        F.col("Class").alias("class"),
        F.col("ModifyDate").alias("modify_date"),
        F.col("Resistant").alias("resistant"),
        F.col("IsAllergic").alias("is_allergic"),
        F.col("VitalityDays").alias("vitality_days"),
        labels.price_category(F.col("Price")).alias("price_category"),
    )


def calendar(time: str) -> list[Column]:
    """The calendar fields of a sale."""
    return [
        F.year(time).alias("year"),
        F.month(time).alias("month"),
        F.dayofmonth(time).alias("day"),
        F.dayofweek(time).alias("day_of_week"),
    ]


def st_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Dated sale lines with their value; the product price is the only thing taken from the product table."""
    prices = products.select(F.col("ProductID").alias("_product"), F.col("Price").alias("_price"))
    dated = sales.where(F.col("SalesDate").isNotNull())
    return dated.join(prices, F.col("ProductID") == F.col("_product"), "left").select(
        F.col("SalesID").cast("string").alias("sales_id"),
        F.col("SalesPersonID").alias("salesperson_id"),
        F.col("CustomerID").alias("customer_id"),
        F.col("ProductID").alias("product_id"),
        F.col("Quantity").alias("quantity"),
        money("Discount").alias("discount"),
        line_total(F.col("_price"), F.col("Quantity"), F.col("Discount")).alias("total_price"),
        F.col("SalesDate").alias("sales_date"),
        F.col("TransactionNumber").alias("transaction_number"),
        *calendar("SalesDate"),
    )
