"""Batches that repeat an id, and dimension rows that occur twice."""

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tillmark.plans.workspace import LOAD_TIME, Workspace

DAY = datetime.datetime(2001, 1, 1)
TABLES = (
    "dim_categories", "dim_cities", "dim_countries", "st_customers", "st_employees", "st_products", "st_sales",
    "fct_sales_summary", "customer_lifetime_value", "mart_sales_summary",
)


def _sources(spark, sales):
    def rows(values, ddl):
        return spark.createDataFrame(values, ddl)

    day = DAY.date()
    return {
        "sales": sales,
        "products": rows(
            [(p, f"p{p}", Decimal(10), 1, "Low", DAY, "Durable", "False", 1.0) for p in (1, 1, 2)],
            "ProductID bigint, ProductName string, Price decimal(18,4), CategoryID bigint, Class string, "
            "ModifyDate timestamp_ntz, Resistant string, IsAllergic string, VitalityDays double",
        ),
        "customers": rows(
            [(c, "F", "M", f"c{c}", 1, "a") for c in (1, 2, 2, 3, 3)],
            "CustomerID bigint, FirstName string, MiddleInitial string, LastName string, cityID bigint, Address string",
        ),
        "employees": rows(
            [(1, "F", "M", "e", day, "F", 1, day)],
            "EmployeeID bigint, FirstName string, MiddleInitial string, LastName string, BirthDate date, "
            "Gender string, CityID bigint, HireDate date",
        ),
        "categories": rows([(1, "k")], "CategoryID bigint, CategoryName string"),
        "cities": rows([(1, "x", "1", 1)], "CityID bigint, CityName string, Zipcode string, CountryID bigint"),
        "countries": rows([(1, "X", "XX")], "CountryID bigint, CountryName string, CountryCode string"),
    }


def test_an_upsert_takes_all_rows_of_a_repeated_id(spark, tmp_path):
    zero = Decimal(0)
    ddl = (
        "SalesID bigint, SalesPersonID bigint, CustomerID bigint, ProductID bigint, Quantity bigint, "
        "Discount decimal(18,4), TotalPrice decimal(18,4), SalesDate timestamp_ntz, TransactionNumber string"
    )
    lines = [(i, 1, i % 3 + 1, i % 2 + 1, 1, zero, Decimal(5), DAY, f"t{i}") for i in range(12)]
    sales = spark.createDataFrame(lines + lines[:4], ddl)
    batch = sales.where("CustomerID = 2").withColumn("Quantity", F.col("Quantity") + 3)
    assert batch.count() > batch.select("SalesID").distinct().count()
    day = datetime.date(2001, 12, 31)
    space = Workspace(_sources(spark, sales), as_of=day)
    space.refresh(str(tmp_path), TABLES)
    stored = space.upsert_sales(str(tmp_path), batch)
    after = Workspace(_sources(spark, sales.where("CustomerID <> 2").unionByName(batch)), as_of=day)
    for name in ("st_sales", "fct_sales_summary", "customer_lifetime_value", "mart_sales_summary"):
        got = stored[name].drop(*([LOAD_TIME[name]] if name in LOAD_TIME else []))
        want = getattr(after, name).select(got.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name
