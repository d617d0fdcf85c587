"""Schemas of the source tables, stated instead of inferred."""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY_DDL = "decimal(18,4)"

RAW = {
    "sales": (
        f"SalesID bigint, SalesPersonID bigint, CustomerID bigint, ProductID bigint, Quantity bigint, "
        f"Discount {MONEY_DDL}, TotalPrice {MONEY_DDL}, SalesDate timestamp_ntz, TransactionNumber string"
    ),
    "products": (
        f"ProductID bigint, ProductName string, Price {MONEY_DDL}, CategoryID bigint, Class string, "
        "ModifyDate timestamp_ntz, Resistant string, IsAllergic string, VitalityDays double"
    ),
    "customers": (
        "CustomerID bigint, FirstName string, MiddleInitial string, LastName string, cityID bigint, Address string"
    ),
    "employees": (
        "EmployeeID bigint, FirstName string, MiddleInitial string, LastName string, BirthDate date, "
        "Gender string, CityID bigint, HireDate date"
    ),
}

# Zip codes stay text: leading zeros are part of them.
SEEDS = {
    "categories": "CategoryID bigint, CategoryName string",
    "cities": "CityID bigint, CityName string, Zipcode string, CountryID bigint",
    "countries": "CountryID bigint, CountryName string, CountryCode string",
}

# Typed empty frames that stand in for lookups that are missing.
PRODUCT_LABELS = (
    f"product_id bigint, product_name string, category_id bigint, category_name string, product_price {MONEY_DDL}"
)
CUSTOMER_LABELS = "customer_id bigint, customer_name string"


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
