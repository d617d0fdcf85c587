"""Branches that the test tables do not reach, report controls, and a full refresh."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark.operators import durable
from tillmark.plans import facts, marts, reports, segments
from tillmark.plans.workspace import LOAD_TIME, REFRESH_ORDER, Workspace

SALES = (
    "SalesDate timestamp_ntz, CustomerID bigint, ProductID bigint, TotalPrice decimal(18,4), Quantity bigint, "
    "Discount decimal(18,4), TransactionNumber string"
)
DAY = datetime.datetime(2001, 1, 1)


def test_price_repair(spark):
    d = Decimal
    rows = [
        (DAY, 1, 1, None, 2, d("0.5"), "a"),  # missing: 2 * 10 - 0.5
        (DAY, 2, 1, d(0), 1, d("0.5"), "a"),  # zero
        (DAY, 3, 1, d(-4), 1, None, "a"),  # negative, no discount
        (DAY, 4, 1, d(7), 1, d(1), "a"),  # kept
        (DAY, 5, 2, None, 3, d(1), "a"),  # no price: 0 - 1, floored
        (DAY, 6, 9, d(5), 3, d(1), "a"),  # unknown product, kept
        (DAY, 7, 1, None, None, d(1), "a"),  # no quantity: dropped
        (None, 8, 1, d(5), 1, d(1), "a"),
        (DAY, None, 1, d(5), 1, d(1), "a"),
        (DAY, 9, None, d(5), 1, d(1), "a"),
        (DAY, 10, 1, d(5), 1, d(1), None),
    ]
    products = spark.createDataFrame([(1, d(10)), (2, None)], "product_id bigint, product_price decimal(18,4)")
    got = segments.repaired_sales(spark.createDataFrame(rows, SALES), products).collect()
    assert {r.CustomerID: float(r.TotalPrice) for r in got} == {1: 19.5, 2: 9.5, 3: 10.0, 4: 7.0, 5: 0.0, 6: 5.0}


def test_employees_without_sales_and_all_tiers(spark):
    ids = list(range(1, 9))
    revenue = {1: "150000", 2: "100000", 3: "99999.99", 4: "50000", 5: "49999.99", 6: "10000", 7: "9999.99"}
    employees = spark.createDataFrame(
        [(i, f"e{i}", "c", "X" if i < 8 else "Y", "Junior", 3) for i in ids],
        "employee_id bigint, full_name string, city_name string, country_name string, experience_level string, "
        "years_employed int",
    )
    sales = spark.createDataFrame(
        [(i, f"s{i}", 1, 2, Decimal(v), Decimal(0)) for i, v in revenue.items()],
        "salesperson_id bigint, sales_id string, customer_id bigint, quantity bigint, total_price decimal(18,4), "
        "discount decimal(18,4)",
    )
    fact = facts.fct_employee_performance(employees, sales)
    idle = fact.where("employee_id = 8").first()
    assert (idle.total_sales_transactions, idle.unique_customers_served, idle.total_sales_revenue) == (0, 0, None)
    assert idle.revenue_per_transaction is None
    rows = {r.employee_id: r for r in marts.mart_employee_performance(fact).collect()}
    tiers = ["Top Performer"] * 2 + ["Strong Performer"] * 2 + ["Average Performer"] * 2 + ["Development Needed"] * 2
    assert [rows[i].performance_tier for i in ids] == tiers
    assert [rows[i].company_rank for i in ids] == ids
    assert rows[8].pct_country_revenue is None and rows[8].country_rank == 1
    assert sum(rows[i].pct_country_revenue for i in range(1, 8)) == pytest.approx(Decimal(100), abs=Decimal("0.05"))


def test_previous_month_across_the_year_end(spark):
    rows = [(2000, 12, 5, 1), (2001, 1, 7, 2), (2000, 11, 3, 1), (2001, 1, 1, 1)]
    totals = spark.createDataFrame(rows, "year int, month int, total_revenue bigint, total_profit bigint")
    got = {r.year_month: (r.revenue, r.previous_revenue, r.previous_profit) for r in reports.monthly_revenue(totals).collect()}
    assert got == {"2000-11": (3, None, None), "2000-12": (5, 3, 1), "2001-01": (8, 5, 1)}


def test_controls(spark):
    totals = spark.createDataFrame(
        [(2000, 12, 31, "A", "x"), (2001, 1, 1, "B", "x"), (2001, 1, 2, "B", "y")],
        "year int, month int, day int, customer_country string, category_name string",
    )
    day = datetime.date
    assert reports.controls(totals).count() == 3
    assert reports.controls(totals, start=day(2001, 1, 1)).count() == 2
    assert reports.controls(totals, start=day(2000, 12, 31), end=day(2001, 1, 1)).count() == 2
    assert reports.controls(totals, countries=["B"], categories=["x"]).count() == 1
    picks = spark.createDataFrame([(1, r) for r in range(1, 8)] + [(2, 1)], "customer_id bigint, recommendation_rank int")
    assert reports.controls(picks, customer_id=1, max_rank=5).count() == 5


def test_tiles_are_even(workspace):
    sizes = [r["count"] for r in workspace.customer_lifetime_value.groupBy("value_quintile").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_full_refresh(spark, workspace, tmp_path):
    """All tables stored, each built from the stored ones below it, equal to the lazy ones."""
    fresh = Workspace(dict(workspace._sources), as_of=workspace.as_of)
    before = list(durable._written)
    stored = fresh.refresh(str(tmp_path))
    assert durable._written == before  # intermediate tables are gone
    assert list(stored) == list(REFRESH_ORDER)
    for name, frame in stored.items():
        assert (LOAD_TIME.get(name) in frame.columns) == (name in LOAD_TIME)
    for name in ("st_customers", "fct_customer_behavior", "mart_sales_summary", "mart_recommend"):
        plain = stored[name].drop(LOAD_TIME[name])
        lazy = getattr(workspace, name).select(plain.columns)
        assert plain.exceptAll(lazy).isEmpty() and lazy.exceptAll(plain).isEmpty()
    assert stored["customer_recommendations"].where(F.col("model_type") != "ALS").isEmpty()
    # What is asked for later does not need them.
    assert fresh.mart_employee_performance.count() == stored["mart_employee_performance"].count()


def test_repeated_sale_ids_are_counted_once(spark):
    ddl = "sales_id string, customer_id bigint, product_id bigint, quantity bigint, total_price decimal(18,4), discount decimal(18,4), sales_date timestamp_ntz"
    one = Decimal(1)
    unique = spark.createDataFrame([(f"s{i}", i % 2, i % 3, 1, one, one, DAY) for i in range(7)], ddl)
    repeated = unique.unionByName(unique.where("sales_id in ('s1', 's2')"))

    def counts(sales):
        return {r.customer_id: r.purchase_count for r in facts.fct_customer_behavior(sales).collect()}

    assert counts(unique) == counts(repeated) == {0: 4, 1: 3}


def test_a_large_dimension_is_not_broadcast(spark, workspace):
    """Fifty million rows that would pack into few bytes; the plan is looked at, not run."""
    many = spark.range(50_000_000).select(
        F.col("id").alias("customer_id"), *[F.lit("x").alias(c) for c in ("city_name", "country_name", "country_code")]
    )
    fact = facts.fct_sales_summary(workspace.st_sales, workspace.st_products, many, workspace.st_employees)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [customer_id" in plan and "strategy=broadcast" not in fact._jdf.queryExecution().analyzed().toString()


def test_repeated_dimension_rows_through_a_refresh(spark, workspace, tmp_path):
    """A customer and a product that occur twice multiply lines as a plain join does; sales still count once."""
    sources = dict(workspace._sources)
    for name, key in (("customers", "CustomerID"), ("products", "ProductID")):
        own = workspace.source(name)
        sources[name] = own.unionByName(own.where(F.col(key) <= 20))
    space = Workspace(sources, as_of=workspace.as_of)
    wanted = REFRESH_ORDER[: REFRESH_ORDER.index("fct_customer_behavior")]
    stored = space.refresh(str(tmp_path), wanted)
    got = space.sales_totals.groupBy("product_id").agg(F.sum("total_units_sold").alias("units"), F.sum("transaction_count").alias("n"))
    fact, labels = stored["fct_sales_summary"], stored["st_products"].select("product_id", "product_name")
    plain = fact.drop("product_name").join(labels, "product_id", "left").groupBy("product_id", "year", "month", "day", "customer_country", "customer_country_code", "salesperson_country", "product_name")
    plain = plain.agg(F.sum("quantity").alias("u"), F.count_distinct("sales_id").alias("c")).groupBy("product_id")
    want = plain.agg(F.sum("u").alias("units"), F.sum("c").alias("n"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_date_control_prunes_months(spark, workspace, tmp_path):
    from tillmark.sources import sinks

    stored = sinks.write_table(workspace.sales_totals, str(tmp_path / "m"), ("year", "month"))
    start, end = datetime.date(1996, 3, 10), datetime.date(1996, 4, 20)
    kept = reports.controls(stored, start=start, end=end)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "month" in filters.split("PartitionFilters")[1].split("PushedFilters")[0]
    day = F.make_date("year", "month", "day")
    want = stored.where((day >= F.lit(start)) & (day <= F.lit(end)))
    assert kept.count() == want.count() > 0 and kept.exceptAll(want).isEmpty()
