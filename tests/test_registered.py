"""Every registered query against its SQL, and properties of the plans."""

import re

import harness
import pytest
from harness import SMALL

import __spark_entry__ as contract
from tillmark.checks import reference_sql
from tillmark.plans import catalog

QUERIES = catalog.queries()
SQL = reference_sql.statements()
WITHOUT_SQL = {"als_recommendations", "customer_recommendations"}


def test_every_query_has_sql_but_the_factorisation():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    assert harness.difference(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


def test_harness_sees_a_changed_value(spark, duck):
    changed = SQL["scorecards"].replace("sum(total_profit) as double) as", "sum(total_profit) + 1 as double) as")
    assert changed != SQL["scorecards"]
    assert "total_profit" in harness.difference(QUERIES["scorecards"](spark, SMALL), duck, changed)


def test_entry_returns_ten_customers(spark):
    assert contract.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_plan_has_no_product_of_tables_and_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan


def test_scan_reads_only_what_is_needed(spark, workspace):
    plan = workspace.st_sales.where("year = 1998").select("customer_id")._jdf.queryExecution().toString()
    orders = next(s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "o_orderkey" in s)
    assert set(re.findall(r"(\w+):", orders)) == {"o_orderkey", "o_custkey", "o_orderdate"}
    assert "l_extendedprice" not in plan.split("Physical Plan")[1]


def test_recommendation_lookup_reaches_one_customer(spark):
    """The filter on the customer passes the ranking windows."""
    plan = QUERIES["recommendations_of_customer"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey,123" in plan.replace(" ", "")
