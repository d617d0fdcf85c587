"""What is sent between tasks: rows once, and no more of them than a step needs."""

import datetime
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from tillmark.operators import baskets, durable, ranking
from tillmark.plans import facts, marts, recommend
from tillmark.sources import sinks

FACT = (
    "year int, month int, day int, customer_country string, customer_country_code string, salesperson_country string, "
    "product_id bigint, sales_id string, customer_id bigint, salesperson_id bigint, quantity bigint, "
    "total_price decimal(18,4), estimated_profit decimal(24,5), discount decimal(18,4)"
)
PRODUCTS = "product_id bigint, product_name string, category_name string, class string, price_category string"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def totals(spark):
    here, money = (2001, 1, 2, "A", "AA", "B"), [Decimal(n) for n in (4, 1, 0)]
    rows = [
        (*here, 1, "s1", 7, 9, 1, *money),
        (*here, 1, "s1", 7, 9, 1, *money),  # the same sale again
        (*here, 1, "s2", None, 9, 1, *money),
        (*here, 1, None, 8, None, 1, *money),
        (*here, None, None, None, None, 1, *money),
        (*here, None, None, None, None, None, None, None, None),
        (2001, 1, 3, None, None, None, 1, "s1", 7, 9, 1, *money),  # another day, places unknown
    ]
    products = [(1, "p", "c", "x", "y"), (1, "p", "c", "x", "y")]
    return marts.sales_totals(spark.createDataFrame(rows, FACT), spark.createDataFrame(products, PRODUCTS))


def test_different_ids_are_counted_without_copies_of_the_lines(spark):
    found = totals(spark)
    assert "Expand" not in plan(found)
    counts = {
        (r.day, r.product_id): (r.transaction_count, r.unique_customers, r.unique_salespeople, r.unique_products, r.total_units_sold)
        for r in found.collect()
    }
    assert counts == {(2, 1): (2, 2, 1, 1, 8), (2, None): (0, 0, 0, 0, 1), (3, 1): (1, 1, 1, 1, 2)}


def test_rows_are_ranked_without_what_follows_from_them(spark, monkeypatch):
    stored = []

    def kept(df):
        stored.append(df.columns)
        return df.localCheckpoint()

    monkeypatch.setattr(ranking, "checkpointed", kept)
    rows = totals(spark)
    ranked = marts.mart_sales_summary(rows)
    assert not {c for columns in stored for c in columns} & {"day_name", "quarter", "units_per_customer"}
    assert ranked.columns == [*rows.columns, "monthly_hot_selling_product_rank", "monthly_category_revenue_rank"]
    assert ranked.select(*rows.columns).exceptAll(rows).isEmpty() and ranked.count() == rows.count()
    weekday = F.dayofweek(F.lit(datetime.date(2001, 1, 2)))
    assert ranked.where("day = 2").where(F.col("day_of_week") == weekday).count() == 2


LINES = (
    "SalesDate timestamp_ntz, CustomerID bigint, ProductID bigint, TotalPrice decimal(18,4), Quantity bigint, "
    "Discount decimal(18,4), TransactionNumber string"
)


def test_the_fallback_reads_sales_once_and_stores_what_it_reads_again(spark, monkeypatch):
    """Sales were built twice, and all partners and purchases were sent to meet the few anchors that are left open."""
    stored = []

    def kept(df):
        stored.append(df.columns)
        return df.localCheckpoint()

    monkeypatch.setattr(recommend, "checkpointed", kept)
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    day, one = datetime.datetime(2001, 1, 1), Decimal(1)
    rows = [(day, c, (c * 7 + 3 * k) % 40, one, 1, one, f"{c}-{k % 4}") for c in range(12) for k in range(16)]
    sales = spark.createDataFrame(rows, LINES).mapInArrow(seen, LINES)
    products = spark.range(40).selectExpr("id as product_id", "'p' as product_name", "id % 3 as category_id", "'c' as category_name")
    customers = spark.range(12).selectExpr("id as customer_id", "'n' as customer_name")
    found = recommend.heuristic_recommendations(sales, products, customers)
    assert found.count() == 120
    assert reads.value == len(rows)
    assert any("_band" in columns for columns in stored)
    owned = {(r[1], r[2]) for r in rows}
    assert not owned & {(r.customer_id, r.product_id) for r in found.collect()}


def test_items_of_short_baskets_do_not_carry_their_size(spark):
    """Every item was joined with the size of its basket, to learn that hardly any basket is long."""
    items = spark.createDataFrame([("a", 1, 1, 2), ("a", 2, 1, 3), ("b", 1, 1, 1)], "basket string, product long, lines long, units long")
    short, long = baskets._by_size(items, tile=2)
    assert long is None and short.columns == items.columns and "Join" not in plan(short)
    short, long = baskets._by_size(items, tile=1)
    assert [r.basket for r in short.collect()] == ["b"] and {(r.product, r._size) for r in long.collect()} == {(1, 2), (2, 2)}


def test_short_baskets_are_not_counted_one_by_one(spark, monkeypatch):
    """All baskets were sent to be counted, though bins of them already hold fewer items than a long one."""
    stored = []

    def kept(df):
        stored.append(df.columns)
        return df.localCheckpoint()

    monkeypatch.setattr(baskets, "checkpointed", kept)
    items = spark.range(6000).selectExpr("concat('b', id div 2) as basket", "id as product", "1L as lines", "1L as units")
    short, long = baskets._by_size(items, tile=2000)
    assert long is None and stored == [["_bin"]] and short.count() == 6000
    one = spark.range(900).selectExpr("'hot' as basket", "id as product", "1L as lines", "1L as units")
    short, long = baskets._by_size(items.unionByName(one), tile=800)
    assert short.count() == 6000 and {tuple(r) for r in long.select("basket", "_size").distinct().collect()} == {("hot", 900)}
    assert baskets._by_size(items.where("product < 0"), tile=800)[1] is None


def test_a_pair_is_sent_once_and_to_its_anchor(spark, monkeypatch):
    """Pairs were sent to be added up, and then once more, both ways, to their anchors."""
    items = spark.range(600).selectExpr("concat('b', id div 4) as basket", "id % 50 as product", "1L as lines").localCheckpoint()
    depths = spark.range(50).selectExpr("id as anchor", "10L as depth").localCheckpoint()

    def exchanges():
        steps = baskets.partner_lists(items, depths)._jdf.queryExecution().executedPlan().toString()
        return [step for step in steps.split("Initial Plan")[-1].splitlines() if "Exchange hashpartitioning" in step]

    sent = exchanges()
    assert len([s for s in sent if "(anchor" in s]) == 1 and len([s for s in sent if "(_bin" in s]) == 1 and len(sent) == 2
    # A product with so many rows that no single task is to add up its partners.
    monkeypatch.setattr(baskets, "MOST_A_PRODUCT", 11)
    assert [s for s in exchanges() if "low" in s and "high" in s]


def test_stored_tables_are_packed_by_zstd(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(durable, "fresh_place", lambda spark: f"{tmp_path}/t")
    durable.checkpointed(spark.range(10))
    assert list((tmp_path / "t").glob("*.zstd.parquet"))
    monkeypatch.setattr(durable, "fresh_place", lambda spark: f"{tmp_path}/u")
    durable.checkpointed(spark.range(10), codec=None)
    assert list((tmp_path / "u").glob("*.parquet")) and not list((tmp_path / "u").glob("*.zstd.parquet"))


def test_bought_lines_are_folded_and_a_purchase_is_marked_once(spark):
    day, one = datetime.datetime(2001, 1, 1), Decimal(1)
    keys = [(1, 5, "x"), (1, 5, "x"), (1, 5, "y"), (1, 6, "x"), (2, 5, "x"), (None, 5, "x"), (None, 5, "z"), (1, None, None), (1, None, None)]
    lines = spark.createDataFrame([(day, c, p, one, 1, one, t) for c, p, t in keys], LINES)
    rows = recommend._bought(lines).collect()
    counts = Counter(keys)
    assert {(r.customer_id, r.product_id, r.basket): r.lines for r in rows} == counts and len(rows) == len(counts)
    assert Counter((r.customer_id, r.product_id) for r in rows if r.first) == Counter({k[:2] for k in keys})


def test_a_purchase_and_its_offers_are_one_row_on_the_way_to_the_customer(spark, monkeypatch):
    """The purchase and each of three offers were rows of their own; items were stored a second time."""
    stored = {}

    def kept(df):
        stored[tuple(df.columns)] = plan(df)
        return df.localCheckpoint()

    for module in (recommend, baskets):
        monkeypatch.setattr(module, "checkpointed", kept)
    day, one = datetime.datetime(2001, 1, 1), Decimal(1)
    rows = [(day, c, (c * 7 + 3 * k) % 40, one, 1, one, f"{c}-{k % 4}") for c in range(12) for k in range(16)]
    products = spark.range(40).selectExpr("id as product_id", "'p' as product_name", "id % 3 as category_id", "'c' as category_name")
    customers = spark.range(12).selectExpr("id as customer_id", "'n' as customer_name")
    assert recommend.heuristic_recommendations(spark.createDataFrame(rows, LINES), products, customers).count() == 120
    assert not [c for c in stored if "product" in c or "Quantity" in c]
    judged = next(p for c, p in stored.items() if "_first" in c)
    above, sent = judged.split("RepartitionByExpression [customer_id", 1)
    assert "Generate" in above and "Union" not in judged and "Generate" not in sent.split("Aggregate")[0]
    # Anchors that are not asked for more are left out before partners are sent.
    assert ("anchor",) in stored and "LeftSemi" in stored["customer_id", "product_id", "score"]


def test_lines_carry_no_id_through_the_join_with_their_orders(workspace):
    """An id of its own for every line was sent only to learn whether the line is dated."""
    below = plan(workspace.model_sales.select("CustomerID", "ProductID", "TransactionNumber")).split("Join Inner", 1)[1]
    assert "_dated" in below and "AS SalesID" not in below


def test_the_fact_carries_no_calendar_through_its_joins(workspace):
    found = facts.fct_sales_summary(workspace.st_sales, workspace.st_products, workspace.st_customers, workspace.st_employees)
    top, *below = plan(found).splitlines()
    assert "AS day_of_week" in top and not any("AS day_of_week" in line or "AS month" in line for line in below)


def test_stored_tables_are_packed(spark, tmp_path):
    sinks.write_table(spark.range(3), f"{tmp_path}/t", found_by=("id",))
    assert [p.name for p in (tmp_path / "t").glob("*.parquet")] and all(".zstd." in p.name for p in (tmp_path / "t").glob("*.parquet"))
