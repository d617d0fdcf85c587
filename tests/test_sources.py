from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark.sources import readers, schemas, sinks


def test_table_names():
    assert readers.table_name("/in/daily-sales.csv") == "daily_sales"
    assert readers.table_name("products.csv") == "products"
    assert [readers.table_name(f"{s}.csv") for s in schemas.SEEDS] == [None, None, None]


def test_csv_load_skips_the_header_and_survives_bad_values(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(
        "SalesID,SalesPersonID,CustomerID,ProductID,Quantity,Discount,TotalPrice,SalesDate,TransactionNumber\n"
        "1,2,3,4,5,0.10,12.5,2001-02-03 04:05:06,T1\n"
        "2,2,x,4,,0.10,,,T2\n"
    )
    table, frame = readers.load_raw(spark, str(tmp_path / "sales.csv"))
    assert table == "sales" and frame.schema == schemas.struct(schemas.RAW["sales"])
    first, second = frame.orderBy("SalesID").collect()
    assert first.Discount == Decimal("0.1000") and str(first.SalesDate) == "2001-02-03 04:05:06"
    assert (second.CustomerID, second.Quantity, second.TotalPrice, second.SalesDate) == (None, None, None, None)


def test_csv_load_of_other_tables_infers_and_seeds_are_skipped(spark, tmp_path):
    (tmp_path / "store-visits.csv").write_text("id,n\n1,2\n")
    (tmp_path / "cities.csv").write_text("CityID,CityName,Zipcode,CountryID\n1,Dayton,00563,32\n")
    table, frame = readers.load_raw(spark, str(tmp_path / "store-visits.csv"))
    assert table == "store_visits" and [tuple(r) for r in frame.collect()] == [(1, 2)]
    assert readers.load_raw(spark, str(tmp_path / "cities.csv")) is None
    assert [tuple(r) for r in readers.load_seed(spark, str(tmp_path), "cities").collect()] == [(1, "Dayton", "00563", 32)]


def test_curated_sales_first_then_raw(spark, workspace, tmp_path):
    raw = str(tmp_path / "raw")
    workspace.source("sales").limit(5).write.parquet(raw)
    curated = str(tmp_path / "curated")
    assert readers.sales_source(spark, curated, raw).count() == 5
    workspace.st_sales.limit(3).write.parquet(curated)
    found = readers.sales_source(spark, curated, raw)
    assert found.count() == 3 and found.columns == list(readers.SALES_LINE_COLUMNS)
    spark.range(1).write.mode("overwrite").parquet(curated)  # lacks the columns
    assert readers.sales_source(spark, curated, raw).count() == 5


def test_missing_lookups(spark, workspace):
    assert readers.empty(spark, schemas.CUSTOMER_LABELS).columns == ["customer_id", "customer_name"]
    with pytest.raises(ValueError, match="products is empty"):
        readers.require_rows(readers.empty(spark, schemas.PRODUCT_LABELS), "products")
    unlabelled = readers.product_labels(workspace.source("products"), None)
    assert unlabelled.where("category_name is not null").isEmpty()
    assert readers.require_rows(unlabelled, "products") is unlabelled


def test_upsert(spark):
    ddl = "k bigint, v string"
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], ddl)
    batch = spark.createDataFrame([(2, "new"), (3, "new"), (None, "new")], ddl)
    once = sinks.upsert(target, batch, "k")
    want = {(1, "old"), (2, "new"), (3, "new"), (None, "new")}
    assert {tuple(r) for r in once.collect()} == want and once.count() == 4
    again = sinks.upsert(once, batch, "k")
    assert {tuple(r) for r in again.collect()} == want and again.count() == 4


def test_write_replaces_the_table(spark, tmp_path):
    place = str(tmp_path / "t")
    assert sinks.write_table(spark.range(5), place).count() == 5
    assert sinks.write_table(spark.range(3).withColumn("p", F.col("id") % 2), place, ("p",)).count() == 3
    replaced = sinks.drop_and_write(spark.range(2).select(F.col("id").cast("string").alias("other")), place)
    assert replaced.columns == ["other"]


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tillmark_test LOCATION '{tmp_path}/db'")
    assert sinks.database(spark, "tillmark_test") == "tillmark_test"
    try:
        assert sinks.drop_and_write(spark.range(4), "tillmark_test.t").count() == 4
        other = spark.range(2).select(F.col("id").cast("string").alias("other"))
        assert sinks.drop_and_write(other, "tillmark_test.t").columns == ["other"]
    finally:
        spark.sql("DROP DATABASE tillmark_test CASCADE")


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "products.csv").write_text(
        "ProductName,ProductID,Price,CategoryID,Class,ModifyDate,Resistant,IsAllergic,VitalityDays,Extra\n"
        "Tea,7,1.5,2,Low,2001-01-01 00:00:00,Durable,False,3,x\n"
    )
    (folder / "cities.csv").write_text("CityID,CityName,Zipcode,CountryID\n1,Dayton,00563,32\n")
    (folder / "store-visits.csv").write_text("id\n1\n")
    found = readers.load_folder(spark, str(folder))
    assert sorted(found) == ["products", "store_visits"]
    assert (found["products"].first().ProductID, found["products"].first().ProductName) == (7, "Tea")
    target = str(tmp_path / "out")
    sinks.replace_raw(spark, str(folder), target)
    (folder / "store-visits.csv").write_text("id\n2\n3\n")
    again = sinks.replace_raw(spark, str(folder), target)
    assert again["store_visits"].count() == 2 and spark.read.parquet(f"{target}/products").count() == 1
    (folder / "products.csv").write_text("ProductID,ProductName\n7,Tea\n")
    with pytest.raises(ValueError, match="Price"):
        readers.load_folder(spark, str(folder))


def test_upsert_touches_only_some_partitions(spark, tmp_path):
    place, ddl = str(tmp_path / "t"), "k string, year int, v int"
    sinks.write_table(spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 3, 1), ("d", 3, 1)], ddl), place, ("year",))
    before = {f.name for f in (tmp_path / "t" / "year=3").iterdir()}
    # b moves to another partition and leaves an empty one; e is new.
    batch = spark.createDataFrame([("b", 1, 2), ("e", 1, 2)], ddl)
    after = sinks.upsert_partitions(place, batch, ("k",), ("year",))
    assert sorted((r.k, r.year, r.v) for r in after.collect()) == [("a", 1, 1), ("b", 1, 2), ("c", 3, 1), ("d", 3, 1), ("e", 1, 2)]
    assert {f.name for f in (tmp_path / "t" / "year=3").iterdir()} == before
    with pytest.raises(ValueError, match="repeats"):
        sinks.upsert_partitions(place, batch.union(batch), ("k",), ("year",))


def rows_read(df):
    """Rows that the scan gave on, after row groups were left out."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().get("numOutputRows").get().value()


def test_row_groups_without_a_key_are_not_read(spark, tmp_path):
    ids = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(1).alias("v"))
    # A part for each first digit.  Their ranges part; within a part only the Bloom filter can say that a key is absent.
    parts = ids.withColumn("p", F.col("k").substr(1, 1))
    with_bloom = sinks.write_table(parts.repartition(16, "p"), str(tmp_path / "a"), ("p",), found_by=("k",))
    without = sinks.write_table(parts.repartition(16, "p"), str(tmp_path / "b"), ("p",))
    one = spark.createDataFrame([("7" * 32,)], "k string")  # in the range of a part, but absent
    for table in (with_bloom, without):
        assert sinks.near_keys(table, one, "k").count() == 0
    whole = sinks.write_table(ids.coalesce(1), str(tmp_path / "c"), found_by=("k",))
    plain = sinks.write_table(ids.coalesce(1), str(tmp_path / "d"))
    many = spark.range(20).select(F.concat(F.lit("7"), F.md5(F.col("id").cast("string")).substr(2, 31)).alias("k"))
    many = many.join(ids, "k", "left_anti")
    for absent in (one, many):
        assert rows_read(sinks.near_keys(whole, absent, "k")) == 0 < rows_read(sinks.near_keys(plain, absent, "k"))
    # Ranges alone: the parts that a large batch lies in.
    third = ids.where(F.col("k").startswith("3"))
    found = sinks.near_keys(with_bloom, third, "k", named=10)
    assert rows_read(found) == third.count() == found.count()
    # After an upsert the rewritten part has its filters again.
    after = sinks.upsert_partitions(str(tmp_path / "a"), one.selectExpr("k", "2 as v", "'7' as p"), ("k",), ("p",))
    assert after.count() == 60_001
    assert sinks.near_keys(after, one, "k").collect()[0].v == 2


def test_near_keys_lose_no_row(spark):
    rows = [(None, 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5), ("", 6)]
    target = spark.createDataFrame(rows, "k string, v int")
    for keys in ([], [None], ["b"], ["b", None], ["b", "d"], ["", "d", None], ["x"]):
        batch = spark.createDataFrame([(k,) for k in keys], "k string")
        for named in (0, 1, 9):
            kept = {r.k for r in sinks.near_keys(target, batch, "k", named).collect()}
            assert {k for k, _ in rows if k in keys} <= kept, (keys, named)
            if named == 9:
                assert kept <= set(keys)


def test_models_without_lookups(spark, workspace):
    from tillmark.plans.workspace import Workspace

    space = Workspace({"sales": workspace.source("sales")})
    assert space.product_labels.isEmpty() and space.customer_labels.isEmpty()
    # Without products the curated lines cannot be priced, so the raw ones are read.
    assert not space.model_sales.isEmpty()
