"""What an upsert and a refresh send and leave on disk while they run."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tillmark.operators import durable
from tillmark.plans import facts, recommend
from tillmark.plans.workspace import Workspace
from tillmark.sources import sinks

DDL = "k string, p int, v int"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("most_bits", [4096, sinks.MOST_BITS if hasattr(sinks, "MOST_BITS") else 0])
def test_stored_rows_are_not_stored_aside(spark, tmp_path, monkeypatch, most_bits):
    """Every rewritten row was sent to meet the batch, stored aside, and written again.  With few bits most rows have a
    mark that is not theirs; null keys, and keys that occur twice on either side, are keys like any other."""
    monkeypatch.setattr(sinks, "MOST_BITS", most_bits, raising=False)
    stored, real = [], durable.checkpointed

    def kept(df):
        stored.append(df.columns)
        return real(df)

    monkeypatch.setattr(sinks, "checkpointed", kept)
    table = spark.range(6000).selectExpr("if(id % 500 = 0, null, concat('k', id % 4000)) as k", "int(id % 3) as p", "int(id) as v")
    batch = spark.range(2000).selectExpr("if(id = 7, null, concat('k', id * 3 % 5000)) as k", "int(id % 4) as p", "-1 as v")
    batch = batch.unionByName(batch.limit(5))
    place = str(tmp_path / "t")
    sinks.write_table(table, place, ("p",))
    want = _rows(sinks.upsert(table, batch, "k").select("k", "p", "v"))
    for _ in range(2):  # repeating a batch gives the same table
        got = sinks.upsert_partitions(place, batch, ("k",), ("p",), unique=False)
        assert _rows(got.select("k", "p", "v")) == want
    assert stored and not [columns for columns in stored if "v" in columns]


def test_an_emptied_partition_goes(spark, tmp_path):
    place = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 3, 1)], DDL), place, ("p",))
    moved = spark.createDataFrame([("b", 1, 2)], DDL)
    assert _rows(sinks.upsert_partitions(place, moved, ("k",), ("p",)).select("k", "p", "v")) == [("a", 1, 1), ("b", 1, 2), ("c", 3, 1)]
    assert sorted(f.name for f in (tmp_path / "t").iterdir() if f.name.startswith("p=")) == ["p=1", "p=3"]


def _shuffle_files(spark):
    places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for place in places for _, _, files in os.walk(place) for f in files if f.startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_stored(spark, tmp_path):
    """They stayed until the driver's garbage collector came upon them."""
    before = _shuffle_files(spark)
    with durable.scratch(spark):
        groups = spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).count()
        assert durable.checkpointed(groups).count() == 1000
        sinks.write_table(groups, str(tmp_path / "t"))
    held = time.time() + 20
    while len(_shuffle_files(spark) - before) > 20 and time.time() < held:
        time.sleep(0.2)
    # Those of the count alone are left.
    assert len({f.split("_")[1] for f in _shuffle_files(spark) - before}) <= 1
    assert groups.count() == len(groups.collect()) == len(groups.collect()) == 1000  # what is run again is not touched


def test_intermediate_tables_go_with_their_table(spark, workspace, tmp_path, monkeypatch):
    """Those of every table stayed to the end of the refresh."""
    space, start, held = Workspace(dict(workspace._sources), as_of=workspace.as_of), len(durable._written), {}
    real = sinks.write_table

    def seen(df, target, *args, **kwargs):
        held[target.rsplit("/", 1)[-1]] = set(durable._written[start:])
        return real(df, target, *args, **kwargs)

    monkeypatch.setattr(sinks, "write_table", seen)
    stored = space.refresh(str(tmp_path), ("customer_lifetime_value", "mart_employee_performance"))
    first, second = held.values()
    assert first and second and not first & second
    assert stored["customer_lifetime_value"].count() and space.mart_employee_performance.count()


def test_lines_are_not_sent_for_employees(spark, workspace):
    """The plan did not know how few they are, so the lines were sent with all their labels to meet them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        found = facts.fct_sales_summary(workspace.st_sales, workspace.st_products, workspace.st_customers, workspace.st_employees)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [salesperson_id" in plan and "SortMergeJoin [customer_id" in plan


def test_the_fit_frees_the_shuffles_of_each_iteration(spark, monkeypatch):
    class Seen(Exception):
        pass

    def als(**params):
        raise Seen(params["checkpointInterval"])

    monkeypatch.setattr(recommend, "ALS", als)
    ratings = spark.createDataFrame([(1, 2, 3.0)], "customer_id bigint, product_id bigint, rating double")
    with pytest.raises(Seen, match="1"):
        recommend.als_recommendations(ratings, ratings, ratings)


def test_a_filter_is_as_small_as_its_file(spark, tmp_path):
    """A month of one task has some thousand lines, and had a filter of 64 kB."""
    ids = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("k")).coalesce(1)
    sinks.write_table(ids, str(tmp_path / "a"), found_by=("k",))
    sinks.write_table(ids, str(tmp_path / "b"))
    with_filter, without = (sum(f.stat().st_size for f in (tmp_path / t).glob("*.parquet")) for t in "ab")
    assert 1000 < with_filter - without < 20_000
