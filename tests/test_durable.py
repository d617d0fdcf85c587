"""Where intermediate tables go, and that they go."""

import os

import pytest

from tillmark.operators import durable
from tillmark.plans import catalog


class _Conf(dict):
    pass


class _Session:
    """The settings of a session, no more."""

    def __init__(self, **settings):
        own = _Conf({k.replace("_", "."): v for k, v in settings.items()})
        self.conf = self
        self.sparkContext = type("Context", (), {"getConf": lambda _: own})()
        self.get = own.get


def test_shared_folder():
    named = _Session(spark_checkpoint_dir="hdfs://x/y/", spark_master="spark://h:1")
    assert durable.shared_folder(named) == "hdfs://x/y"
    shared = _Session(spark_sql_warehouse_dir="s3a://w", spark_master="spark://h:1")
    assert durable.shared_folder(shared) == "s3a://w/tillmark"
    assert durable.shared_folder(_Session(spark_sql_warehouse_dir="file:/w", spark_master="local[4]")) == "file:/w/tillmark"
    for place in ("file:/w", "/w", "spark-warehouse"):
        with pytest.raises(RuntimeError):
            durable.shared_folder(_Session(spark_sql_warehouse_dir=place, spark_master="spark://h:1"))


def test_a_query_leaves_nothing_after_release(spark):
    folder = durable.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with durable.scratch(spark):
        for name in ("hot_sellers", "curated_sales", "customer_lifetime_value"):
            catalog.queries()[name](spark, "/root/testdata/sf0.001").count()
        assert set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) <= before
