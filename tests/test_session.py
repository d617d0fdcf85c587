"""The number of tasks after a shuffle follows the data."""

from pyspark.sql import functions as F

from tillmark import session


def test_a_task_is_given_no_more_than_so_many_bytes(spark, monkeypatch):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    session.tune(spark)
    before = spark.conf.get(size)
    monkeypatch.setattr(session, "MOST_A_TASK", 2 << 20)
    try:
        session.tune(spark)
        groups = spark.range(600_000).groupBy(F.md5(F.col("id").cast("string")).alias("k")).count()
        # Some 20 MB, and four shuffle partitions.
        assert groups._jdf.queryExecution().toRdd().getNumPartitions() > 4 == int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(size, "1m")  # what the cluster sets lower stays
        session.tune(spark)
        assert spark.conf.get(size) == f"{1 << 20}b"
    finally:
        spark.conf.set(size, before)
