"""Session settings the builders are tuned for.

Only runtime SQL settings are touched, so an existing session can be tuned in place.  The number of tasks after a
shuffle follows the data: every shuffle is cut into many small parts, and adaptive execution puts neighbours together
up to ``MOST_A_TASK`` and splits skewed ones, so that the memory of a task does not grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A star join is followed by a grouping; without this a skewed join side is left whole whenever splitting it
    # would cost that grouping one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Parts of a shuffle before they are put together, and the most bytes (compressed, as shuffled) that one task is given of
# them: sorted and hashed rows take some thirty times as much.
LEAST_PARTS, MOST_A_TASK = 1000, 32 << 20


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    parts, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    named = spark.conf.get(parts, None) or spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(parts, max(LEAST_PARTS, int(named)))
    spark.conf.set(size, f"{min(MOST_A_TASK, _bytes(spark, spark.conf.get(size)))}b")
    return spark


def _bytes(spark: SparkSession, text: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def local_session(cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillmark")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column costs more than small queries take to run.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
