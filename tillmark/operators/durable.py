"""Cutting lineage: intermediate tables in the folder that the cluster shares, and their removal."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, else one in the warehouse.

    A warehouse on the driver's own disk serves a local session only: on a cluster it is refused.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own_disk = warehouse.startswith(("file:", "/")) or ":" not in warehouse
    if own_disk and not conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/tillmark"


def fresh_place(spark: SparkSession) -> str:
    """A new place in the shared folder, which ``scratch`` or ``release`` removes."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _written.append(path)
    return path


@contextmanager
def run_once(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is run inside go when it is done, as its plan is not run again.

    Otherwise they stay until the driver's garbage collector comes upon them, and a refresh fills the disks with them.
    """
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        yield
    finally:
        spark.conf.unset(cleanup) if before is None else spark.conf.set(cleanup, before)


def checkpointed(df: DataFrame, codec: str | None = "zstd") -> DataFrame:
    """``df`` computed now, written once to the shared folder, and read from there from then on.

    ``codec`` packs the files; None leaves that to the session.
    This runs a job, so a function that calls it is not lazy.  The files stay until ``scratch`` or ``release`` removes
    them: whatever reads the result must have been stored by then.
    """
    path = fresh_place(df.sparkSession)
    with run_once(df.sparkSession):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int = 0) -> None:
    """Remove the intermediate tables written since the ``since``-th."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    while len(_written) > since:
        path = hadoop.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are gone afterwards, also where the work inside fails."""
    since = len(_written)
    try:
        yield
    finally:
        release(spark, since)


def iteration_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their own lineage in the shared folder too."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
