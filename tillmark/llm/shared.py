"""Folders, tables and row keys used by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.durable import checkpointed

# A-Z as SQL and every Spark function see them; other letters keep their case in all contracts.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def folded(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there: cuts lineage and survives lost executors.

    The files go with ``tillmark.operators.durable.scratch`` or ``release``.
    """
    return checkpointed(df, codec=None)


def text_key(text: Column) -> Column:
    """A null and an empty text are told apart by no operator."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
