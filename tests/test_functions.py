import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark.functions import keys, money


def test_surrogate_key(spark):
    row = spark.createDataFrame([(7, None, "x")], "a int, b int, c string").select(
        keys.surrogate_key("a").alias("one"), keys.surrogate_key("a", "b", "c").alias("three")
    )
    assert row.first().one == hashlib.md5(b"7").hexdigest()
    assert row.first().three == hashlib.md5(b"7-_dbt_utils_surrogate_key_null_-x").hexdigest()


def test_names(spark):
    people = spark.createDataFrame(
        [("Ann", "B", "Lee"), ("Ann", None, "Lee"), (None, "B", "Lee"), ("Ann", "B", None)], "f string, m string, l string"
    )
    rows = people.select(keys.full_name("f", "m", "l").alias("full"), keys.short_name("f", "l").alias("short")).collect()
    assert [r.full for r in rows] == ["Ann B Lee", "Ann  Lee", None, None]
    assert [r.short for r in rows] == ["Ann Lee", "Ann Lee", "Lee", "Ann"]


@pytest.mark.parametrize("text,key", [("  São  Paulo ", "so paulo"), ("St. John's", "st johns"), (None, ""), ("A\tB", "ab")])
def test_text_key(spark, text, key):
    assert spark.createDataFrame([(text,)], "t string").select(keys.text_key(F.col("t")).alias("k")).first().k == key


def test_line_arithmetic(spark):
    row = spark.createDataFrame(
        [(Decimal("12.5000"), 3, Decimal("0.2500"))], "price decimal(18,4), q bigint, d decimal(18,4)"
    ).select(money.line_total(F.col("price"), F.col("q"), F.col("d")).alias("total"), "price", "q")
    row = row.withColumn("profit", money.line_profit(F.col("total"), F.col("price"), F.col("q"))).first()
    assert row.total == Decimal("37.2500")
    assert row.profit == Decimal("37.25") - Decimal("26.25")


@pytest.mark.parametrize(
    "total,units,expected",
    [("10", 4, "2.50"), ("0.05", 2, "0.03"), ("-0.05", 2, "-0.03"), ("10", 3, "3.33"), ("10", 0, None), (None, 3, None)],
)
def test_per_unit_rounds_half_up(spark, total, units, expected):
    frame = spark.createDataFrame([(None if total is None else Decimal(total), units)], "t decimal(28,4), u bigint")
    got = frame.select(money.per_unit(F.col("t"), F.col("u")).alias("x")).first().x
    assert got == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize("part,whole,expected", [("1", "3", "33.33"), ("1", "8", "12.50"), ("2", "3", "66.67"), ("1", "0", None)])
def test_percent(spark, part, whole, expected):
    frame = spark.createDataFrame([(Decimal(part), Decimal(whole))], "p decimal(34,5), w decimal(28,4)")
    got = frame.select(money.percent(F.col("p"), F.col("w")).alias("x")).first().x
    assert got == (None if expected is None else Decimal(expected))


def test_exact_avg_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(None,), (None,)], "x decimal(18,4)")
    assert frame.agg(money.exact_avg("x").alias("a")).first().a is None
