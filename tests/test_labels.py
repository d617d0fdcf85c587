"""Every branch of the classification rules, nulls included."""

import itertools

import pytest
from pyspark.sql import functions as F

from tillmark.functions import labels


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def number(value, kind="double"):
    return F.lit(value).cast(kind)


CASES = [
    (labels.price_category, {4.99: "Budget", 5: "Standard", 14.99: "Standard", 15: "Premium", 49.99: "Premium",
                             50: "Luxury", 0: "Budget", None: "Luxury"}),
    (labels.experience_level, {12: "Senior", 10: "Senior", 9: "Mid-level", 5: "Mid-level", 4: "Junior", None: "Junior"}),
    (labels.value_segment, {50: "High Value", 49: "Medium Value", 20: "Medium Value", 19: "Low Value", None: "Low Value"}),
    (labels.engagement_status, {0: "Active", 30: "Active", 31: "At Risk", 90: "At Risk", 91: "Dormant", None: "Dormant"}),
    (labels.value_tier, {1: "Most Valuable", 2: "High Value", 3: "Mid Value", 4: "Low Value", 5: "Emerging",
                         None: "Emerging"}),
    (labels.performance_tier, {100000: "Top Performer", 99999.99: "Strong Performer", 50000: "Strong Performer",
                               49999.99: "Average Performer", 10000: "Average Performer",
                               9999.99: "Development Needed", None: "Development Needed"}),
    (labels.recommendation_priority, {1: "High Priority", 2: "Medium Priority", 3: "Medium Priority",
                                      4: "Low Priority", None: "Low Priority"}),
    (labels.day_name, {1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday", 5: "Thursday", 6: "Friday",
                       7: "Saturday", 8: None, None: None}),
    (labels.season, {12: "Q1", 1: "Q1", 2: "Q1", 3: "Q2", 4: "Q2", 5: "Q2", 6: "Q3", 7: "Q3", 8: "Q3", 9: "Q4",
                     10: "Q4", 11: "Q4", None: "Q4"}),
]


@pytest.mark.parametrize("rule,expected", CASES, ids=[c[0].__name__ for c in CASES])
def test_limits(spark, rule, expected):
    values = list(expected)
    frame = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: r.label for r in frame.select("i", rule(F.col("v")).alias("label")).collect()}
    assert got == {i: expected[v] for i, v in enumerate(values)}


def mart(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if r >= 4 and f >= 3:
        return "Loyal Customers"
    if r == 5 and f <= 2:
        return "New Customers"
    if r in (3, 4) and m >= 4:
        return "Potential Loyalists"
    return lapsed(r, f, m)


def lapsed(r, f, m):
    if r <= 2 and f >= 4 and m >= 4:
        return "At Risk High Value"
    return "Hibernating" if r <= 2 and f <= 2 else "Needs Attention"


def model(r, f, m):
    label = mart(r, f, m)
    return lapsed(r, f, m) if label == "Potential Loyalists" else label


def action(r, f, m):
    if r <= 2 and m >= 4:
        return "Win-back premium offers"
    if r >= 4 and f >= 4:
        return "VIP retention and loyalty rewards"
    if r == 5 and f <= 2:
        return "Welcome and first-repeat incentives"
    return "Bundle and cross-sell campaigns" if f >= 4 and m in (2, 3) else "General nurture campaigns"


def test_every_score_combination(spark):
    grid = list(itertools.product(range(1, 6), repeat=3))
    scores = [F.col(c) for c in "rfm"]
    rows = spark.createDataFrame(grid, "r int, f int, m int").select(
        "r", "f", "m",
        labels.mart_segment(*scores).alias("mart"),
        labels.model_segment(*scores).alias("model"),
        labels.marketing_action(*scores).alias("action"),
        labels.score_text(*scores).alias("text"),
        labels.segment_number(labels.model_segment(*scores)).alias("number"),
    ).collect()
    numbers = {"Champions": 5, "Loyal Customers": 4, "New Customers": 3, "Needs Attention": 2, "At Risk High Value": 1,
               "Hibernating": 0}
    assert len(rows) == 125
    for row in rows:
        key = (row.r, row.f, row.m)
        assert row.mart == mart(*key), key
        assert row.model == model(*key), key
        assert row.action == action(*key), key
        assert row.text == "".join(map(str, key))
        assert row.number == numbers[row.model]
    assert {r.mart for r in rows} >= set(numbers) | {"Potential Loyalists"}


@pytest.mark.parametrize(
    "tier,other,expected",
    [
        ("Budget", "Budget", "Same Price Tier"), ("Budget", "Standard", "Upsell"), ("Budget", "Luxury", "Upsell"),
        ("Standard", "Premium", "Upsell"), ("Standard", "Budget", "Downsell"), ("Premium", "Luxury", "Upsell"),
        ("Premium", "Standard", "Downsell"), ("Luxury", "Premium", "Downsell"), (None, "Luxury", "Downsell"),
        ("Budget", None, "Downsell"), (None, None, "Downsell"),
    ],
)
def test_price_movement(spark, tier, other, expected):
    assert one(spark, labels.price_movement(number(tier, "string"), number(other, "string"))) == expected


@pytest.mark.parametrize(
    "category,other,klass,other_class,expected",
    [
        ("a", "a", "x", "y", "Same Category"), ("a", "b", "x", "x", "Same Class"), ("a", "b", "x", "y", "Cross Category"),
        (None, None, "x", "x", "Same Class"), (None, None, None, None, "Cross Category"),
    ],
)
def test_recommendation_type(spark, category, other, klass, other_class, expected):
    args = [number(v, "string") for v in (category, other, klass, other_class)]
    assert one(spark, labels.recommendation_type(*args)) == expected


def test_year_month(spark):
    assert one(spark, labels.year_month(F.lit(1999), F.lit(3))) == "1999-03"
    assert one(spark, labels.year_month(F.lit(1999), F.lit(12))) == "1999-12"
