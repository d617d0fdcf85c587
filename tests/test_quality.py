import pytest

from tillmark.plans import quality

COUNTRY = "CountryID bigint, CountryName string, CountryCode string"


@pytest.fixture(scope="module")
def right(spark):
    rows = [(i, name, code) for i, (name, code) in enumerate(quality.CORE_COUNTRY_CODES.items())]
    return spark.createDataFrame(rows, COUNTRY)


def test_forbidden_cities(spark):
    def cities(*names):
        return spark.createDataFrame([(n,) for n in names], "CityName string")

    assert quality.forbidden_cities(cities("Dayton", "Denver")).isEmpty()
    assert sorted(r.city_name for r in quality.forbidden_cities(cities("Kansas", "Dayton", "Jersey")).collect()) == [
        "Jersey",
        "Kansas",
    ]


def test_country_codes(spark, right):
    assert quality.wrong_country_codes(right).isEmpty()
    wrong = spark.createDataFrame([(1, "Canada", "FO"), (2, "Germany", None), (3, "India", "IN")], COUNTRY)
    found = {r.country_name: r.actual_country_code for r in quality.wrong_country_codes(wrong).collect()}
    assert found == {"Canada": "FO", "Germany": None, "United States": None, "United Kingdom": None, "Australia": None}


def test_malformed_codes(spark, right):
    assert quality.malformed_country_codes(right).isEmpty()
    bad = spark.createDataFrame([(1, "a", "us"), (2, "b", None), (3, "c", "USA"), (4, "d", "DE")], COUNTRY)
    assert sorted(r.CountryID for r in quality.malformed_country_codes(bad).collect()) == [1, 2, 3]


def test_rank_violations(spark):
    ddl = "customer_id bigint, recommendation_rank int"
    assert quality.rank_violations(spark.createDataFrame([(1, r) for r in range(1, 11)], ddl)).isEmpty()
    found = quality.rank_violations(spark.createDataFrame([(1, r) for r in range(1, 13)] + [(2, 3)], ddl)).collect()
    assert [tuple(r) for r in found] == [(1, 12, 12)]


def test_counts(spark):
    segments = spark.createDataFrame([(1,), (2,), (2,)], "customer_id bigint")
    assert tuple(quality.segment_counts(segments).first()) == (3, 2)
    recommendations = spark.createDataFrame(
        [(1, 2.0, "ALS"), (1, 4.0, "ALS"), (2, 3.0, "HEURISTIC_FALLBACK")],
        "customer_id bigint, score double, model_type string",
    )
    assert tuple(quality.recommendation_counts(recommendations).first()) == (3, 2, 3.0, 2)
