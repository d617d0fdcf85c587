import pytest
from pyspark.sql import functions as F

from tillmark.plans import geography


@pytest.fixture(scope="module")
def tables(spark):
    cities = spark.createDataFrame(
        [
            (1, "São Paulo", "01000", 9),  # a country that is missing
            (2, "Dayton", "45390", 9),  # wrong country
            (3, "Prague ", "11000", 2),  # right already
            (4, "Atlantis", "00000", 7),  # unknown city
            (5, "Springfield", "11111", 9),  # most populous of two
            (6, "Twin", "22222", 9),  # tie of population
            (7, "Lima", "33333", 9),  # missing as well
            (8, "Nowhere Town", "44444", 5),  # its code is no country
            (9, "Rio", "55555", None),
        ],
        "CityID bigint, CityName string, Zipcode string, CountryID bigint",
    )
    countries = spark.createDataFrame(
        [
            (1, "United States", "AR"), (2, "Czech Republic", "cz"), (3, "Macedonia", "XX"), (4, "Canada", "CA"),
            (9, "Neverland", "NL"), (10, "Germany", None),
        ],
        "CountryID bigint, CountryName string, CountryCode string",
    )
    iso = spark.createDataFrame(
        [
            ("United States", "US"), ("Czechia", "CZ"), ("North Macedonia", "MK"), ("Canada", "CA"),
            ("Germany", "DE"), ("Brazil", "BR"), ("Peru", "PE"),
        ],
        "country_name string, alpha_2 string",
    )
    world = spark.createDataFrame(
        [
            ("Sao Paulo", "XX", 1), ("so paulo", " br ", 12_000_000), ("Dayton", "US", 140_000), ("Prague", "CZ", 1_300_000),
            ("Springfield", "CA", 10), ("Springfield", "US", 116_000), ("Twin", "US", 50), ("Twin", "CA", 50),
            ("Lima", "PE", 9_000_000), ("Nowhere Town", "ZZ", 5), ("", "US", 5), ("Rio", "BR", None), ("Rio", "", 99),
        ],
        "city_name string, country_code string, population bigint",
    )
    return cities, countries, iso, world


def test_countries(tables):
    _, countries, iso, _ = tables
    rows = {r.CountryID: (r.CountryCode, r.code_changed) for r in geography.normalized_countries(countries, iso).collect()}
    assert rows == {
        1: ("US", True), 2: ("cz", False), 3: ("MK", True), 4: ("CA", False), 9: ("NL", False), 10: ("DE", True),
    }


def test_city_codes(tables):
    codes = {r.city_key: r.country_code for r in geography.city_codes(tables[3]).collect()}
    assert codes["so paulo"] == "BR" and codes["springfield"] == "US" and codes["rio"] == "BR"
    assert codes["twin"] == "CA"  # the smaller code on a tie
    assert "" not in codes


def test_missing_countries_are_numbered_in_city_order(tables):
    rows = geography.completed_countries(*tables).where("CountryID > 10").orderBy("CountryID").collect()
    assert [tuple(r) for r in rows] == [(11, "Brazil", "BR"), (12, "Peru", "PE")]


def test_cities(tables):
    rows = {r.CityID: (r.CountryID, r.status) for r in geography.normalized_cities(*tables).collect()}
    assert rows == {
        1: (11, "updated"), 2: (1, "updated"), 3: (2, "unchanged"), 4: (7, "unresolved"), 5: (1, "updated"),
        6: (4, "updated"), 7: (12, "updated"), 8: (5, "unresolved"), 9: (11, "updated"),
    }


def test_counters(tables):
    row = geography.geography_counters(*tables).first()
    assert row.asDict() == {
        "countries_updated": 3, "countries_created": 2, "cities_updated": 6, "cities_unresolved": 2,
    }


@pytest.mark.parametrize(
    "name,key",
    [("Czech Republic", "czechia"), (" MACEDONIA", "north macedonia"), ("Swaziland", "eswatini"),
     ("Vatican City", "holy see vatican city state"), ("Peru", "peru")],
)
def test_aliases(spark, name, key):
    assert spark.range(1).select(geography.country_key(F.lit(name)).alias("k")).first().k == key
