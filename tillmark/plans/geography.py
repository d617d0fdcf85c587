"""Clean-up of the city and country tables against two reference tables.

``iso`` has country_name and alpha_2; ``world`` has city_name, country_code and population.  All of it is joins and
groupings on normalised names; no table is looped over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.keys import text_key
from tillmark.operators.durable import checkpointed
from tillmark.operators.ranking import Ranks, asc, with_ranks

# Country names that the ISO table lists under another name.
COUNTRY_ALIASES = {
    "czech republic": "Czechia",
    "macedonia": "North Macedonia",
    "swaziland": "Eswatini",
    "vatican city": "Holy See (Vatican City State)",
}


def country_key(name: Column) -> Column:
    """Join key of a country name, with the aliases resolved."""
    key = text_key(name)
    resolved = key
    for alias, official in COUNTRY_ALIASES.items():
        resolved = F.when(key == alias, text_key(F.lit(official))).otherwise(resolved)
    return resolved


def _code(column: str) -> Column:
    """Trimmed upper-case code; blank counts as missing."""
    return F.nullif(F.upper(F.trim(F.col(column))), F.lit(""))


def iso_codes(iso: DataFrame) -> DataFrame:
    """One code per normalised ISO name."""
    return iso.groupBy(text_key(F.col("country_name")).alias("_key")).agg(F.min("alpha_2").alias("_iso_code"))


def normalized_countries(countries: DataFrame, iso: DataFrame) -> DataFrame:
    """Countries with the ISO code of their name; names that ISO does not know keep their code.

    ``code_changed`` tells which rows differ from the input.
    """
    keyed = countries.withColumn("_key", F.nullif(country_key(F.col("CountryName")), F.lit("")))
    current = F.coalesce(_code("CountryCode"), F.lit(""))
    return (
        keyed.join(iso_codes(iso), "_key", "left")
        .withColumn("code_changed", F.coalesce(F.col("_iso_code") != current, F.lit(False)))
        .select(
            "CountryID",
            "CountryName",
            F.when(F.col("code_changed"), F.col("_iso_code")).otherwise(F.col("CountryCode")).alias("CountryCode"),
            "code_changed",
        )
    )


def city_codes(world: DataFrame) -> DataFrame:
    """Country code per normalised city name: that of the most populous city, the smaller code on a tie."""
    named = world.select(
        text_key(F.col("city_name")).alias("city_key"),
        _code("country_code").alias("country_code"),
        F.coalesce(F.col("population").cast("bigint"), F.lit(0)).alias("population"),
    ).where((F.col("city_key") != "") & F.col("country_code").isNotNull())
    # Folded to one row per city and code first: the winner is then picked among few rows, whatever the city's size.
    per_code = named.groupBy("city_key", "country_code").agg(F.max("population").alias("population"))
    largest = per_code.groupBy("city_key").agg(F.max("population").alias("population"))
    return per_code.join(largest, ["city_key", "population"]).groupBy("city_key").agg(
        F.min("country_code").alias("country_code")
    )


def _named_cities(cities: DataFrame, iso: DataFrame, world: DataFrame) -> DataFrame:
    """Cities with the country code found for their name and the ISO country of it; stored, as it is read repeatedly."""
    iso_names = iso.groupBy(F.col("alpha_2").alias("_code")).agg(F.min("country_name").alias("_iso_name"))
    found = cities.withColumn("city_key", text_key(F.col("CityName"))).join(city_codes(world), "city_key", "left")
    return checkpointed(found.join(iso_names, F.col("country_code") == F.col("_code"), "left").drop("_code"))


def _with_known(named: DataFrame, countries: DataFrame) -> DataFrame:
    """Country id per code; a code that occurs twice stands for its last row, by id."""
    known = (
        countries.where(_code("CountryCode").isNotNull())
        .groupBy(_code("CountryCode").alias("_known_code"))
        .agg(F.max("CountryID").alias("_known_id"))
    )
    return named.join(known, F.col("country_code") == F.col("_known_code"), "left")


def _created(named: DataFrame, countries: DataFrame) -> DataFrame:
    missing = (
        _with_known(named, countries)
        .where(F.col("_known_id").isNull() & F.col("_iso_name").isNotNull())
        .groupBy(F.col("country_code").alias("CountryCode"), F.col("_iso_name").alias("CountryName"))
        .agg(F.min("CityID").alias("_first_city"))
    )
    highest = countries.agg(F.coalesce(F.max("CountryID"), F.lit(0))).scalar()
    numbered = with_ranks(missing, Ranks([asc("_first_city")], ["CountryCode"], row_number="_number"))
    return numbered.select((highest + F.col("_number")).alias("CountryID"), "CountryName", "CountryCode")


def _moved(named: DataFrame, complete: DataFrame) -> DataFrame:
    target = F.col("_known_id")
    return _with_known(named, complete).select(
        "CityID",
        "CityName",
        "Zipcode",
        F.coalesce(target, F.col("CountryID")).alias("CountryID"),
        F.when(target.isNull(), "unresolved")
        .when(target.eqNullSafe(F.col("CountryID")), "unchanged")
        .otherwise("updated")
        .alias("status"),
    )


def new_countries(cities: DataFrame, countries: DataFrame, iso: DataFrame, world: DataFrame) -> DataFrame:
    """Countries that cities belong to and ``countries`` lacks, numbered on from the highest id in city order."""
    return _created(_named_cities(cities, iso, world), countries)


def completed_countries(cities: DataFrame, countries: DataFrame, iso: DataFrame, world: DataFrame) -> DataFrame:
    """Normalised countries plus the created ones."""
    normal = normalized_countries(countries, iso).drop("code_changed")
    return normal.unionByName(new_countries(cities, normal, iso, world))


def normalized_cities(cities: DataFrame, countries: DataFrame, iso: DataFrame, world: DataFrame) -> DataFrame:
    """Cities pointing at the country their name belongs to; a city that cannot be resolved keeps its country.

    ``status`` is updated, unchanged or unresolved.
    """
    named = _named_cities(cities, iso, world)
    normal = normalized_countries(countries, iso).drop("code_changed")
    return _moved(named, normal.unionByName(_created(named, normal)))


def geography_counters(cities: DataFrame, countries: DataFrame, iso: DataFrame, world: DataFrame) -> DataFrame:
    """One row: countries updated and created, cities updated and unresolved."""
    named = _named_cities(cities, iso, world)
    normal = checkpointed(normalized_countries(countries, iso))
    plain = normal.drop("code_changed")
    created = _created(named, plain)
    moved = _moved(named, plain.unionByName(created))

    def tally(df: DataFrame, counter: str, condition: Column) -> DataFrame:
        return df.select(F.lit(counter).alias("counter"), condition.cast("bigint").alias("hit"))

    hits = (
        tally(normal, "countries_updated", F.col("code_changed"))
        .unionByName(tally(created, "countries_created", F.lit(True)))
        .unionByName(tally(moved, "cities_updated", F.col("status") == "updated"))
        .unionByName(tally(moved, "cities_unresolved", F.col("status") == "unresolved"))
    )

    def total(counter: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("counter") == counter, F.col("hit"))), F.lit(0)).alias(counter)

    return hits.agg(
        total("countries_updated"), total("countries_created"), total("cities_updated"), total("cities_unresolved")
    )
