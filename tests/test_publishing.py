"""Rejected records, measures gathered by writes, and refreshes that are seen whole or not at all."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tillmark.plans import quality
from tillmark.plans.workspace import REFRESH_ORDER, Workspace
from tillmark.sources import readers, schemas, sinks

HEADER = "SalesID,SalesPersonID,CustomerID,ProductID,Quantity,Discount,TotalPrice,SalesDate,TransactionNumber\n"
GOOD = "{},2,3,4,5,0.10,12.5,2001-02-03 04:05:06,T1\n"


def _folder(tmp_path, lines):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / "sales.csv").write_text(HEADER + "".join(lines))
    return str(folder)


def test_records_that_do_not_load_whole(spark, tmp_path):
    lines = [GOOD.format(i) for i in range(1, 17)]
    lines += ["17,2,x,4,5,0.10,dear,2001-02-03 04:05:06,T2\n", "18,2,,4,,,,,T3\n", "19,2,3\n", "20,2,3,4,5,0.1,1,,T4,more\n"]
    folder = _folder(tmp_path, lines)
    records = readers.judged(spark, f"{folder}/sales.csv", schemas.struct(schemas.RAW["sales"]))
    assert records.count() == 20
    found = {r.record: r.reasons for r in records.where("size(reasons) > 0").collect()}
    assert found == {
        "17,2,x,4,5,0.10,dear,2001-02-03 04:05:06,T2": ["CustomerID", "TotalPrice"],
        "19,2,3": ["fields"],
        "20,2,3,4,5,0.1,1,,T4,more": ["fields"],
    }
    assert records.where("file not like '%/sales.csv'").isEmpty()
    target = str(tmp_path / "out")
    loaded = sinks.replace_raw(spark, folder, target, max_rejected=0.15)
    assert loaded["sales"].count() == 20 and loaded["sales"].where("SalesID = 17 and CustomerID is null").count() == 1
    assert spark.read.parquet(f"{target}/sales_rejected").count() == 3


def test_too_many_rejected_records_keep_the_old_table(spark, tmp_path):
    target = str(tmp_path / "out")
    sinks.replace_raw(spark, _folder(tmp_path, [GOOD.format(1)]), target, max_rejected=0)
    assert spark.read.parquet(f"{target}/sales_rejected").isEmpty()
    folder = _folder(tmp_path, [GOOD.format(1), GOOD.format(2), "3,y,3,4,5,0.1,1,,T4\n"])
    with pytest.raises(ValueError, match="1 of 3 records"):
        sinks.replace_raw(spark, folder, target, max_rejected=0.3)
    assert spark.read.parquet(f"{target}/sales").count() == 1
    assert spark.read.parquet(f"{target}/sales_rejected").count() == 1
    _folder(tmp_path, [])  # a file of a header only
    assert sinks.replace_raw(spark, folder, target, max_rejected=0)["sales"].isEmpty()


def _measured(frame, table, place):
    seen = Observation()
    sinks.write_table(frame, place, (), seen, *[c.alias(n) for n, c in quality.measures(table).items()])
    return seen.get


def test_measures_equal_the_check_queries(spark, workspace, tmp_path):
    ddl = "CountryID int, CountryName string, CountryCode string"
    rows = [(1, "United States", "US"), (2, "Canada", "DE"), (3, "Canada", None), (4, "India", "in"), (5, None, None)]
    countries = spark.createDataFrame(rows, ddl)
    got = _measured(countries, "dim_countries", str(tmp_path / "a"))
    assert got["wrong_country_codes"] == quality.wrong_country_codes(countries).count() == 6
    assert got["malformed_country_codes"] == quality.malformed_country_codes(countries).count() == 3
    cities = spark.createDataFrame([("Kansas",), ("Jersey",), ("Dayton",), (None,)], "CityName string")
    assert _measured(cities, "dim_cities", str(tmp_path / "b"))["forbidden_cities"] == quality.forbidden_cities(cities).count() == 2
    none = _measured(countries.limit(0), "dim_countries", str(tmp_path / "c"))
    assert (none["rows"], none["wrong_country_codes"]) == (0, len(quality.CORE_COUNTRY_CODES))
    segments = workspace.customer_segments
    counts = quality.segment_counts(segments).first()
    got = _measured(segments, "customer_segments", str(tmp_path / "d"))
    assert (got["rows"], got["customers_segmented"]) == tuple(counts)
    picks = workspace.heuristic_recommendations
    counts = quality.recommendation_counts(picks).first()
    got = _measured(picks, "customer_recommendations", str(tmp_path / "e"))
    assert (got["rows"], got["customers_with_reco"]) == (counts.recommendation_rows, counts.customers_with_reco)
    assert got["avg_reco_score"] == pytest.approx(counts.avg_reco_score)
    beyond = picks.withColumn("recommendation_rank", F.col("recommendation_rank") + 3)
    got = _measured(beyond, "customer_recommendations", str(tmp_path / "f"))
    assert (got["rows_beyond_rank"] > 0) == (not quality.rank_violations(beyond).isEmpty())


def test_limits():
    quality.require_limits("dim_cities", {"rows": 0, "forbidden_cities": 0})
    with pytest.raises(ValueError, match="forbidden_cities is 1"):
        quality.require_limits("dim_cities", {"rows": 4, "forbidden_cities": 1})
    with pytest.raises(ValueError, match="st_products is empty"):
        quality.require_limits("st_products", {"rows": 0})


def test_a_refresh_that_fails_is_not_seen(spark, workspace, tmp_path):
    target, tables = str(tmp_path / "out"), REFRESH_ORDER[:10]
    assert sinks.published(spark, target) == {}
    space = Workspace(dict(workspace._sources), as_of=workspace.as_of)
    space.publish(target, tables)
    old = {name: frame.count() for name, frame in sinks.published(spark, target).items()}
    assert set(old) == set(tables) and old["st_sales"] == space.measured["st_sales"]["rows"] > 0
    first = sinks.published_version(spark, target)

    def fewer(fails):
        sources = dict(workspace._sources)
        sources["sales"] = workspace.source("sales").where("SalesID % 2 = 0")
        changed = Workspace(sources, as_of=workspace.as_of)
        if fails:  # the tenth table
            changed.fct_employee_performance = spark.range(3).select(F.raise_error(F.lit("lost")).alias("x"))
        return changed

    with pytest.raises(Exception, match="lost"):
        fewer(True).publish(target, tables)
    assert sinks.published_version(spark, target) == first
    assert {name: frame.count() for name, frame in sinks.published(spark, target).items()} == old
    # A table beyond its limit stops it too, and the workspace keeps the tables it had.
    with pytest.raises(ValueError, match="st_sales: rows"):
        space.publish(target, tables, {("st_sales", "rows"): 1})
    assert space.table("st_sales").count() == old["st_sales"] and sinks.published_version(spark, target) == first
    fewer(False).publish(target, tables)
    new = sinks.published(spark, target)
    assert 0 < new["st_sales"].count() < old["st_sales"] and len(sinks._version_folders(spark, target, "*")) == 4
    sinks.remove_versions(spark, target, keep=1)
    left = sinks._version_folders(spark, target, "*")
    assert [p.toString() for p in left] == [sinks.published_version(spark, target)]
