import json
import os

from helpers import raw
from pyspark.sql import functions as F

from plumeworks.operators import quality


def by_name(df):
    return {r["name"]: r for r in df.collect()}


def test_measurement_checks(spark):
    df = raw(spark, {}, {}, {"sample_measurement": 1.0}, {"time_local": "14:00"})
    got = by_name(quality.check_measurements(df, "Ozone", 4))
    assert got["schema:Ozone"]["passed"] and got["row_count:Ozone"]["passed"]
    dup = got["no_duplicate_hours:Ozone"]
    assert (dup["passed"], dup["actual"], dup["detail"], dup["severity"]) == (False, "2", "exact_full_row_dups=1", "warning")
    assert got["date_range:Ozone"]["passed"] and got["date_range:Ozone"]["actual"] == "2023-07-01..2023-07-01"


def test_null_keys_count_as_equal(spark):
    df = raw(spark, {"poc": None}, {"poc": None, "sample_measurement": 2.0})
    assert by_name(quality.check_measurements(df, "x", 2))["no_duplicate_hours:x"]["actual"] == "1"


def test_schema_differences_are_listed(spark):
    df = raw(spark, {}).withColumn("extra", F.lit(1)).drop("method_code")
    got = by_name(quality.check_measurements(df, "x", 1))["schema:x"]
    assert not got["passed"] and got["detail"] == "missing=['method_code'] extra=['extra']"


def test_missing_key_columns_are_an_error(spark):
    got = by_name(quality.check_measurements(raw(spark, {}).drop("poc"), "x", 1))["no_duplicate_hours:x"]
    assert (got["passed"], got["severity"]) == (False, "error")
    assert not by_name(quality.missing_source(spark, "CO"))["schema:CO"]["passed"]


def test_row_count_tolerance(spark):
    def passed(n, expected, tolerance):
        df = spark.range(1).select(F.lit(n).alias("n"))
        return quality.as_rows(df, [quality.row_count_result("n", expected, "x", tolerance)]).first()["passed"]
    assert passed(99, 100, 1.0) and not passed(98, 100, 1.0)
    assert passed(0, 0, 1.0) and not passed(1, 0, 50.0)


def test_dates(spark):
    def check(*dates):
        df = raw(spark, *[{"date_local": d} for d in dates])
        return by_name(quality.check_measurements(df, "x", len(dates)))["date_range:x"]
    assert check("2023-01-01", "junk")["passed"]
    assert not check("2014-12-31", "2023-01-01")["passed"]
    assert not check("2027-01-01")["passed"]
    assert (check("junk")["passed"], check("junk")["detail"]) == (False, "no parseable dates")


def test_sources_are_checked_in_one_pass(spark):
    df = raw(spark, {}, {}, {"pollutant_group": "CO", "date_local": "1990-01-01"})
    got = by_name(quality.check_sources(df, "pollutant_group", {"Ozone": 2, "CO": 5, "PM10": 1}))
    assert {n for n, r in got.items() if not r["passed"]} == {
        "no_duplicate_hours:Ozone", "row_count:CO", "date_range:CO", "schema:PM10",
    }
    assert len(got) == 9


def test_totals(spark):
    df = raw(spark, {}, {"aqsid": "B", "county_name": "bexar"}, {"aqsid": None, "pollutant_group": "CO"})
    got = by_name(quality.check_totals(df, 3, 4, 1, 2))
    assert all(r["passed"] for r in got.values())
    assert (got["nunique:aqsid"]["actual"], got["nunique:aqsid"]["expected"]) == ("2", ">=1")


def test_weather_and_mapping(spark):
    wx = spark.createDataFrame([("a",), ("b",)], "location string")
    assert all(r["passed"] for r in quality.check_weather(wx, 2, 2).collect())
    assert quality.check_weather(wx.toDF("site_name"), 2, 2).count() == 1
    good = spark.createDataFrame([("a", "w", 1.0)], "AQSID string, Station string, Dist_km double")
    assert quality.check_mapping(good).first()["passed"]
    assert not quality.check_mapping(good.limit(0)).first()["passed"]
    assert not quality.check_mapping(good.drop("Dist_km")).first()["passed"]


def test_roll_up_and_report(spark, folder):
    df = raw(spark, {}, {})
    results = quality.check_measurements(df, "x", 2)
    top = quality.roll_up(results).first()
    assert top["passed"] and top["summary"] == "3/4 passed  (0 errors, 1 warnings)"
    failing = quality.roll_up(results.unionByName(quality.missing_source(spark, "y"))).first()
    assert not failing["passed"] and failing["n_errors"] == 1
    quality.write_report(results, folder)
    parts = [f for f in os.listdir(f"{folder}/summary") if f.endswith(".json")]
    line = "".join(open(f"{folder}/summary/{p}").read() for p in parts)
    assert json.loads(line)["n_checks"] == 4


def test_output_sanity(spark):
    values = spark.createDataFrame(
        [("ozone_8hr_4th_max", 0.07), ("pm25_annual_mean", 9.0), ("pm25_24hr_p98", 20.0), ("so2_1hr_p99", 5.0)],
        "metric string, value double",
    )
    registry = spark.createDataFrame([("active",)] * 40, "data_status string")
    got = by_name(quality.check_outputs(values, registry, (1, 10)))
    assert {n for n, r in got.items() if not r["passed"]} == {"outputs:required_metrics"}
    assert got["outputs:required_metrics"]["actual"] == "no2_1hr_p98"
    wild = values.unionByName(spark.createDataFrame([("ozone_8hr_4th_max", 70.0)], "metric string, value double"))
    assert not by_name(quality.check_outputs(wild, registry, (1, 10)))["outputs:ozone_range"]["passed"]
