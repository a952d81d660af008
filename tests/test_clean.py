import datetime as dt

from helpers import raw, table
from pyspark.sql import functions as F

from plumeworks.functions.expressions import site_id
from plumeworks.operators import clean


def test_exact_copies_go_and_other_values_stay(spark):
    df = raw(spark, {}, {}, {"sample_measurement": 0.07}, {"county_name": None}, {"county_name": None})
    assert clean.drop_exact_duplicates(df).count() == 3


def test_exclusion_keeps_nulls_and_other_sources(spark):
    df = raw(
        spark,
        {"aqsid": "480290059", "data_source": "TCEQ"},
        {"aqsid": "480290059", "data_source": "EPA"},
        {"aqsid": None, "data_source": "TCEQ"},
        {"aqsid": "480290059", "data_source": None},
    )
    assert clean.exclude_rows(df).count() == 3


def test_exclusion_rule_on_absent_column_is_off(spark):
    df = raw(spark, {}).drop("data_source")
    assert clean.exclude_rows(df, [{"aqsid": "480290052", "data_source": "EPA"}]).count() == 1


def test_exclusion_compares_numbers_as_text(spark):
    df = raw(spark, {"poc": 1}, {"poc": 2})
    assert clean.exclude_rows(df, [{"poc": 2}]).count() == 1


def test_only_ozone_of_one_agency_is_converted(spark):
    df = raw(
        spark,
        {"data_source": "TCEQ", "sample_measurement": 61.0},
        {"data_source": "EPA", "sample_measurement": 0.061},
        {"data_source": "TCEQ", "parameter_code": 42401, "sample_measurement": 5.0},
        {"data_source": None, "sample_measurement": 9.0},
    )
    out = sorted(r[0] for r in clean.convert_units(df).select("sample_measurement").collect())
    assert out == [0.061, 0.061, 5.0, 9.0]
    assert clean.convert_units(df).columns == df.columns


def test_time_columns(spark):
    df = raw(
        spark,
        {"time_local": "7:00"}, {"time_local": "07:00", "date_local": "2023-12-31"}, {"time_local": "24:00"},
        {"time_local": "noon"}, {"date_local": None}, {"date_local": "2023-02-30"}, {"time_local": "7"},
    )
    out = table(clean.derive_time(df).select("datetime", "year", "month", "hour", "season"), "datetime")
    assert out == [
        (dt.datetime(2023, 7, 1, 7), 2023, 7, 7, "JJA"),
        (dt.datetime(2023, 12, 31, 7), 2023, 12, 7, "DJF"),
    ]


def test_time_parsing_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        df = raw(spark, {"date_local": "2023-03-12", "time_local": "02:00"})  # skipped by daylight saving
        row = clean.derive_time(df).select(F.col("datetime").cast("string"), "hour").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == ("2023-03-12 02:00:00", 2)


def test_county_case(spark):
    assert clean.title_county(raw(spark, {"county_name": "BEXAR"})).first()["county_name"] == "Bexar"


def test_no2_restriction_touches_only_its_family(spark):
    df = raw(
        spark,
        {"pollutant_group": "NOx_Family", "parameter_code": 42602},
        {"pollutant_group": "NOx_Family", "parameter_code": 42601},
        {"pollutant_group": "Ozone"},
    )
    assert clean.restrict_no2(df).count() == 2


def test_site_id_pads_but_never_cuts(spark):
    df = spark.createDataFrame([(48, 29, 52), (48, None, 12345), (6, 7, 0)], "s int, c int, n int")
    assert [r[0] for r in df.select(site_id("s", "c", "n")).collect()] == ["480290052", "4800012345", "060070000"]


def test_store_build_end_to_end(spark):
    df = raw(
        spark, {}, {}, {"data_source": "TCEQ", "sample_measurement": 70.0}, {"time_local": "x"},
        {"aqsid": "480290059", "data_source": "TCEQ"},
    )
    out = clean.clean_measurements(df)
    assert sorted(r["sample_measurement"] for r in out.collect()) == [0.061, 0.07]
    stats = clean.build_stats(df, out, "pollutant_group").first()
    assert tuple(stats) == ("Ozone", 5, 2, 1, "2023")
