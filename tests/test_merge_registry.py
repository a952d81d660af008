from helpers import raw, table
from pyspark.sql import functions as F

from plumeworks.operators import merge, registry


def coords(spark, *rows):
    return spark.createDataFrame(list(rows), "aqsid string, lat double, lon double")


def daily(spark, *rows):
    return spark.createDataFrame(
        list(rows), "aqsid string, site_name string, county_name string, date_local string, mean double"
    )


def weather(spark):
    rows = [
        ("Bexar North", 1, "2023-07-01", 29.5, -98.5, 30.0), ("Bexar North", 2, "2023-07-01", None, None, 20.0),
        ("Nueces Bay", 1, "2023-07-01", 27.8, -97.4, 28.0),
    ]
    return spark.createDataFrame(
        rows, "location string, dt long, date_local string, lat double, lon double, temp_c double"
    )


def test_first_source_wins(spark):
    first, second = coords(spark, ("a", 1.0, 2.0)), coords(spark, ("a", 9.0, 9.0), ("b", 3.0, None))
    assert table(merge.prefer_first([first, second], "aqsid", ["lat", "lon"]), "aqsid") == [
        ("a", 1.0, 2.0), ("b", 3.0, None),
    ]


def test_pairing_by_distance_by_county_and_not_at_all(spark):
    days = daily(
        spark, ("a", None, "Bexar", "2023-07-01", 1.0), ("a", "Site A", "Bexar", "2023-07-02", 1.0),
        ("b", "Site B", "Nueces", "2023-07-01", 2.0), ("c", "Site C", "Webb", "2023-07-01", 3.0),
        ("d", "Site D", "Bexar", "2023-07-01", 4.0),
    )
    places = coords(spark, ("a", 29.4, -98.4), ("d", 29.0, None))  # d lacks a longitude
    pairing = merge.pair_sites(days, weather(spark), places)
    got = {r["aqsid"]: (r["site_name"], r["weather_station"], r["distance_km"] is None) for r in pairing.collect()}
    assert got == {
        "a": ("Site A", "Bexar North", False), "b": ("Site B", "Nueces Bay", True),
        "c": ("Site C", None, True), "d": ("Site D", "Bexar North", True),
    }
    combined = merge.combined_daily(days, weather(spark), places)
    rows = {(r["aqsid"], r["date_local"]): r["temp_c"] for r in combined.collect()}
    assert rows == {
        ("a", "2023-07-01"): 25.0, ("a", "2023-07-02"): None, ("b", "2023-07-01"): 28.0, ("d", "2023-07-01"): 25.0,
    }


def test_published_comparison(spark):
    ours = spark.createDataFrame([("a", 0.066), ("b", 1.0)], "aqsid string, value double")
    theirs = spark.createDataFrame([("a", 0.06), ("z", 1.0)], "aqsid string, published_value double")
    out = merge.compare_published(ours, theirs).collect()
    assert [(r["aqsid"], round(r["diff_pct"], 6)) for r in out] == [("a", 10.0)]


def test_registry_rows(spark):
    rows = raw(
        spark,
        {"aqsid": "A", "data_source": "EPA", "pollutant_group": "Ozone", "date_local": "2023-07-02"},
        {"aqsid": "A", "data_source": "TCEQ", "pollutant_group": "CO", "date_local": "2022-01-05", "site_name": None},
        {"aqsid": "A", "data_source": "TCEQ", "pollutant_group": "CO", "date_local": "2022-01-05", "site_name": None},
        {"aqsid": "B", "data_source": None},
        {"aqsid": "480291609", "site_number": 1609},
    )
    out = {r["aqsid"]: r for r in registry.site_registry(rows, coords(spark, ("A", 1.0, 2.0))).collect()}
    a = out["A"]
    assert (a["network"], a["pollutants"], a["n_pollutants"], a["first_date"], a["last_date"], a["n_records"]) == (
        "BOTH", "CO;Ozone", 2, "2022-01-05", "2023-07-02", 3,
    )
    assert (a["site_name"], a["county_name"], a["lat"], a["lon"]) == ("Camp Bullis_0052", "Bexar", 1.0, 2.0)
    assert out["B"]["network"] == "" and out["B"]["lat"] is None
    assert out["480291609"]["data_status"] == "active"  # the excluded row gives way
    statuses = sorted(r["data_status"] for r in out.values())
    assert statuses == ["active"] * 3 + ["disabled"] + ["reference"] * 3


def test_excluded_site_is_listed_when_it_has_no_data(spark):
    out = registry.site_registry(raw(spark, {}), coords(spark, ("x", 1.0, 1.0)))
    row = out.where(F.col("data_status") == "excluded").first()
    assert (row["aqsid"], row["pollutants"], row["n_pollutants"], row["network"]) == ("480291609", "TSP", 0, "TCEQ")
    assert [r["data_status"] for r in registry.ordered(out).collect()] == (
        ["active", "disabled", "excluded"] + ["reference"] * 3
    )


def test_hot_keys_are_spread_and_join_alike(spark):
    """One key holds nearly all rows: same rows as a plain join, and no task holds most of them."""
    left = spark.range(20000).selectExpr("IF(id % 100 = 0, id % 7, -1) AS k", "id AS v")
    right = spark.createDataFrame([(-1, "a"), (-1, "b"), (3, "c"), (9, "d")], "k long, w string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = merge.join_with_hot_keys(left, right, ["k"], limit=500)
        per_task = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert joined.exceptAll(left.join(right, "k")).isEmpty() and joined.count() == left.join(right, "k").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert per_task < joined.count() / 4


def test_keep_first_takes_the_earliest_row(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 3, None), (None, 3, "q")], "k string, t int, v string")
    assert sorted(map(tuple, merge.keep_first(rows, ["k"], ["t"]).collect()), key=str) == [("a", 1, "y"), (None, 3, None)]
