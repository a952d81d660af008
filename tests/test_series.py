import datetime as dt
import random

import pandas as pd
import pytest
from helpers import hours, table
from pyspark.sql import functions as F

from plumeworks.operators import series


def values_of(df, column="mean_8h"):
    return [r[column] for r in df.orderBy("datetime").collect()]


def test_rolling_mean_with_a_null(spark):
    data = [float(i) if i != 3 else None for i in range(10)]
    got = values_of(series.rolling_mean(series.site_series(hours(spark, "2023-07-01", data))))
    assert got[:6] == [None] * 6
    assert got[6:] == pytest.approx([3.0, 25 / 7, 33 / 7, 41 / 7])


def test_rolling_mean_counts_rows_across_gaps_and_years(spark):
    early = hours(spark, "2022-12-31 20:00", [1.0] * 4)
    late = hours(spark, "2023-01-05 00:00", [3.0] * 4)
    got = values_of(series.rolling_mean(series.site_series(early.unionByName(late))))
    assert got[:5] == [None] * 5
    assert got[5:] == pytest.approx([10 / 6, 13 / 7, 2.0])


def test_rolling_mean_equals_pandas_on_random_series(spark):
    rng = random.Random(7)
    data = [rng.random() if rng.random() > 0.3 else None for _ in range(300)]
    got = values_of(series.rolling_mean(series.site_series(hours(spark, "2023-01-01", data))))
    want = pd.Series(data, dtype=float).rolling(8, min_periods=6).mean()
    assert [g is None for g in got] == list(want.isna())
    assert [g for g in got if g is not None] == pytest.approx(list(want.dropna()))


def test_series_averages_everything_at_a_timestamp_and_skips_unknown_sites(spark):
    rows = hours(spark, "2023-07-01", [1.0, None]).unionByName(hours(spark, "2023-07-01", [4.0, None]))
    rows = rows.unionByName(hours(spark, "2023-07-01", [9.0], aqsid=None))
    out = table(series.site_series(rows), "datetime")
    assert out == [("A", dt.datetime(2023, 7, 1), 2.5), ("A", dt.datetime(2023, 7, 1, 1), None)]


def test_site_names_are_the_smallest_non_null(spark):
    rows = hours(spark, "2023-07-01", [1.0, 2.0, 3.0])
    rows = rows.withColumn("site_name", F.when(F.hour("datetime") == 1, "B").when(F.hour("datetime") == 2, "A"))
    rows = rows.unionByName(hours(spark, "2023-07-01", [1.0], aqsid=None))
    assert table(series.site_names(rows), "aqsid") == [("A", "A", "Bexar")]


def test_days_need_eighteen_hours(spark):
    short = hours(spark, "2023-07-01", [2.0] * 17 + [None] * 7)
    full = hours(spark, "2023-07-02", [float(i) for i in range(18)])
    s = series.site_series(short.unionByName(full))
    assert [r["daily_value"] for r in series.daily_means(s).orderBy("day").collect()] == [None, 8.5]
    assert [r["daily_value"] for r in series.daily_maxima(s).orderBy("day").collect()] == [None, 17.0]


def test_daily_peak_of_rolling_mean_has_no_day_rule(spark):
    s = series.rolling_mean(series.site_series(hours(spark, "2023-07-01", [1.0] * 5 + [7.0])))
    assert series.daily_max_8h(s).first()["max_8h"] == 2.0


def test_rolling_over_raw_rows_equals_a_single_window(spark):
    rng = random.Random(3)
    data = []
    for site in ("A", "B"):
        stamp = dt.datetime(2023, 1, 1)
        for _ in range(60):
            stamp += dt.timedelta(hours=rng.choice([1, 1, 2, 50]))
            data += [(site, stamp, rng.random()) for _ in range(rng.choice([1, 1, 2, 12]))]
    df = spark.createDataFrame(data, "aqsid string, datetime timestamp_ntz, sample_measurement double")
    got = series.rolling_mean_of_rows(df)
    pdf = pd.DataFrame(data, columns=["aqsid", "datetime", "v"]).sort_values(["aqsid", "datetime", "v"])
    pdf["want"] = pdf.groupby("aqsid")["v"].transform(lambda s: s.rolling(8, min_periods=6).mean())
    got = got.toPandas().sort_values(["aqsid", "datetime", "sample_measurement"])
    assert len(got) == len(pdf)
    assert list(got["mean_8h"].isna()) == list(pdf["want"].isna())
    assert list(got["mean_8h"].dropna()) == pytest.approx(list(pdf["want"].dropna()))


def test_one_hot_site_is_averaged_before_any_window(spark):
    """A third of the rows at one site and hour collapse in the first aggregation's map side."""
    hot = hours(spark, "2023-07-01", [1.0]).select("*", F.explode(F.sequence(F.lit(1), F.lit(5000))).alias("_"))
    cold = hours(spark, "2023-07-01", [3.0] * 100, aqsid="B")
    out = series.site_series(hot.drop("_").unionByName(cold))
    assert out.count() == 101


def test_blocks_of_a_long_site_equal_one_window(spark):
    """Sparse months (some with fewer rows than the halo), gaps of a year and null values."""
    rng = random.Random(3)
    begin = dt.datetime(2020, 12, 30)
    rows, at = [], begin
    for _ in range(900):
        at += dt.timedelta(hours=rng.choice([1, 1, 2, 300, 900]))
        rows.append((rng.choice("AB"), at, rng.choice([None, rng.random()])))
    data = spark.createDataFrame(rows, "aqsid string, datetime timestamp_ntz, value double")
    want = table(series.rolling_mean(data), "aqsid", "datetime")
    assert table(series.rolling_mean_in_blocks(data).select("aqsid", "datetime", "value", "mean_8h"), "aqsid", "datetime") == want


def test_one_site_is_many_tasks(spark):
    """One site of 40,000 hours: no task of the window holds more than some months."""
    one = spark.range(40000).selectExpr("'A' AS aqsid", "timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ'2020-01-01 00:00:00') AS datetime", "CAST(id % 7 AS DOUBLE) AS value")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = series.rolling_mean_in_blocks(one).groupBy(F.spark_partition_id()).agg(F.count("mean_8h").alias("n")).agg(F.max("n")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert per_task <= 6 * 744
