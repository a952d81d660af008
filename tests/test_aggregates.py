import pytest
from helpers import raw
from pyspark.sql import functions as F

from plumeworks.operators import aggregates, clean


def test_daily_counts_rows_and_keeps_null_keys(spark):
    rows = [{"time_local": f"{h:02d}:00", "poc": p, "sample_measurement": float(h)} for h in range(15) for p in (1, 2)]
    rows += [{"date_local": "2023-07-02", "county_name": None, "sample_measurement": 1.0}]
    rows += [{"date_local": "2023-07-03", "sample_measurement": None}]
    daily = {r["date_local"]: r for r in aggregates.daily_stats(clean.clean_measurements(raw(spark, *rows))).collect()}
    crowded = daily["2023-07-01"]
    assert (crowded["n_hours"], crowded["completeness_pct"], crowded["valid_day"]) == (30, 1.25, True)
    assert daily["2023-07-02"]["county_name"] is None and daily["2023-07-02"]["std"] is None
    assert (daily["2023-07-03"]["n_hours"], daily["2023-07-03"]["mean"], daily["2023-07-03"]["valid_day"]) == (0, None, False)


def test_eighteen_hours_make_a_valid_day(spark):
    rows = [{"time_local": f"{h:02d}:00"} for h in range(18)]
    rows += [{"date_local": "2023-07-02", "time_local": f"{h:02d}:00"} for h in range(17)]
    flags = {r["date_local"]: r["valid_day"] for r in aggregates.daily_stats(raw(spark, *rows)).collect()}
    assert flags == {"2023-07-01": True, "2023-07-02": False}


def test_monthly_uses_valid_days_only(spark):
    base = aggregates.daily_stats(raw(spark, {}))
    days = [("2023-07-01", 1.0, True), ("2023-07-02", 2.0, True), ("2023-07-03", 3.0, True), ("2023-07-04", 10.0, True),
            ("2023-07-05", 99.0, False), ("2023-08-01", 5.0, False), ("2023-09-01", 4.0, True)]
    frame = spark.createDataFrame(days, "date_local string, mean double, valid_day boolean")
    daily = base.drop("date_local", "mean", "valid_day").crossJoin(F.broadcast(frame))
    out = {r["year_month"]: r for r in aggregates.monthly_stats(daily).collect()}
    assert set(out) == {"2023-07", "2023-09"}
    july = out["2023-07"]
    assert (july["monthly_mean"], july["monthly_min"], july["monthly_max"], july["n_valid_days"]) == (4.0, 1.0, 10.0, 4)
    assert july["monthly_std"] == pytest.approx(4.08248290463863)
    assert out["2023-09"]["monthly_std"] is None
    tally = aggregates.validity_tally(daily).first()
    assert tuple(tally) == (7, 5, 2)
