import datetime as dt

import pandas as pd
import pytest
from helpers import hours, table
from pyspark.sql import functions as F

from plumeworks.operators import metrics


def full_days(spark, start, means, **kw):
    """24 equal hours per day; None gives an hour-less (invalid) day of 17 hours."""
    out = None
    for i, m in enumerate(means):
        day = (dt.date.fromisoformat(start) + dt.timedelta(days=i)).isoformat()
        part = hours(spark, day, [m] * 24 if m is not None else [1.0] * 17, **kw)
        out = part if out is None else out.unionByName(part)
    return out


def values(df):
    return {(r["aqsid"], r["year"]): r["value"] for r in df.collect()}


def test_annual_mean_and_p98_of_valid_days(spark):
    rows = full_days(spark, "2023-03-01", [1.0, 2.0, 3.0, 10.0, None], group="PM2.5", parameter=88101)
    assert values(metrics.metric_from_hourly(rows, "pm25_annual_mean")) == {("A", 2023): 4.0}
    assert values(metrics.metric_from_hourly(rows, "pm25_24hr_p98"))[("A", 2023)] == pytest.approx(9.58)


def test_years_without_valid_days_have_no_value(spark):
    rows = full_days(spark, "2023-03-01", [None], group="PM2.5", parameter=88101)
    assert values(metrics.metric_from_hourly(rows, "pm25_annual_mean")) == {}


def test_exceedance_days_fill_empty_years_with_zero(spark):
    rows = full_days(spark, "2020-03-01", [151.0, 150.0, 200.0], group="PM10", parameter=81102)
    rows = rows.unionByName(full_days(spark, "2022-03-01", [None], group="PM10", parameter=81102))
    assert values(metrics.metric_from_hourly(rows, "pm10_24hr_exceedances")) == {
        ("A", 2020): 2.0, ("A", 2021): 0.0, ("A", 2022): 0.0,
    }


def test_exceedance_years_reach_null_rows(spark):
    rows = full_days(spark, "2020-03-01", [10.0], group="PM10", parameter=81102)
    rows = rows.unionByName(hours(spark, "2021-06-01", [None], group="PM10", parameter=81102))
    assert set(values(metrics.metric_from_hourly(rows, "pm10_24hr_exceedances"))) == {("A", 2020), ("A", 2021)}


def test_co_metrics(spark):
    rows = hours(spark, "2023-01-01", [1.0] * 8 + [9.0], group="CO", parameter=42101)
    assert values(metrics.metric_from_hourly(rows, "co_1hr_max")) == {("A", 2023): 9.0}
    assert values(metrics.metric_from_hourly(rows, "co_8hr_max")) == {("A", 2023): 2.0}


def test_gas_percentiles_use_daily_maxima(spark):
    rows = None
    for i, peak in enumerate([1.0, 2.0, 3.0, 10.0]):
        part = hours(spark, f"2023-05-0{i + 1}", [0.0] * 23 + [peak], group="SO2", parameter=42401)
        rows = part if rows is None else rows.unionByName(part)
    want = pd.Series([1.0, 2.0, 3.0, 10.0])
    assert values(metrics.metric_from_hourly(rows, "so2_1hr_p99"))[("A", 2023)] == pytest.approx(want.quantile(0.99))
    no2 = rows.withColumn("pollutant_group", F.lit("NOx_Family")).withColumn("parameter_code", F.lit(42602))
    other = no2.withColumn("parameter_code", F.lit(42601)).withColumn("sample_measurement", F.lit(500.0))
    got = values(metrics.metric_from_hourly(no2.unionByName(other), "no2_1hr_p98"))
    assert got[("A", 2023)] == pytest.approx(want.quantile(0.98))


def ozone_days(spark, peaks, aqsid="A"):
    """One burst of eight equal hours per day, days far enough apart in rows not to matter."""
    out = None
    for i, p in enumerate(peaks):
        part = hours(spark, f"2023-0{i + 1}-01 08:00", [p] * 8, aqsid=aqsid)
        out = part if out is None else out.unionByName(part)
    return out


def test_fourth_highest_counts_ties_and_needs_four_days(spark):
    tied = ozone_days(spark, [0.05, 0.08, 0.08, 0.08, 0.06])
    short = ozone_days(spark, [0.05, 0.06, 0.07], aqsid="B")
    got = values(metrics.metric_from_hourly(tied.unionByName(short), "ozone_8hr_4th_max"))
    assert set(got) == {("A", 2023)}
    # Windows spill from one burst into the next, so compare with the same rule in pandas.
    s = pd.Series([p for p in (0.05, 0.08, 0.08, 0.08, 0.06) for _ in range(8)])
    s.index = [pd.Timestamp(f"2023-0{i + 1}-01 08:00") + pd.Timedelta(hours=h) for i in range(5) for h in range(8)]
    peaks = s.rolling(8, min_periods=6).mean().groupby(s.index.date).max().sort_values(ascending=False)
    assert got[("A", 2023)] == pytest.approx(peaks.iloc[3])


def test_all_metrics_in_one_plan(spark):
    rows = (
        ozone_days(spark, [0.05, 0.08, 0.08, 0.08, 0.09])
        .unionByName(full_days(spark, "2023-03-01", [9.0, 9.0], group="PM2.5", parameter=88101))
        .unionByName(full_days(spark, "2021-03-01", [151.0], group="PM10", parameter=81102))
        .unionByName(full_days(spark, "2023-03-01", [151.0], group="PM10", parameter=81102))
        .unionByName(hours(spark, "2023-01-01", [40.0] * 8, group="CO", parameter=42101))
        .unionByName(full_days(spark, "2023-03-01", [80.0], group="SO2", parameter=42401))
        .unionByName(full_days(spark, "2023-03-01", [60.0], group="NOx_Family", parameter=42602))
        .unionByName(hours(spark, "2023-03-01", [1.0] * 24, group="VOCs", parameter=43202))
    )
    out = metrics.design_values(rows)
    got = {(r["metric"], r["year"]): (round(r["value"], 9), r["exceeds"]) for r in out.collect()}
    assert got[("pm25_annual_mean", 2023)] == (9.0, False)  # equal to the level is not above it
    assert got[("pm10_24hr_exceedances", 2022)] == (0.0, False)
    assert got[("pm10_24hr_exceedances", 2021)] == (1.0, False)
    assert got[("co_1hr_max", 2023)] == (40.0, True)
    assert got[("co_8hr_max", 2023)] == (40.0, True)
    assert got[("so2_1hr_p99", 2023)] == (80.0, True)
    assert got[("no2_1hr_p98", 2023)] == (60.0, False)
    assert got[("no2_annual_mean", 2023)] == (60.0, True)
    assert {m for m, _ in got} == {m.name for m in metrics.METRICS}
    for metric in metrics.METRICS:
        single = {y: v for (_, y), v in values(metrics.metric_from_hourly(rows, metric.name)).items()}
        assert single == pytest.approx({y: v for (m, y), (v, _) in got.items() if m == metric.name})


def test_user_defined_metric(spark):
    rows = full_days(spark, "2023-03-01", [5.0, 7.0], group="PM2.5", parameter=88101)
    extra = metrics.Metric("pm25_best_day", "PM2.5", lambda: F.min("valid_mean"), "ug/m3", 4.0)
    assert table(metrics.design_values(rows, [extra]).select("metric", "value", "exceeds"), "metric") == [
        ("pm25_best_day", 5.0, True)
    ]


def test_each_branch_shuffles_measurements_twice(spark):
    plan = metrics.design_values(hours(spark, "2023-01-01", [1.0] * 9))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("datetime" in line for line in exchanges) == 2  # the hourly average, one per branch
    assert sum("site_name" in line for line in exchanges) == 1  # the names, distinct before they move
    windows = [line for line in plan.splitlines() if "specifiedwindowframe(RowFrame, -7" in line]
    assert len(windows) == 1
