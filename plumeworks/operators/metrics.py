"""Yearly design-value metrics.

A metric is one aggregate expression over the site-days of a year, so all metrics of all
groups come out of a single aggregation. Users add a metric by adding an entry.
"""

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.operators.clean import restrict_no2
from plumeworks.operators.series import GROUP_SITE, SITE, rolling_mean, site_days, site_names, site_series


@dataclass(frozen=True)
class Metric:
    """``expression`` aggregates site-day columns; at most 366 rows feed one site-year."""

    name: str
    group: str
    expression: Callable[[], Column]
    units: str
    level: float | None = None
    every_year: bool = False  # emit 0 for years without data between first and last year
    eight_hour: bool = False  # uses ``max_8h``, the daily peak of the 8-hour mean


def nth_highest(column, n):
    """Value at rank ``n`` from the top, ties counted separately; null with fewer values."""
    return F.get(F.sort_array(F.collect_list(column), asc=False), F.lit(n - 1))


def exceedance_days(level):
    """Days whose valid mean is above ``level``; days without a valid mean count as not above."""
    return F.count_if(F.col("valid_mean") > level).cast("double")


# --- fixed values: metric, group, units and standard level ------------------
METRICS = [
    Metric("ozone_8hr_4th_max", "Ozone", lambda: nth_highest("max_8h", 4), "ppm", 0.070,
           eight_hour=True),
    Metric("pm25_annual_mean", "PM2.5", lambda: F.avg("valid_mean"), "ug/m3", 9.0),
    Metric("pm25_24hr_p98", "PM2.5", lambda: F.percentile("valid_mean", F.lit(0.98)), "ug/m3", 35.0),
    Metric("pm10_24hr_exceedances", "PM10", lambda: exceedance_days(C.PM10_DAILY_LEVEL), "count",
           every_year=True),
    Metric("co_8hr_max", "CO", lambda: F.max("max_8h"), "ppm", 9.0, eight_hour=True),
    Metric("co_1hr_max", "CO", lambda: F.max("day_max"), "ppm", 35.0),
    Metric("so2_1hr_p99", "SO2", lambda: F.percentile("valid_max", F.lit(0.99)), "ppb", 75.0),
    Metric("no2_1hr_p98", "NOx_Family", lambda: F.percentile("valid_max", F.lit(0.98)), "ppb", 100.0),
    Metric("no2_annual_mean", "NOx_Family", lambda: F.avg("valid_mean"), "ppb", 53.0),
]
METRIC_BY_NAME = {m.name: m for m in METRICS}


def fill_years(rows, keys):
    """Give every calendar year up to the next one present a row; the added ones hold 0.

    Each row spawns the empty years that follow it, so nothing is joined or collected.
    """
    following = F.lead("year").over(Window.partitionBy(*keys).orderBy("year"))
    last = F.when(F.col("every_year"), following - 1)
    return (
        rows.withColumn("_last", F.coalesce(last, F.col("year")))
        .withColumn("_year", F.explode(F.sequence("year", "_last")))
        .withColumn("value", F.when(F.col("_year") == F.col("year"), F.col("value")).otherwise(0.0))
        .withColumn("year", F.col("_year"))
        .drop("_year", "_last")
    )


def yearly_metric(days, metric, keys=SITE):
    """One metric from site-days: ``(site, year, value)`` without empty years."""
    rows = days.groupBy(*keys, "year").agg(metric.expression().alias("value"))
    rows = fill_years(rows.withColumn("every_year", F.lit(metric.every_year)), keys).drop("every_year")
    return rows.where(F.col("value").isNotNull())


def metric_from_hourly(hourly, name, keys=SITE, min_hours=C.MIN_HOURS_DAY, min_8h=C.MIN_HOURS_8H):
    """One named metric straight from hourly rows of its group."""
    metric = METRIC_BY_NAME[name]
    rows = restrict_no2(hourly.where(F.col("pollutant_group") == metric.group))
    days = _placed_days(rows, keys, metric.eight_hour, min_hours, min_8h)
    return yearly_metric(days, metric, keys)


def _placed_days(rows, keys, eight_hour, min_hours, min_8h):
    """Site-days placed by site. The trailing window is only paid for where it is used."""
    series = site_series(rows, keys)
    if eight_hour:
        placed = rolling_mean(series, keys, min_periods=min_8h)
    else:
        placed = series.repartition(*keys)
    return site_days(placed, keys, min_hours)


def nth_highest_day(days, n=4, keys=SITE):
    """The day holding the n-th highest 8-hour maximum of each site and year."""
    w = Window.partitionBy(*keys, "year").orderBy(F.col("max_8h").desc(), "day")
    return (
        days.where(F.col("max_8h").isNotNull())
        .withColumn("_rank", F.row_number().over(w))
        .where(F.col("_rank") == n)
        .drop("_rank")
    )


def design_values(hourly, metrics=METRICS, min_hours=C.MIN_HOURS_DAY, min_8h=C.MIN_HOURS_8H):
    """All metrics of all groups, with the names of the sites."""
    groups = sorted({m.group for m in metrics})
    names = site_names(restrict_no2(hourly).where(F.col("pollutant_group").isin(*groups)), GROUP_SITE)
    return metric_values(hourly, metrics, min_hours, min_8h).join(names, GROUP_SITE, "left").select(
        "aqsid", "year", "pollutant_group", "metric", "value", "units", "naaqs_level",
        F.coalesce(F.col("value") > F.col("naaqs_level"), F.lit(False)).alias("exceeds"),
        "site_name", "county_name",
    )


def branches_of(metrics):
    """Metrics of groups with 8-hour metrics, and those of the other groups."""
    windowed = {m.group for m in metrics if m.eight_hour}
    parts = [[m for m in metrics if (m.group in windowed) == eight_hour] for eight_hour in (True, False)]
    return [part for part in parts if part]


def metric_values(hourly, metrics=METRICS, min_hours=C.MIN_HOURS_DAY, min_8h=C.MIN_HOURS_8H):
    """All metrics of all groups, one row per site, year and metric.

    Measurements are shuffled twice: the hourly average on (group, site, timestamp), then one
    on (group, site) that the window, the site-days, the yearly aggregates and the empty-year
    fill share. Groups with 8-hour metrics form one branch and the others a second one without
    the window; partition pruning gives each branch its own folders, so nothing is read twice.
    """
    rows = restrict_no2(hourly)
    branches = []
    for chosen in branches_of(metrics):
        part = rows.where(F.col("pollutant_group").isin(*sorted({m.group for m in chosen})))
        days = _placed_days(part, GROUP_SITE, any(m.eight_hour for m in chosen), min_hours, min_8h)
        branches.append(_long_values(days, chosen))
    return reduce(lambda a, b: a.unionByName(b), branches)


def _long_values(days, metrics):
    """All metrics of site-days in one aggregation, one row per metric that has a value."""
    yearly = days.groupBy(*GROUP_SITE, "year").agg(*[m.expression().alias(m.name) for m in metrics])
    entries = [
        F.struct(
            F.lit(m.group).alias("metric_group"),
            F.lit(m.name).alias("metric"),
            F.col(m.name).cast("double").alias("value"),
            F.lit(m.units).alias("units"),
            F.lit(m.level).cast("double").alias("naaqs_level"),
            F.lit(m.every_year).alias("every_year"),
        )
        for m in metrics
    ]
    long = yearly.select(*GROUP_SITE, "year", F.inline(F.array(*entries)))
    long = long.where(F.col("metric_group") == F.col("pollutant_group"))
    return fill_years(long, GROUP_SITE + ["metric"]).where(F.col("value").isNotNull()).drop("every_year", "metric_group")


def coverage(values):
    """Distinct sites, years and metrics of a design-value table."""
    return values.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("aqsid").alias("n_sites"),
        F.count_distinct("year").alias("n_years"),
        F.count_distinct("metric").alias("n_metrics"),
    )


def ordered(values):
    """Canonical output order."""
    return values.orderBy("pollutant_group", "aqsid", "year", "metric")
