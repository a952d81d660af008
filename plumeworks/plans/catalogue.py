"""Analyst queries over the published tables. Parameters stand for what an analyst would type."""

from functools import reduce

from pyspark.sql import functions as F

from plumeworks.functions.expressions import join_same, season_of, stable_round, wind_sector
from plumeworks.operators.quantiles import exact_quantiles, moments, quantiles_of, value_counts
from plumeworks.operators.series import rolling_mean_of_rows

OZONE = "ozone_8hr_4th_max"


# --- design values ---------------------------------------------------------------
def exceeding_sites(values, year, metric=OZONE):
    """Sites above the standard in a year, worst first."""
    hit = values.where((F.col("year") == year) & (F.col("metric") == metric) & F.col("exceeds"))
    return hit.select("aqsid", "site_name", "county_name", "value", "naaqs_level").orderBy(F.desc("value"))


def site_trend(values, aqsid, metric=OZONE):
    """One metric of one site over the years."""
    hit = values.where((F.col("aqsid") == aqsid) & (F.col("metric") == metric))
    return hit.select("year", F.col("value").alias("fourth_max")).orderBy("year")


def county_years(values, metric=OZONE):
    """Sites, average and maximum per county and year."""
    return (
        values.where(F.col("metric") == metric)
        .groupBy("year", "county_name")
        .agg(
            F.count("*").alias("n_sites"),
            stable_round(F.avg("value"), 4).alias("avg_value"),
            stable_round(F.max("value"), 4).alias("max_value"),
        )
        .orderBy("year", "county_name")
    )


def county_means(values, year, metric=OZONE):
    """Mean value per county in a year, highest first."""
    hit = values.where((F.col("year") == year) & (F.col("metric") == metric))
    return hit.groupBy("county_name").agg(F.avg("value").alias("mean_val")).orderBy(F.desc("mean_val"))


def exceedance_counts(values):
    """Groups, metrics and years in which at least one site exceeds."""
    counted = values.groupBy("pollutant_group", "metric", "year").agg(
        F.count_if("exceeds").alias("n_exceeding_sites"), F.count("*").alias("n_sites")
    )
    return counted.where("n_exceeding_sites > 0").orderBy("pollutant_group", "metric", "year")


def above_level(values, metric, year, level):
    """Site-years above a level of the analyst's choice."""
    hit = values.where(
        (F.col("metric") == metric) & (F.col("year") == year) & (F.col("value") > level)
    )
    return hit.select("aqsid", "site_name", "county_name", "value").orderBy(F.desc("value"))


def dashboard(values, pattern="p98|p99|4th_max|annual|exceedances"):
    """Per year and metric: sites, exceedances, maximum and mean."""
    return (
        values.where(F.col("metric").rlike(pattern))
        .groupBy("year", "metric")
        .agg(
            F.count_distinct("aqsid").alias("n_sites"),
            F.count_if("exceeds").alias("n_exceed"),
            stable_round(F.max("value"), 4).alias("max_val"),
            stable_round(F.avg("value"), 4).alias("mean_val"),
        )
        .orderBy("metric", "year")
    )


def map_values(values, registry, year, metric=OZONE):
    """Values of a year with coordinates of active sites."""
    located = registry.where((F.col("data_status") == "active") & F.col("lat").isNotNull())
    hit = values.where((F.col("metric") == metric) & (F.col("year") == year))
    return hit.join(located.select("aqsid", "lat", "lon"), "aqsid")


def yearly_county_maximum(values, county, metric=OZONE):
    """Highest design value of a county per year."""
    hit = values.where((F.col("county_name") == county) & (F.col("metric") == metric))
    return hit.groupBy("year").agg(F.max("value").alias("max_value")).orderBy("year")


def classified(values, metric=OZONE):
    """Each value labelled as exceeding or under the standard."""
    label = F.when(F.col("exceeds"), "Exceeds").otherwise("Under")
    return values.where(F.col("metric") == metric).select(
        "aqsid", "county_name", "year", "value", label.alias("status")
    )


def since_year(values, year, metric=OZONE):
    """Values since a year, newest and highest first."""
    hit = values.where((F.col("metric") == metric) & (F.col("year") >= year))
    return hit.select("county_name", "site_name", "year", "value", "naaqs_level", "exceeds").orderBy(
        F.desc("year"), F.desc("value")
    )


# --- daily and monthly tables --------------------------------------------------------
def _valid(daily, group):
    return daily.where((F.col("pollutant_group") == group) & F.col("valid_day"))


def county_months(daily, group, county):
    """Mean of valid daily means per month in a county."""
    return (
        _valid(daily, group)
        .where(F.col("county_name") == county)
        .groupBy(F.trunc(F.to_date("date_local"), "month").alias("month"))
        .agg(stable_round(F.avg("mean"), 2).alias("mean_value"), F.count("*").alias("n_site_days"))
        .orderBy("month")
    )


def summer_and_winter(daily, group):
    """Summer and winter means per county."""
    seasons = _valid(daily, group).withColumn("month", F.month(F.to_date("date_local")))
    seasons = seasons.withColumn("season", season_of("month")).where(F.col("season").isin("JJA", "DJF"))
    return (
        seasons.groupBy("county_name", "season")
        .agg(stable_round(F.avg("mean"), 2).alias("mean_value"))
        .orderBy("county_name", "season")
    )


def season_table(daily, group, counties):
    """Counties by seasons."""
    rows = _valid(daily, group).where(F.col("county_name").isin(*counties))
    rows = rows.withColumn("month", F.month(F.to_date("date_local"))).withColumn("season", season_of("month"))
    return (
        rows.groupBy("county_name")
        .pivot("season", ["DJF", "MAM", "JJA", "SON"])
        .agg(stable_round(F.avg("mean"), 2))
    )


def county_annual_means(daily, group):
    """Mean of valid daily means per county and year."""
    return (
        _valid(daily, group)
        .groupBy(F.year(F.to_date("date_local")).alias("year"), "county_name")
        .agg(F.avg("mean").alias("annual_mean"))
    )


def county_subset(daily, group, county):
    """Rows of one group and county for sharing."""
    rows = _valid(daily, group).where(F.col("county_name") == county)
    return rows.select("aqsid", "site_name", "date_local", "mean", "n_hours", "completeness_pct")


def month_matrix(monthly, group, county, months):
    """Sites by months; a site with several parameters in a month gets their mean."""
    rows = monthly.where(
        (F.col("pollutant_group") == group)
        & (F.col("county_name") == county)
        & F.col("year_month").between(months[0], months[-1])
    )
    return rows.groupBy("site_name").pivot("year_month", months).agg(F.avg("monthly_mean"))


def county_month_means(monthly, group, county, first, last):
    """Monthly means averaged over the sites of a county."""
    rows = monthly.where(
        (F.col("county_name") == county)
        & (F.col("pollutant_group") == group)
        & F.col("year_month").between(first, last)
    )
    return rows.groupBy("year_month").agg(F.avg("monthly_mean").alias("mean_value")).orderBy("year_month")


# --- combined pollutant + weather table -------------------------------------------------
def site_weather_days(combined, aqsid, group):
    """Valid daily rows of a site with the weather of the day."""
    rows = combined.where(
        (F.col("aqsid") == aqsid) & (F.col("pollutant_group") == group) & F.col("valid_day")
    )
    return rows.select(
        "date_local", F.col("mean").alias("pollutant_mean"), "temp_c", "humidity", "wind_speed"
    ).orderBy("date_local")


def pairing_distances(combined):
    """Distinct site and station pairs, longest distance first."""
    cols = ["aqsid", "site_name", "county_name", "weather_station", "distance_km"]
    return combined.select(*cols).distinct().orderBy(F.desc("distance_km"))


def weather_correlations(combined, aqsid, minimum=100):
    """Correlation of the daily mean with weather per group, given enough valid days."""
    rows = combined.where((F.col("aqsid") == aqsid) & F.col("valid_day"))
    out = rows.groupBy("pollutant_group").agg(
        F.count("*").alias("n_days"),
        *[stable_round(F.corr("mean", c), 3).alias(f"r_{c}") for c in ("temp_c", "humidity", "wind_speed")],
    )
    return out.where(F.col("n_days") > minimum)


def site_month_means(combined, aqsid, group):
    """Monthly means of pollutant and temperature at a site."""
    rows = combined.where((F.col("aqsid") == aqsid) & (F.col("pollutant_group") == group))
    return (
        rows.groupBy(F.substring("date_local", 1, 7).alias("ym"))
        .agg(F.avg("mean").alias("mean_value"), F.avg("temp_c").alias("mean_temp"))
        .orderBy("ym")
    )


# --- hourly tables --------------------------------------------------------------------------
def parameter_profile(hourly, group, aqsid=None, top=20):
    """Rows, mean, 95th percentile and maximum per parameter, highest means first."""
    rows = hourly.where(F.col("pollutant_group") == group)
    if aqsid:
        rows = rows.where(F.col("aqsid") == aqsid)
    counted = value_counts(rows, ["parameter_code"], "sample_measurement")
    stats = moments(counted, ["parameter_code"]).withColumnRenamed("n_rows", "n_obs")
    p95 = quantiles_of(counted, ["parameter_code"], {"p95": 0.95})
    out = join_same(stats, p95, ["parameter_code"], "left").orderBy(F.desc("mean")).limit(top)
    return out.select(
        "parameter_code", "n_obs", *[stable_round(c, 3).alias(c) for c in ("mean", "p95", "max")]
    )


def diurnal_profile(hourly, group, years, aqsid=None):
    """Mean, median and 95th percentile by hour of day."""
    value = "sample_measurement"
    rows = hourly.where(
        (F.col("pollutant_group") == group) & F.col("year").isin(*years) & F.col(value).isNotNull()
    )
    if aqsid:
        rows = rows.where(F.col("aqsid") == aqsid)
    keys = ["hour_of_day"]
    counted = value_counts(rows.select(F.hour("datetime").alias("hour_of_day"), value), keys, value)
    means = moments(counted, keys).select(*keys, F.col("mean").alias("mean_value"))
    spread = quantiles_of(counted, keys, {"median_value": 0.5, "p95_value": 0.95})
    return join_same(means, spread, keys).orderBy("hour_of_day")


def station_month(weather, location, year, month):
    """Hourly weather of one station in one month."""
    rows = weather.where(
        (F.col("location") == location) & (F.col("year") == year) & (F.col("month") == month)
    )
    ts = F.col("datetime_local").try_cast("timestamp_ntz").alias("ts")
    return rows.select(ts, "temp_c", "humidity", "wind_speed", "wind_deg", "pressure").orderBy("ts")


def peak_days(hourly, group, year, top=20):
    """Site-days with the highest hourly value."""
    rows = hourly.where(
        (F.col("pollutant_group") == group)
        & (F.col("year") == year)
        & F.col("sample_measurement").isNotNull()
    )
    peaks = rows.groupBy("date_local", "county_name", "site_name").agg(
        F.max("sample_measurement").alias("_peak")
    )
    best = peaks.orderBy(F.desc("_peak"), "date_local", "site_name").limit(top)
    return best.select("date_local", "county_name", "site_name", stable_round("_peak", 1).alias("peak"))


def regression_rows(joined, aqsid, group, first, last):
    """Hourly measurement and weather rows of a site between two dates."""
    rows = joined.where(
        (F.col("aqsid") == aqsid)
        & (F.col("pollutant_group") == group)
        & F.col("date_local").between(first, last)
    )
    return rows.select(
        "datetime", F.col("sample_measurement").alias("measurement"),
        "temp_c", "humidity", "wind_speed", "wind_u", "wind_v",
    )


def regression_correlations(rows):
    """Correlation of the measurement with every weather column."""
    cols = ("temp_c", "humidity", "wind_speed", "wind_u", "wind_v")
    return rows.agg(*[stable_round(F.corr("measurement", c), 3).alias(f"r_{c}") for c in cols])


def eight_hour_peaks(hourly, aqsid, group, year, top=5):
    """Highest daily 8-hour means of a site from its non-null rows of one year."""
    rows = hourly.where(
        (F.col("aqsid") == aqsid)
        & (F.col("pollutant_group") == group)
        & (F.col("year") == year)
        & F.col("sample_measurement").isNotNull()
    )
    rolled = rolling_mean_of_rows(rows).where(F.col("mean_8h").isNotNull())
    daily = rolled.groupBy(F.to_date("datetime").alias("day")).agg(F.max("mean_8h").alias("_max"))
    best = daily.orderBy(F.desc("_max"), "day").limit(top)
    return best.select("day", stable_round("_max", 4).alias("daily_max_8h"))


def manuscript_table(hourly):
    """Per group: sites, years, observations, mean, extremes and deviation."""
    value = "sample_measurement"
    rows = hourly.where(F.col(value).isNotNull())
    per_site_year = rows.groupBy("pollutant_group", "aqsid", F.year("datetime").alias("y")).agg(
        F.count("*").alias("n"), F.sum(value).alias("s"), F.min(value).alias("lo"), F.max(value).alias("hi")
    )
    # Distinct sites and years are counted on the folded rows; the deviation needs the raw ones.
    counted = per_site_year.groupBy("pollutant_group").agg(
        F.count_distinct("aqsid").alias("n_sites"),
        F.count_distinct("y").alias("n_years"),
        F.sum("n").alias("n_observations"),
        stable_round(F.sum("s") / F.sum("n"), 4).alias("mean"),
        stable_round(F.min("lo"), 4).alias("min"),
        stable_round(F.max("hi"), 4).alias("max"),
    )
    spread = rows.groupBy("pollutant_group").agg(stable_round(F.stddev_samp(value), 4).alias("sd"))
    return join_same(counted, spread, ["pollutant_group"]).orderBy("pollutant_group")


def pollution_rose(joined, group, aqsid=None, calm=1.0):
    """Mean measurement by wind sector, calm hours left out."""
    rows = joined.where((F.col("pollutant_group") == group) & (F.col("wind_speed") > calm))
    if aqsid:
        rows = rows.where(F.col("aqsid") == aqsid)
    return (
        rows.groupBy(wind_sector("wind_deg").alias("wind_dir"))
        .agg(F.avg("sample_measurement").alias("mean_value"), F.count("*").alias("n"))
        .orderBy(F.desc("mean_value"))
    )


def table_inventory(tables):
    """Row count of every table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts).orderBy(F.desc("n_rows"))


def non_null_rates(hourly):
    """Rows, sites and share of non-null measurements per group."""
    per_site = hourly.groupBy("pollutant_group", "aqsid").agg(
        F.count("*").alias("n"), F.count("sample_measurement").alias("k")
    )
    rate = F.sum("k") / F.sum("n") * 100
    return (
        per_site.groupBy("pollutant_group")
        .agg(
            F.sum("n").alias("n_rows"),
            F.count("aqsid").alias("n_sites"),
            stable_round(rate, 2).alias("pct_non_null"),
        )
        .orderBy(F.desc("n_rows"))
    )


QUANTILES = {"p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def descriptives(hourly):
    """Group by county by year: count, mean, deviation, quantiles and maximum."""
    keys, value = ["pollutant_group", "county_name", "year"], "sample_measurement"
    rows = hourly.where(F.col(value).isNotNull())
    rows = rows.withColumn("year", F.year(F.to_date("date_local"))).select(*keys, value)
    counted = value_counts(rows, keys, value)
    stats = moments(counted, keys).withColumnRenamed("n_rows", "n_obs")
    out = join_same(stats, quantiles_of(counted, keys, QUANTILES), keys)
    rounded = [stable_round(c, 4).alias(c) for c in ("mean", "sd", *QUANTILES, "max")]
    return out.select(*keys, "n_obs", *rounded).orderBy(*keys)


def county_order(hourly, group, years, low=0.0, high=200.0):
    """Counties by median of the plausible values, highest first."""
    value = "sample_measurement"
    rows = hourly.where(
        (F.col("pollutant_group") == group) & F.col("year").isin(*years) & F.col(value).between(low, high)
    )
    return exact_quantiles(rows, ["county_name"], value, {"median_value": 0.5}).orderBy(F.desc("median_value"))


def partition_counts(hourly):
    """Rows per store partition; only partition columns are touched."""
    return hourly.groupBy("pollutant_group", "year").agg(F.count("*").alias("n_rows"))


# --- registry -----------------------------------------------------------------------------------
def co_located(registry):
    """Sites that name a co-located one."""
    cols = ["co_located_with", "aqsid", "site_name", "county_name", "lat", "lon", "data_status"]
    return registry.where(F.col("co_located_with") != "").select(*cols).orderBy("co_located_with", "aqsid")


def status_counts(registry):
    """Sites per status."""
    return registry.groupBy("data_status").agg(F.count("*").alias("n_sites")).orderBy(F.desc("n_sites"))


def county_networks(registry):
    """Active sites: counties by network."""
    rows = registry.where(F.col("data_status") == "active")
    table = rows.groupBy("county_name").pivot("network", ["BOTH", "EPA", "TCEQ"]).agg(F.count("aqsid"))
    return table.fillna(0, ["BOTH", "EPA", "TCEQ"])


def coverage_summary(registry, rows, group="PM2.5"):
    """Sites, counties and networks of the study with the date span and groups of its hourly or daily rows."""
    active = registry.where(F.col("data_status") == "active")
    def networks(name):
        return F.count_if(F.col("network") == name)
    day = F.when(F.col("pollutant_group") == group, F.to_date("date_local"))
    spans = rows.groupBy("pollutant_group").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return active.agg(
        F.count("*").alias("n_sites"),
        F.count_distinct("county_name").alias("n_counties"),
        networks("EPA").alias("n_epa"),
        networks("TCEQ").alias("n_tceq"),
        networks("BOTH").alias("n_both"),
    ).select(
        "*",
        spans.agg(F.min("lo").cast("string")).scalar().alias("date_min"),
        spans.agg(F.max("hi").cast("string")).scalar().alias("date_max"),
        spans.agg(F.array_join(F.array_sort(F.collect_set("pollutant_group")), ", ")).scalar().alias("pollutants"),
    )
