"""Site pairing and the combined pollutant + weather table."""

from functools import reduce

from pyspark.sql import functions as F

from plumeworks.operators.geo import county_fallback, nearest_station
from plumeworks.operators.series import site_names
from plumeworks.operators.weather import daily_weather, station_coordinates
from plumeworks.session import settle


HOT_ROWS = 100_000  # left rows of a join key that one task takes


def prefer_first(sources, key, columns):
    """One row per key from several sources, the earliest source that knows the key wins."""
    tagged = [s.select(key, *columns).withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    every = reduce(lambda a, b: a.unionByName(b), tagged)
    best = F.min(F.struct("_source", *columns)).alias("_best")
    return every.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in columns])


def keep_first(df, key, order):
    """The first row of each key by ``order``, then by the other columns (nulls first): a minimum, folded before the shuffle."""
    rest = [c for c in df.columns if c not in {*key, *order}]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*key).agg(first).select(*[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def join_with_hot_keys(left, right, keys, limit=HOT_ROWS):
    """Inner equi join where a key may hold most of the left rows.

    Left rows are counted per key first. A key with more than ``limit`` rows is spread over as many
    parts as that takes, and its right rows are repeated for each part; other keys are joined
    plainly. So a task's share does not depend on splitting at run time. Hot keys are at most left rows / ``limit``.
    """
    counts = left.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    hot = settle(counts.select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_parts")), "hot-keys")
    parts = F.coalesce("_parts", F.lit(1))
    own = left.join(hot, keys, "left").withColumn("_part", F.pmod(F.xxhash64(*left.columns), parts).cast("int"))
    copies = right.join(hot, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return own.drop("_parts").join(copies.drop("_parts"), [*keys, "_part"]).drop("_part")


def attach_coordinates(sites, coords):
    """Left join of coordinates; Spark broadcasts the small side by its measured size."""
    return sites.join(coords, "aqsid", "left")


def pair_sites(rows, weather, coords):
    """Site to weather station: nearest by distance, else by county name, else null.

    The sites are those of ``rows``; hourly and daily rows name the same ones.
    """
    stations = settle(station_coordinates(weather), "stations")
    sites = settle(attach_coordinates(site_names(rows), coords), "sites")
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    names = ["aqsid", "site_name", "county_name"]
    near = nearest_station(sites.where(located), stations).select(*names, "weather_station", "distance_km")
    lost = sites.where(~located)
    by_county = lost.join(county_fallback(lost, stations), "county_name", "left").select(
        *names, "weather_station", F.lit(None).cast("double").alias("distance_km")
    )
    return near.unionByName(by_county)


def keep_paired(daily, pairing):
    """Attach each site's station to its daily rows; rows of sites without one are dropped."""
    keyed = daily.join(pairing.select("aqsid", "weather_station", "distance_km"), "aqsid", "left")
    return keyed.where(F.col("weather_station").isNotNull())


def combine(daily, pairing, weather_days):
    """Paired daily rows with their station's weather that day; no weather leaves nulls."""
    return keep_paired(daily, pairing).join(weather_days, ["weather_station", "date_local"], "left")


def combined_daily(daily, weather, coords):
    """Pairing, daily weather and both joins."""
    return combine(daily, pair_sites(daily, weather, coords), daily_weather(weather))


def hourly_with_weather(hourly, weather, pairing, hot_rows=None):
    """Hourly measurements with the weather of the same local hour at the paired station.

    The store holds one weather row per station and hour, so the join adds columns, not rows. Hours that hold
    more than ``hot_rows`` measurements are spread, if it is given.
    """
    keyed = hourly.join(pairing.select("aqsid", "weather_station"), "aqsid")
    wx = weather.withColumn("datetime", F.col("datetime_local").try_cast("timestamp_ntz"))
    keep = [c for c in wx.columns if c not in set(keyed.columns) - {"datetime"}]
    wx = wx.select(*keep).withColumnRenamed("location", "weather_station")
    on = ["weather_station", "datetime"]
    return join_with_hot_keys(keyed, wx, on, hot_rows) if hot_rows else keyed.join(wx, on)


def compare_published(values, published, ours="value", theirs="published_value", key=("aqsid",)):
    """Difference in percent against a published table, for keys in both."""
    return values.join(published, list(key)).withColumn(
        "diff_pct", (F.col(ours) - F.col(theirs)) / F.col(theirs) * 100
    )
