"""The published tables, each built once per session and read back from the shared folder.

Every table is derived by Spark from the given ones and written under the folder that
``spark.checkpoint.dir`` names, so queries start from columnar, partitioned files with a short
lineage instead of repeating the cleaning for every question.
"""

from functools import reduce

from pyspark.sql import functions as F

from plumeworks.functions.expressions import stable_round
from plumeworks.operators import aggregates, clean, merge, metrics, registry, weather
from plumeworks.plans import bindings
from plumeworks.session import bound_tasks, settle, stored_bytes, work_folder
from plumeworks.sources import writers

# Sites of the test tables report far less than hourly, so the published tables accept any
# measured hour; the completeness rules at their defaults have their own queries.
SPARSE_MIN_HOURS = 1
SPARSE_THRESHOLD = 1.0 / 24.0

# Table: (partition columns, sort within a partition), after what queries filter on.
LAYOUT = {
    "hourly": (["pollutant_group", "year"], ["aqsid", "datetime"]),
    "weather": (["location", "year"], ["dt"]),
    "daily": (["pollutant_group"], ["aqsid", "date_local"]),
    "combined": (["pollutant_group"], ["aqsid", "date_local"]),
}


# Tables whose rows their build places for the write.
PLACED = {"hourly", "daily", "combined"}


class Tables:
    """Lazily published tables over one data folder."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = work_folder(spark, "tables")
        self.done = set()
        self.input_bytes = stored_bytes(spark, [f"{sf_dir}/{name}.parquet" for name in bindings.TABLES])

    def raw(self):
        return bindings.raw_measurements(self.spark, self.sf_dir)

    def raw_weather(self):
        return bindings.raw_weather(self.spark, self.sf_dir)

    def coordinate_sources(self, complete=False):
        return bindings.site_coordinate_sources(self.spark, self.sf_dir, complete)

    def get(self, name):
        path = f"{self.root}/{name}"
        if name not in self.done:
            df = getattr(self, f"_build_{name}")()
            if name in LAYOUT:
                writers.write_partitioned(df, path, *LAYOUT[name], placed=name in PLACED)
            else:
                writers.write_table(df, path)
            self.done.add(name)
        return self.spark.read.parquet(path)

    def once(self, name):
        """A table for a single use: as published if it is, else its rows without storing them."""
        return self.get(name) if name in self.done else getattr(self, f"_build_{name}")()

    def hourly_of(self, groups):
        """Hourly rows of some groups for a single use; unless published, they are chosen before rows are cleaned and placed."""
        chosen = F.col("pollutant_group").isin(*sorted(groups))
        if "hourly" in self.done:
            return self.get("hourly").where(chosen)
        return clean.clean_measurements(self.raw().where(chosen))

    def _build_hourly(self):
        return clean.clean_measurements(self.raw())

    def _build_weather(self):
        return weather.build_weather(self.raw_weather())

    def _build_weather_daily(self):
        return weather.daily_weather(self.get("weather"))

    def _build_daily(self):
        return aggregates.daily_stats(self.get("hourly"), SPARSE_THRESHOLD)

    def _build_monthly(self):
        if "daily" in self.done:
            return aggregates.monthly_stats(self.get("daily"))
        return aggregates.monthly_stats(aggregates.daily_stats(self.get("hourly"), SPARSE_THRESHOLD, month=True))

    def _build_values(self):
        return metrics.design_values(self.get("hourly"), min_hours=SPARSE_MIN_HOURS)

    def metric_values(self):
        """The design values without names of sites; they are not stored, and neither are the hourly rows for them alone."""
        if "values" in self.done:
            return self.get("values")
        parts = [
            metrics.metric_values(self.hourly_of({m.group for m in part}), part, min_hours=SPARSE_MIN_HOURS)
            for part in metrics.branches_of(metrics.METRICS)
        ]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _build_coords(self):
        return merge.prefer_first(self.coordinate_sources(), "aqsid", ["lat", "lon"])

    def _build_pairing(self):
        return merge.pair_sites(self.get("hourly"), self.get("weather"), self.get("coords"))

    def _build_combined(self):
        return merge.combine(self.get("daily"), self.get("pairing"), self.get("weather_daily"))

    def _build_registry(self):
        return registry.site_registry(self.raw(), self.get("coords"))

    def combined_of(self, site):
        """Combined rows of a site for a single use; unless published, its rows are chosen before they are cleaned and folded to days."""
        chosen = F.col("aqsid") == site
        if "combined" in self.done:
            return self.get("combined").where(chosen)
        if "daily" in self.done:
            daily = self.get("daily").where(chosen)
        else:
            hourly = self.get("hourly").where(chosen) if "hourly" in self.done else clean.clean_measurements(self.raw().where(chosen))
            daily = settle(aggregates.daily_stats(hourly, SPARSE_THRESHOLD), "site-days")
        return merge.combine(daily, merge.pair_sites(daily, self.get("weather"), self.get("coords")), self.get("weather_daily"))

    def hourly_weather(self):
        return merge.hourly_with_weather(self.get("hourly"), self.get("weather"), self.get("pairing"))


_OPEN = {}


def tables(spark, sf_dir):
    """The table set of this session and data folder."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Tables(spark, sf_dir)
    bound_tasks(spark, _OPEN[key].input_bytes)
    return _OPEN[key]


def tidy(df, digits=6):
    """Round every double column so results do not depend on the order of float sums."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[stable_round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])
