"""Site registry: active sites from raw rows, plus known sites without measurements."""

from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.functions.expressions import inline_table


def active_sites(raw):
    """One row per site with networks, pollutants, date span and record count.

    Rows are first folded to the few distinct (site, source, group, name) combinations with a
    hash aggregate; the text minima and sets then see a handful of rows per site.
    """
    site = ["aqsid", "state_code", "county_code", "site_number"]
    day = F.col("date_local").try_cast("date")
    folded = raw.groupBy(*site, "site_name", "county_name", "data_source", "pollutant_group").agg(
        F.min(day).alias("_first"), F.max(day).alias("_last"), F.count("*").alias("_n")
    )
    grouped = folded.groupBy(*site).agg(
        F.min("site_name").alias("site_name"),
        F.min(F.initcap("county_name")).alias("county_name"),
        F.array_sort(F.collect_set("data_source")).alias("_networks"),
        F.array_sort(F.collect_set("pollutant_group")).alias("_groups"),
        F.min("_first").cast("string").alias("first_date"),
        F.max("_last").cast("string").alias("last_date"),
        F.sum("_n").alias("n_records"),
    )
    network = F.when(F.size("_networks") > 1, "BOTH").otherwise(F.array_join("_networks", ""))
    return grouped.select(
        "aqsid", "state_code", "county_code", "site_number", "site_name", "county_name",
        network.alias("network"),
        F.array_join("_groups", ";").alias("pollutants"),
        F.size("_groups").alias("n_pollutants"),
        "first_date", "last_date", "n_records",
        F.lit("active").alias("data_status"),
        F.lit("").alias("co_located_with"),
        F.lit("").alias("notes"),
    )


def static_sites(spark, active):
    """Registered sites without data; an excluded site that turns out active is left out."""
    names = ["aqsid", "county_code", "site_number", "site_name", "county_name", "pollutants",
             "data_status", "notes"]
    rows = inline_table(spark, names, C.STATIC_REGISTRY_ROWS).select(
        "aqsid", F.lit(48).alias("state_code"), "county_code", "site_number", "site_name",
        "county_name", F.lit("TCEQ").alias("network"), "pollutants", F.lit(0).alias("n_pollutants"),
        F.lit(None).cast("string").alias("first_date"), F.lit(None).cast("string").alias("last_date"),
        F.lit(0).cast("long").alias("n_records"), "data_status",
        F.lit("").alias("co_located_with"), "notes",
    )
    taken = active.where(F.col("aqsid").isin(*[r[0] for r in C.STATIC_REGISTRY_ROWS])).select("aqsid")
    excluded = F.col("data_status") == "excluded"
    return rows.where(~excluded).unionByName(rows.where(excluded).join(taken, "aqsid", "left_anti"))


def site_registry(raw, coords):
    """Active and static sites with coordinates, in registry column order."""
    active = active_sites(raw)
    sites = active.unionByName(static_sites(raw.sparkSession, active))
    return sites.join(coords, "aqsid", "left").select(*C.REGISTRY_COLUMNS)


def ordered(registry):
    """Canonical output order."""
    return registry.orderBy("data_status", "county_name", "aqsid")
