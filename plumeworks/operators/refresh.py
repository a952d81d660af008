"""Refresh inputs mapped onto the measurement schema."""

from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.functions.expressions import inline_table, site_id, zero_fill


def _lookup(df, names, rows, on):
    """Left join against a literal table (fixed length, so broadcasting it is safe)."""
    return df.join(F.broadcast(inline_table(df.sparkSession, names, rows)), on, "left")


def name_parameters(df):
    """Pollutant name and group from the parameter code; unknown codes keep the code as name."""
    found = _lookup(df, ["parameter_code", "_name", "_group"], C.PARAMETERS, "parameter_code")
    return found.select(
        *df.columns,
        F.coalesce("_name", F.col("parameter_code").cast("string")).alias("pollutant_name"),
        F.coalesce("_group", F.lit("")).alias("pollutant_group"),
    )


def name_counties(df):
    """County name from the county code, empty when unknown."""
    found = _lookup(df, ["county_code", "_county"], C.COUNTIES, "county_code")
    return found.select(*df.columns, F.coalesce("_county", F.lit("")).alias("county_name"))


def name_sites(df, fallback):
    """Canonical site name, else the fallback expression."""
    found = _lookup(df, ["aqsid", "_site"], C.SITE_NAMES, "aqsid")
    return found.select(*df.columns, F.coalesce(F.col("_site"), fallback).alias("site_name"))


def unknown_sites(df):
    """Distinct ids that have no canonical name."""
    known = F.broadcast(inline_table(df.sparkSession, ["aqsid", "_site"], C.SITE_NAMES))
    return df.select("aqsid").distinct().join(known, "aqsid", "left_anti")


def number(column, kind="int"):
    """A column coerced to a number, bad text becoming null."""
    return F.col(column).try_cast("double").try_cast(kind)


def numeric(columns, kind="int"):
    """Columns coerced to numbers under their names."""
    return [number(c, kind).alias(c) for c in columns]


CODES = ["state_code", "county_code", "site_number", "parameter_code", "poc", "method_code"]


def from_transactions(raw, pollutant_group):
    """Transaction rows to measurement rows.

    Values keep their native unit: the unit conversion belongs to the store build and must
    happen once. A field that cannot be read is null; ``transactions_and_rejects`` reports it.
    """
    named = raw.select(
        *[number(source).alias(name) for source, name in (
            ("state", "state_code"), ("county", "county_code"), ("site", "site_number"), ("param", "parameter_code"), ("poc", "poc"))],
        F.try_to_date("date", "yyyyMMdd").cast("string").alias("date_local"),
        zero_fill(F.col("time"), 5).alias("time_local"),
        number("value", "double").alias("sample_measurement"),
        number("meth").alias("method_code"),
    ).withColumn("aqsid", site_id("state_code", "county_code", "site_number"))
    named = name_counties(name_parameters(named).drop("pollutant_group"))
    named = name_sites(named, F.concat(F.lit("UNKNOWN_"), F.col("aqsid")))
    return named.select(
        "*", F.lit("TCEQ").alias("data_source"), F.lit(pollutant_group).alias("pollutant_group")
    ).select(*C.MEASUREMENT_COLUMNS)


def from_api(records):
    """API records to measurement rows; null measurements and retired sensors are dropped."""
    rows = records.select(
        *numeric(CODES), "date_local", "time_local", *numeric(["sample_measurement"], "double")
    ).withColumn("aqsid", site_id("state_code", "county_code", "site_number"))
    rows = name_counties(name_parameters(rows))
    number = F.coalesce(F.col("site_number"), F.lit(0)).cast("string")
    legacy = F.concat(F.col("county_name"), F.lit("_"), zero_fill(number, 4))
    rows = name_sites(rows, legacy).withColumn("data_source", F.lit("EPA"))
    kept = drop_dead_sensors(rows.where(F.col("sample_measurement").isNotNull()))
    return kept.select(*C.MEASUREMENT_COLUMNS)


def drop_dead_sensors(df, sensors=C.DEAD_SENSORS):
    """Drop rows whose (site, group) or (site, name) is retired: two equi anti joins."""
    dead = F.broadcast(inline_table(df.sparkSession, ["_site", "_pollutant"], sensors))
    for column in ("pollutant_group", "pollutant_name"):
        df = df.join(dead, (df["aqsid"] == dead["_site"]) & (df[column] == dead["_pollutant"]), "left_anti")
    return df


def pull_summary(raw, kept):
    """Per county and parameter: rows received, rows kept, sites kept."""
    keys = ["county_code", "parameter_code"]
    received = raw.select(*numeric(keys)).groupBy(*keys).agg(F.count("*").alias("rows_raw"))
    stored = kept.groupBy(*keys).agg(
        F.count("*").alias("rows_kept"), F.count_distinct("aqsid").alias("n_sites")
    )
    return received.join(stored, keys, "left").select(
        *keys, "rows_raw",
        F.coalesce("rows_kept", F.lit(0)).alias("rows_kept"),
        F.coalesce("n_sites", F.lit(0)).alias("n_sites"),
    )
