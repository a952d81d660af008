"""Cleaning of raw measurements: dedup, exclusion, units, time columns."""

from functools import reduce

from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.functions.expressions import all_of, inline_table, local_timestamp, season_of
from plumeworks.session import shuffle_partitions


def drop_exact_duplicates(df):
    """Remove rows equal in every column (nulls equal).

    Rows are placed first: a table of wide rows before the shuffle removes few of them and may not fit in memory.
    """
    return df.repartition(*df.columns).dropDuplicates()


def drop_exact_duplicates_by_folder(df):
    """:func:`drop_exact_duplicates` with the rows of a (group, year) placed together in a bounded number of parts.

    So a partitioned write needs no second shuffle. A folder is spread over an eighth of the shuffle partitions, by key,
    so its size does not bind one task.
    """
    parts = max(1, shuffle_partitions(df.sparkSession) // 8)
    marked = df.withColumns({"_year": F.substring("date_local", 1, 4), "_part": F.pmod(F.xxhash64(*C.APPEND_KEY), F.lit(parts))})
    return marked.repartition("pollutant_group", "_year", "_part").dropDuplicates().drop("_year", "_part")


def exclude_rows(df, rules=C.OUT_OF_SCOPE_RULES):
    """Drop rows matching a rule in full. Null never matches; a rule on an absent column is off."""
    usable = [r for r in rules if set(r) <= set(df.columns)]
    matches = [all_of([F.col(c).cast("string") == str(v) for c, v in r.items()]) for r in usable]
    return reduce(lambda d, m: d.where(~F.coalesce(m, F.lit(False))), matches, df)


def convert_units(df, rules=C.UNIT_CONVERSIONS):
    """Multiply measurements by the factor of their (parameter, source); the rule list is code."""
    if not rules or not {"parameter_code", "data_source"} <= set(df.columns):
        return df
    table = inline_table(df.sparkSession, ["parameter_code", "data_source", "_factor"], rules)
    joined = df.join(F.broadcast(table), ["parameter_code", "data_source"], "left")
    value = F.col("sample_measurement") * F.coalesce(F.col("_factor"), F.lit(1.0))
    return joined.withColumn("sample_measurement", value).select(*df.columns)


def derive_time(df):
    """Add datetime, year, month, hour and season; rows without a parseable time are dropped."""
    return (
        df.withColumn("datetime", local_timestamp("date_local", "time_local"))
        .where(F.col("datetime").isNotNull())
        .withColumn("year", F.year("datetime"))
        .withColumn("month", F.month("datetime"))
        .withColumn("hour", F.hour("datetime"))
        .withColumn("season", season_of("month"))
    )


def title_county(df):
    """County names in title case."""
    return df.withColumn("county_name", F.initcap("county_name"))


def restrict_no2(df):
    """Within the NOx family only NO2 counts for the metrics; other groups pass."""
    keep = (F.col("pollutant_group") != "NOx_Family") | (F.col("parameter_code") == C.NO2_PARAMETER)
    return df.where(keep)


def clean_measurements(raw, rules=C.OUT_OF_SCOPE_RULES, units=C.UNIT_CONVERSIONS):
    """Raw rows to hourly store rows: one shuffle (the dedup), the rest is row-local.

    The rows come out placed by store folder, to be written without another shuffle.
    """
    return title_county(derive_time(convert_units(exclude_rows(drop_exact_duplicates_by_folder(raw), rules), units)))


def build_stats(raw, clean, by):
    """Rows in and out, sites and years per group or file."""
    before = raw.groupBy(by).agg(F.count("*").alias("rows_in"))
    after = clean.groupBy(by).agg(
        F.count("*").alias("rows_out"),
        F.count_distinct("aqsid").alias("n_sites"),
        F.array_join(F.array_sort(F.collect_set("year")).cast("array<string>"), ",").alias("years"),
    )
    return before.join(after, by, "left").select(
        by,
        "rows_in",
        F.coalesce("rows_out", F.lit(0)).alias("rows_out"),
        F.coalesce("n_sites", F.lit(0)).alias("n_sites"),
        F.coalesce("years", F.lit("")).alias("years"),
    )
