"""Daily and monthly statistics."""

from pyspark.sql import functions as F

from plumeworks import constants as C

IDENTITY = ["aqsid", "parameter_code", "pollutant_name", "pollutant_group", "county_name", "site_name"]


def daily_stats(hourly, threshold=C.HOURLY_COMPLETENESS, month=False):
    """Statistics per site, day and parameter; days below the threshold stay, flagged.

    ``n_hours`` counts non-null rows, so several instruments can push completeness past 1.
    Rows are placed by site, parameter and month first: folding them before the shuffle hardly makes them fewer, and its
    table of texts may not fit in memory. With ``month`` they keep ``_month``, by which they are placed. Few folders receive the result, so it is written where it is, with
    the days of a month together.
    """
    days = (
        hourly.withColumn("_month", F.substring("date_local", 1, 7))
        .repartition("aqsid", "parameter_code", "_month")
        .groupBy(*IDENTITY, "date_local", "_month")
        .agg(
            F.avg("sample_measurement").alias("mean"),
            F.min("sample_measurement").alias("min"),
            F.max("sample_measurement").alias("max"),
            F.stddev_samp("sample_measurement").alias("std"),
            F.count("sample_measurement").alias("n_hours"),
        )
        .withColumn("completeness_pct", F.col("n_hours") / 24.0)
        .withColumn("valid_day", F.col("completeness_pct") >= threshold)
    )
    return days if month else days.drop("_month")


def monthly_stats(daily):
    """Statistics of the daily means per month, valid days only; days that carry ``_month`` are not shuffled again."""
    month = F.col("_month") if "_month" in daily.columns else F.substring("date_local", 1, 7)
    return (
        daily.where("valid_day")
        .groupBy(*IDENTITY, month.alias("year_month"))
        .agg(
            F.avg("mean").alias("monthly_mean"),
            F.min("mean").alias("monthly_min"),
            F.max("mean").alias("monthly_max"),
            F.stddev_samp("mean").alias("monthly_std"),
            F.count("mean").alias("n_valid_days"),
        )
    )


def validity_tally(daily):
    """How many site-days are valid and how many are not."""
    return daily.agg(
        F.count("*").alias("n_days"),
        F.count_if("valid_day").alias("n_valid"),
        F.count_if(~F.col("valid_day")).alias("n_invalid"),
    )
