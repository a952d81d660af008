"""Site series: hourly averaging, the 8-hour trailing mean and daily values.

``site_series`` aggregates before anything else, so from here on a site has at most one
row per local timestamp. Timestamps are minutes at their finest, which bounds a site at
525,600 rows a year however many raw rows it had: a site holding a third of all raw rows
is reduced by map-side partial averages and cannot make a later window task unbounded.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumeworks import constants as C

SITE = ["aqsid"]
GROUP_SITE = ["pollutant_group", "aqsid"]


def site_series(hourly, keys=SITE):
    """Mean of all rows sharing a site and timestamp. Rows without a site are left out."""
    known = hourly.where(F.col("aqsid").isNotNull() & F.col("datetime").isNotNull())
    return known.groupBy(*keys, "datetime").agg(F.avg("sample_measurement").alias("value"))


def site_names(hourly, keys=SITE, names=("site_name", "county_name")):
    """Smallest non-null name and county per site.

    Kept apart from the series, so the large aggregations carry numbers only. The distinct
    combinations come from a hash aggregate over a few dictionary-encoded columns; placing
    them by site keeps the optimizer from folding them into the text minima, which would
    sort every row.
    """
    combos = hourly.where(F.col("aqsid").isNotNull()).select(*keys, *names).distinct()
    return combos.repartition(*keys).groupBy(*keys).agg(*[F.min(c).alias(c) for c in names])


def rolling_mean(series, keys=SITE, rows=8, min_periods=C.MIN_HOURS_8H, name="mean_8h"):
    """Trailing mean over the last ``rows`` existing rows, right-labelled.

    The frame counts rows, not hours: it runs across gaps, midnights and years, and a null
    measurement takes a slot without counting towards ``min_periods``.
    """
    w = Window.partitionBy(*keys).orderBy("datetime").rowsBetween(1 - rows, 0)
    return series.withColumn(
        name, F.when(F.count("value").over(w) >= min_periods, F.avg("value").over(w))
    )


def rolling_mean_in_blocks(series, keys=SITE, rows=8, min_periods=C.MIN_HOURS_8H, name="mean_8h", block="month"):
    """:func:`rolling_mean` for sites of any length: a task holds a site's block of time, not the site.

    Each block is handed the ``rows - 1`` rows before it. They are among the last rows of as many
    earlier blocks, since a block that exists has a row; the blocks of a site are few.
    """
    need = rows - 1
    inside = [*keys, "_block"]
    placed = series.withColumn("_block", F.date_trunc(block, "datetime"))
    latest = Window.partitionBy(*inside).orderBy(F.desc("datetime"))
    tails = (
        placed.select(*inside, "datetime", "value")
        .withColumn("_rank", F.row_number().over(latest))
        .where(F.col("_rank") <= need)  # limited map-side before the shuffle
        .groupBy(*inside)
        .agg(F.sort_array(F.collect_list(F.struct("datetime", "value"))).alias("_tail"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(-need, -1)
    carried = tails.withColumn("_carry", F.flatten(F.collect_list("_tail").over(earlier)))
    start = F.greatest(F.size("_carry") - need + 1, F.lit(1))
    halo = carried.select(*inside, F.inline(F.slice("_carry", start, F.lit(need)))).withColumn("_own", F.lit(False))
    both = placed.withColumn("_own", F.lit(True)).unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy(*inside).orderBy("datetime").rowsBetween(-need, 0)
    mean = F.when(F.count("value").over(w) >= min_periods, F.avg("value").over(w))
    return both.withColumn(name, mean).where("_own").drop("_own", "_block")


def daily_means(series, keys=SITE, min_hours=C.MIN_HOURS_DAY):
    """Daily mean, null unless enough non-null hours."""
    return _daily(series, keys, min_hours, F.avg("value"))


def daily_maxima(series, keys=SITE, min_hours=C.MIN_HOURS_DAY):
    """Daily maximum, null unless enough non-null hours."""
    return _daily(series, keys, min_hours, F.max("value"))


def _daily(series, keys, min_hours, stat):
    return (
        series.groupBy(*keys, F.to_date("datetime").alias("day"))
        .agg(F.count("value").alias("n_hours"), stat.alias("_stat"))
        .withColumn("daily_value", F.when(F.col("n_hours") >= min_hours, F.col("_stat")))
        .drop("_stat")
    )


def daily_max_8h(rolled, keys=SITE):
    """Daily maximum of the 8-hour means, no daily completeness rule."""
    return rolled.groupBy(*keys, F.to_date("datetime").alias("day")).agg(
        F.max("mean_8h").alias("max_8h")
    )


def site_days(rolled, keys=SITE, min_hours=C.MIN_HOURS_DAY):
    """Everything the yearly metrics need, one row per site-day.

    Rows already placed by ``keys`` (by the window, or on purpose) are not shuffled again.
    ``max_8h`` is there when the rows carry the 8-hour mean.
    """
    enough = F.col("n_hours") >= min_hours
    peak = [F.max("mean_8h").alias("max_8h")] if "mean_8h" in rolled.columns else []
    return (
        rolled.groupBy(*keys, F.to_date("datetime").alias("day"))
        .agg(
            F.count("value").alias("n_hours"),
            F.avg("value").alias("day_mean"),
            F.max("value").alias("day_max"),
            *peak,
        )
        .withColumn("valid_mean", F.when(enough, F.col("day_mean")))
        .withColumn("valid_max", F.when(enough, F.col("day_max")))
        .withColumn("year", F.year("day"))
    )


def rolling_mean_of_rows(rows, keys=SITE, value="sample_measurement", size=8, min_periods=C.MIN_HOURS_8H):
    """Trailing mean over raw rows ordered by (timestamp, value), without gathering a site.

    Raw rows of one site are unbounded, so each (site, timestamp) is its own window partition
    and is handed the ``size - 1`` rows that precede it. Those come from the last rows of
    earlier timestamps: every timestamp present has at least one row, so ``size - 1``
    timestamps back always suffice.
    """
    need = size - 1
    block = [*keys, "datetime"]
    latest = Window.partitionBy(*block).orderBy(F.desc(value))
    tails = (
        rows.select(*block, value)
        .withColumn("_rank", F.row_number().over(latest))
        .where(F.col("_rank") <= need)  # limited map-side before the shuffle
        .groupBy(*block)
        .agg(F.sort_array(F.collect_list(value)).alias("_tail"))
    )
    earlier = Window.partitionBy(*keys).orderBy("datetime").rowsBetween(-need, -1)
    carried = tails.withColumn("_carry", F.flatten(F.collect_list("_tail").over(earlier)))
    start = F.greatest(F.size("_carry") - need + 1, F.lit(1))
    carried = carried.select(*block, F.posexplode(F.slice("_carry", start, F.lit(need))).alias("_pos", value))
    before = carried.select(*block, value, (F.col("_pos") - need).alias("_seq"))
    both = rows.select(*block, value, F.lit(0).alias("_seq")).unionByName(before)
    w = Window.partitionBy(*block).orderBy("_seq", value).rowsBetween(-need, 0)
    mean = F.when(F.count(value).over(w) >= min_periods, F.avg(value).over(w))
    return both.withColumn("mean_8h", mean).where(F.col("_seq") == 0).drop("_seq")
