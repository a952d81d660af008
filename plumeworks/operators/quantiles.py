"""Exact interpolated quantiles and moments of unbounded groups.

``percentile`` keeps every distinct value of a group in one buffer, which is right for the
days of a year and wrong for all rows of a pollutant. Here rows are read once, into counts per
(group, value); all else works on these. A wanted rank is narrowed down: its band of values is
split, the sizes of the parts say exactly which of them holds the rank, and that part is split
again until it holds at most ``BOUND`` distinct values, which are put in order. Where
a band is split affects only how often that is needed, never the result.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumeworks.functions.expressions import join_same
from plumeworks.session import settle

BOUND = 4096  # distinct values ordered by one task
PARTS = 64  # parts of a band that is split


def value_counts(df, keys, value):
    """``(keys, _v, _c)``: rows per group and value, null values too; settled, as it is read several times."""
    counted = df.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    return settle(counted, "value-counts")


def moments(counted, keys):
    """``(keys, n_rows, n_values, mean, sd, max)`` from counts; one value has no deviation."""
    n = F.sum(F.when(F.col("_v").isNotNull(), F.col("_c")))
    first = counted.groupBy(*keys).agg(
        F.sum("_c").alias("n_rows"), F.coalesce(n, F.lit(0)).alias("n_values"),
        (F.sum(F.col("_v") * F.col("_c")) / n).alias("mean"), F.max("_v").alias("max"),
    )
    off = F.col("_v") - F.col("mean")
    spread = join_same(counted, first, keys).groupBy(*keys).agg(F.sum(off * off * F.col("_c")).alias("_squares"))
    sd = F.when(F.col("n_values") > 1, F.sqrt(F.col("_squares") / (F.col("n_values") - 1)))
    return join_same(first, spread, keys).select(*keys, "n_rows", "n_values", "mean", sd.alias("sd"), "max")


def exact_quantiles(df, keys, value, quantiles, **how):
    """``{output name: probability}`` per group, linear interpolation, nulls ignored."""
    if not keys:
        whole = exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, quantiles, **how)
        return whole.drop("_all")
    return quantiles_of(value_counts(df, keys, value), keys, quantiles, **how)


def quantiles_of(counted, keys, quantiles, bound=BOUND, parts=PARTS, accuracy=1_000):
    """Quantiles from :func:`value_counts`."""
    values = counted.where(F.col("_v").isNotNull())
    groups = values.groupBy(*keys).agg(
        F.sum("_c").alias("_n"), F.count("*").alias("_distinct"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    ).withColumn("_ranks", _wanted_ranks(quantiles))
    bands = groups.select(*keys, "_lo", "_hi", F.lit(0).cast("long").alias("_start"), "_ranks", "_distinct")
    while not bands.where(F.col("_distinct") > bound).isEmpty():
        wide = bands.where(F.col("_distinct") > bound)
        split = _split(_members(values, wide, keys), keys, parts, accuracy)
        bands = settle(bands.where(F.col("_distinct") <= bound).unionByName(split), "quantile-bands")
    inside = _members(values, bands, keys)
    order = Window.partitionBy(*keys, "_lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("_last", F.col("_start") + F.sum("_c").over(order))
    here = F.filter("_ranks", lambda r: (r >= F.col("_last") - F.col("_c")) & (r < F.col("_last")))
    # At most two ranks per quantile reach this aggregation.
    found = inside.select(*keys, "_v", F.explode(here).alias("_rank")).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at")
    )
    out = join_same(groups.select(*keys, "_n"), found, keys)
    return out.select(*keys, *[_interpolate(p).alias(name) for name, p in quantiles.items()])


def _members(values, bands, keys):
    """The values of each band; bands of a group do not overlap."""
    return join_same(values, bands, keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _split(members, keys, parts, accuracy):
    """The parts of the bands that hold a wanted rank.

    Cut points are approximate quantiles of the distinct values and the middle of the band, which
    parts its least value from its largest whatever the others are.
    """
    band = [*keys, "_lo"]
    middle = F.col("_lo") + (F.max("_hi") - F.col("_lo")) / 2
    middle = F.when(middle < F.max("_hi"), middle).otherwise(F.col("_lo"))
    approximate = F.percentile_approx("_v", [k / parts for k in range(1, parts)], accuracy)
    cuts = members.groupBy(*band).agg(F.array_append(approximate, middle).alias("_cuts"))
    placed = join_same(members, cuts, band).withColumn("_part", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
    sizes = placed.groupBy(*band, "_start", "_ranks", "_part").agg(
        F.sum("_c").alias("_rows"), F.count("*").alias("_distinct"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    upto = Window.partitionBy(*band).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    spans = sizes.withColumn("_end", F.col("_start") + F.sum("_rows").over(upto)).withColumn("_start", F.col("_end") - F.col("_rows"))
    spans = spans.withColumn("_ranks", F.filter("_ranks", lambda r: (r >= F.col("_start")) & (r < F.col("_end"))))
    return spans.where(F.size("_ranks") > 0).select(
        *keys, F.col("_low").alias("_lo"), F.col("_high").alias("_hi"), "_start", "_ranks", "_distinct"
    )


def _position(p):
    return F.lit(float(p)) * (F.col("_n") - 1)


def _wanted_ranks(quantiles):
    ends = [f(_position(p)).cast("long") for p in quantiles.values() for f in (F.floor, F.ceil)]
    return F.array_distinct(F.array(*ends))


def _interpolate(p):
    position = _position(p)
    low = F.element_at("_at", F.floor(position).cast("long"))
    high = F.element_at("_at", F.ceil(position).cast("long"))
    return low + (high - low) * (position - F.floor(position))
