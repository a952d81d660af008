"""Counts of a build, taken while its tables are written: no input is scanned for them again."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from plumeworks.functions.expressions import inline_table


def counted(df, column=None, values=()):
    """``(df, counts)``: the same rows, counted as they pass when an action runs over them.

    ``counts()`` is then ``{None: all rows, value: rows with it in the column, ...}``. The values are a fixed list, so what
    reaches the driver is too.
    """
    seen = Observation()
    per_value = [F.count_if(F.col(column).eqNullSafe(F.lit(v))).alias(f"n_{i}") for i, v in enumerate(values)]

    def counts():
        found = seen.get
        return {None: found["n_all"], **{v: found[f"n_{i}"] for i, v in enumerate(values)}}

    return df.observe(seen, F.count(F.lit(1)).alias("n_all"), *per_value), counts


def build_report(stored, column, before, after, sites, site_column):
    """``(name, rows_in, rows_out, rows_stored, n_sites, years, complete)`` per value of a store's partition column.

    ``before`` and ``after`` are counts of a finished write. Rows stored come from the footers of the files and years from their
    folders; sites are counted in a table already folded by site. ``complete`` says whether all rows written are there.
    """
    spark = stored.sparkSession
    names = [v for v in before if v is not None]
    passed = inline_table(spark, ["name", "rows_in", "rows_out"], [(v, before[v], after[v]) for v in names])
    held = stored.groupBy(F.col(column).alias("name"), "year").agg(F.count(F.lit(1)).alias("n")).groupBy("name").agg(
        F.sum("n").alias("rows_stored"), F.array_join(F.array_sort(F.collect_set("year")).cast("array<string>"), ",").alias("years")
    )
    known = sites.groupBy(F.col(column).alias("name")).agg(F.count_distinct(site_column).alias("n_sites"))
    rows = passed.where(F.col("rows_in") > 0).join(held, "name", "left").join(known, "name", "left")
    stored_rows = F.coalesce("rows_stored", F.lit(0))
    return rows.select(
        "name", F.col("rows_in").cast("long"), F.col("rows_out").cast("long"), stored_rows.alias("rows_stored"),
        F.coalesce("n_sites", F.lit(0)).alias("n_sites"), F.coalesce("years", F.lit("")).alias("years"),
        (stored_rows == F.col("rows_out")).alias("complete"),
    )


def weather_report(stored, before, after):
    """The same for the weather store, as one row; stations and years come from its folders."""
    spark = stored.sparkSession
    held = stored.groupBy("location", "year").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_stored"), F.count_distinct("location").alias("n_sites"),
        F.array_join(F.array_sort(F.collect_set("year")).cast("array<string>"), ",").alias("years"),
    ).first()
    names = ["name", "rows_in", "rows_out", "rows_stored", "n_sites", "years", "complete"]
    row = ("weather", before[None], after[None], *held, held["rows_stored"] == after[None])
    rows = inline_table(spark, names, [row])
    return rows.select(*[F.col(c).cast("long") if c in names[1:5] else F.col(c) for c in names])
