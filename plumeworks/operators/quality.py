"""Data-quality checks. Every check is a result row; a table is aggregated once for all of them."""

from functools import reduce

from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.functions.expressions import inline_table

RESULT_COLUMNS = ["name", "passed", "expected", "actual", "detail", "severity"]


def result(name, passed, expected="", actual="", detail="", severity="error"):
    """One result as a struct column; text parts may be columns or plain values."""
    def text(v):
        return v.cast("string") if hasattr(v, "cast") else F.lit(str(v))
    ok = passed if hasattr(passed, "cast") else F.lit(bool(passed))
    return F.struct(
        text(name).alias("name"),
        F.coalesce(ok, F.lit(False)).alias("passed"),
        text(expected).alias("expected"),
        text(actual).alias("actual"),
        text(detail).alias("detail"),
        F.lit(severity).alias("severity"),
    )


def as_rows(measured, results):
    """Turn a one-row aggregate and its result structs into result rows."""
    return measured.select(F.inline(F.array(*results)))


def union_results(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- single checks, as structs over an aggregate row -------------------------
def schema_result(columns, expected, source):
    """Same set of columns, order aside; differences are listed."""
    have, want = set(columns), set(expected)
    lists = [("missing", sorted(want - have)), ("extra", sorted(have - want))]
    detail = " ".join(f"{label}={names}" for label, names in lists if names)
    return result(f"schema:{source}", have == want, sorted(want), sorted(have), detail)


def row_count_result(actual, expected, source, tolerance_pct=1.0):
    """Row count within the tolerance; an expected 0 must be exactly 0."""
    n = F.col(actual)
    passed = n == 0 if expected == 0 else F.abs(n - expected) / float(expected) * 100 <= tolerance_pct
    return result(f"row_count:{source}", passed, expected, n, f"tolerance={tolerance_pct}%")


def distinct_result(actual, expected, source, minimum=None, severity="error"):
    """Distinct non-null values: exactly as expected, or at least a minimum."""
    n = F.col(actual)
    if minimum is None:
        return result(f"nunique:{source}", n == expected, expected, n, severity=severity)
    return result(f"nunique:{source}", n >= minimum, f">={minimum}", n, severity=severity)


def date_range_result(low, high, source, window=C.DATE_WINDOW):
    """All parseable dates inside the window; fails when none parses."""
    lo, hi = F.col(low).cast("string"), F.col(high).cast("string")
    passed = (lo >= window[0]) & (hi <= window[1])
    actual = F.concat_ws("..", lo, hi)
    detail = F.when(lo.isNull(), "no parseable dates").otherwise("")
    return result(f"date_range:{source}", passed, "..".join(window), actual, detail)


def duplicate_result(duplicates, exact, source, severity="warning"):
    """Rows repeating an hour key; exact copies are named in the detail."""
    n = F.col(duplicates)
    detail = F.concat(F.lit("exact_full_row_dups="), F.col(exact).cast("string"))
    return result(f"no_duplicate_hours:{source}", n == 0, 0, n, detail, severity)


# --- measured aggregates ------------------------------------------------------
def profile(df, by=None, keys=C.DUPLICATE_HOUR_KEY):
    """Rows, dates and duplicates per source in two shuffles.

    Copies are folded on the full row, then on the hour key, then per source: distinct
    counting without expanding the table, and copies of one row collapse map-side.
    """
    by = by or []
    whole = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    per_key = whole.groupBy(*dict.fromkeys([*by, *keys])).agg(
        F.sum("_copies").alias("_rows"), F.count("*").alias("_distinct_rows")
    )
    day = F.col("date_local").try_cast("date")
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("n_duplicate_hours"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_distinct_rows")), F.lit(0)).alias("n_exact_duplicates"),
    )


def totals(df):
    """Whole-study totals: rows, sites, counties in title case, groups and date span."""
    # Pre-grouping to the few distinct combinations keeps the distinct counts cheap.
    day = F.col("date_local").try_cast("date")
    combos = df.groupBy("aqsid", F.initcap("county_name").alias("county"), "pollutant_group").agg(
        F.count("*").alias("n"), F.min(day).alias("lo"), F.max(day).alias("hi")
    )
    return combos.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_distinct("aqsid").alias("n_sites"),
        F.count_distinct("county").alias("n_counties"),
        F.count_distinct("pollutant_group").alias("n_groups"),
        F.min("lo").cast("string").alias("min_date"),
        F.max("hi").cast("string").alias("max_date"),
    )


# --- composed reports ---------------------------------------------------------
def check_measurements(df, source, expected_rows, tolerance_pct=1.0, window=C.DATE_WINDOW):
    """Schema, row count, duplicates and date range of one measurement table."""
    schema = schema_result(df.columns, C.MEASUREMENT_COLUMNS, source)
    absent = [c for c in C.DUPLICATE_HOUR_KEY if c not in df.columns]
    if absent:
        no_keys = result(f"no_duplicate_hours:{source}", False, detail=f"missing columns: {absent}")
        day = F.col("date_local").try_cast("date") if "date_local" in df.columns else F.lit(None).cast("date")
        measured = df.agg(F.count("*").alias("n_rows"), F.min(day).alias("min_date"), F.max(day).alias("max_date"))
        dates = date_range_result("min_date", "max_date", source, window)
        return as_rows(measured, [schema, row_count_result("n_rows", expected_rows, source, tolerance_pct), no_keys, dates])
    return as_rows(
        profile(df),
        [
            schema,
            row_count_result("n_rows", expected_rows, source, tolerance_pct),
            duplicate_result("n_duplicate_hours", "n_exact_duplicates", source),
            date_range_result("min_date", "max_date", source, window),
        ],
    )


def check_headers(spark, found):
    """One schema row per file from its own header, ``found`` mapping files to their column names."""
    named = {file.rsplit("/", 1)[-1]: names for file, names in found.items()}
    return as_rows(spark.range(1), [schema_result(names, C.MEASUREMENT_COLUMNS, f) for f, names in sorted(named.items())])


def missing_source(spark, source):
    """A source that is absent fails its schema check."""
    return as_rows(spark.range(1), [schema_result([], C.MEASUREMENT_COLUMNS, source)])


def check_sources(df, by, expected_rows, tolerance_pct=1.0, window=C.DATE_WINDOW):
    """The measurement checks for every source of a multi-file table, from one pass over it.

    ``expected_rows`` maps each source to its row count; a source without rows fails its
    schema check. The mapping is configuration, so joining it as a literal table is safe.
    """
    known = inline_table(df.sparkSession, ["_source", "_expected"], list(expected_rows.items()))
    measured = known.join(profile(df, [by]), F.col("_source") == F.col(by), "left")
    columns = [c for c in df.columns if c in C.MEASUREMENT_COLUMNS]
    n, want = F.col("n_rows"), F.col("_expected")
    close = F.when(want == 0, n == 0).otherwise(F.abs(n - want) / F.nullif(want, F.lit(0)) * 100 <= tolerance_pct)
    low, high = F.col("min_date").cast("string"), F.col("max_date").cast("string")
    def named(check):
        return F.concat(F.lit(f"{check}:"), F.col("_source"))
    wanted = sorted(C.MEASUREMENT_COLUMNS)
    seen = F.when(n.isNull(), "[]").otherwise(str(sorted(columns)))
    checks = [
        result(named("schema"), n.isNotNull() & F.lit(sorted(columns) == wanted), wanted, seen),
        result(named("row_count"), close, want, n, f"tolerance={tolerance_pct}%"),
        result(
            named("no_duplicate_hours"), F.col("n_duplicate_hours") == 0, 0, F.col("n_duplicate_hours"),
            F.concat(F.lit("exact_full_row_dups="), F.col("n_exact_duplicates").cast("string")), "warning",
        ),
        result(
            named("date_range"), (low >= window[0]) & (high <= window[1]), "..".join(window),
            F.concat_ws("..", low, high), F.when(low.isNull(), "no parseable dates").otherwise(""),
        ),
    ]
    rows = measured.select("n_rows", F.inline(F.array(*checks)))
    # An absent source reports its schema only.
    return rows.where(F.col("n_rows").isNotNull() | F.col("name").startswith("schema:")).drop("n_rows")


def check_totals(df, expected_rows, sites, counties, groups, tolerance_pct=1.0, site_slack=5):
    """Study-wide totals; the site count may fall short by the slack and only warns."""
    return as_rows(
        totals(df),
        [
            row_count_result("n_rows", expected_rows, "all_pollutants", tolerance_pct),
            distinct_result("n_sites", sites, "aqsid", max(sites - site_slack, 1), "warning"),
            distinct_result("n_counties", counties, "county_name"),
            distinct_result("n_groups", groups, "pollutant_group"),
        ],
    )


def check_weather(df, expected_rows, stations, tolerance_pct=1.0):
    """Weather row count, and the station count where the column is already named so."""
    aggs = [F.count("*").alias("n_rows")]
    results = [row_count_result("n_rows", expected_rows, "weather_master", tolerance_pct)]
    if "location" in df.columns:
        aggs.append(F.count_distinct("location").alias("n_stations"))
        results.append(distinct_result("n_stations", stations, "weather_station_location"))
    return as_rows(df.agg(*aggs), results)


# --- fixed values: accepted column names of a site mapping -------------------
MAPPING_SITE_COLUMNS = ("aq_site", "aqsid", "aq_lat", "site_name", "site")
MAPPING_STATION_COLUMNS = ("weather_station", "wx_site", "location", "station")


def check_mapping(df):
    """A site mapping needs a distance, a site and a station column, and rows."""
    lowered = [c.lower() for c in df.columns]
    named = (
        any("dist" in c for c in lowered)
        and any(c in MAPPING_SITE_COLUMNS for c in lowered)
        and any(c in MAPPING_STATION_COLUMNS for c in lowered)
    )
    first = df.limit(1).agg(F.count("*").alias("n"))
    return as_rows(
        first,
        [
            result(
                "site_mapping:has_required_columns", F.lit(named) & (F.col("n") > 0),
                "(distance col) + (aq col) + (weather col) + rows>0", sorted(df.columns),
                severity="warning",
            )
        ],
    )


def check_outputs(values, registry, row_bounds, ozone=(0.03, 0.15), pm25=(3.0, 25.0), min_active=40):
    """Sanity of the outputs: row bounds, metrics present, plausible values, active sites."""
    is_ozone = F.col("metric") == "ozone_8hr_4th_max"
    is_pm25 = F.col("metric") == "pm25_annual_mean"
    present = F.array_sort(F.collect_set("metric"))  # bounded by the metric table
    measured = values.agg(
        F.count("*").alias("n"),
        present.alias("metrics"),
        F.count_if(is_ozone & ~((F.col("value") > ozone[0]) & (F.col("value") < ozone[1]))).alias("bad_ozone"),
        F.count_if(is_pm25 & ~F.col("value").between(*pm25)).alias("bad_pm25"),
    )
    required = F.array(*[F.lit(m) for m in C.REQUIRED_METRICS])
    lacking = F.array_except(required, F.col("metrics"))
    low, high = row_bounds
    on_values = as_rows(
        measured,
        [
            result("outputs:design_value_rows", F.col("n").between(low, high), f"{low}..{high}", F.col("n")),
            result("outputs:required_metrics", F.size(lacking) == 0, "", F.array_join(lacking, ",")),
            result("outputs:ozone_range", F.col("bad_ozone") == 0, 0, F.col("bad_ozone")),
            result("outputs:pm25_range", F.col("bad_pm25") == 0, 0, F.col("bad_pm25")),
        ],
    )
    active = registry.agg(F.count_if(F.col("data_status") == "active").alias("n"))
    return on_values.unionByName(
        as_rows(active, [result("outputs:active_sites", F.col("n") >= min_active, f">={min_active}", F.col("n"))])
    )


def roll_up(results):
    """One summary row: passes when every error-severity check passes."""
    failed = ~F.col("passed")
    counted = results.agg(
        F.count_if("passed").alias("n_passed"),
        F.count("*").alias("n_checks"),
        F.count_if(failed & (F.col("severity") == "error")).alias("n_errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("n_warnings"),
    )
    text = F.format_string(
        "%d/%d passed  (%d errors, %d warnings)", "n_passed", "n_checks", "n_errors", "n_warnings"
    )
    return counted.withColumn("passed", F.col("n_errors") == 0).withColumn("summary", text)


def write_report(results, path):
    """Result rows and their summary as JSON; the summary reads the rows written before it."""
    results.write.mode("overwrite").json(f"{path}/results")
    written = results.sparkSession.read.schema(results.schema).json(f"{path}/results")
    roll_up(written).write.mode("overwrite").json(f"{path}/summary")
    return written
