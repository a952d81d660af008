"""The whole study from raw files to published tables, as one callable."""

from plumeworks import constants as C
from plumeworks.operators import aggregates, clean, merge, metrics, quality, registry, report, weather
from plumeworks.plans.tables import LAYOUT, PLACED
from plumeworks.sources import readers, writers


def validate(spark, measurements, weather_raw, expected, mapping=None, headers=None):
    """All data-quality checks over raw inputs as result rows; ``headers`` are the columns of each measurement file.

    ``expected`` holds ``rows`` per group, ``sites``, ``counties``, ``groups``,
    ``weather_rows``, ``stations`` and ``tolerance_pct``.
    """
    tolerance = expected.get("tolerance_pct", 1.0)
    reports = [
        quality.check_sources(measurements, "pollutant_group", expected["rows"], tolerance),
        quality.check_totals(
            measurements, sum(expected["rows"].values()), expected["sites"], expected["counties"],
            expected["groups"], tolerance,
        ),
        quality.check_weather(weather_raw, expected["weather_rows"], expected["stations"], tolerance),
    ]
    if mapping is not None:
        reports.append(quality.check_mapping(mapping))
    if headers:
        reports.append(quality.check_headers(spark, headers))
    return quality.union_results(reports)


def build_study(
    spark, measurement_folder, weather_path, coordinate_sources, out, expected=None,
    min_hours=C.MIN_HOURS_DAY, min_8h=C.MIN_HOURS_8H, threshold=C.HOURLY_COMPLETENESS,
    weather_schema=C.WEATHER_SCHEMA, output_rows=None,
):
    """Read, check, clean, derive and publish. Every table is written, then read back by the next.

    Returns the published tables by name. A failed error-severity check stops the build
    before any table is written. ``build_report`` holds rows in, out and stored, sites and years per group and for
    weather, counted during the writes; rows that did not arrive stop the build. ``output_rows`` are bounds of
    the design-value rows; given these, the sanity checks of the outputs are reported too.
    """
    raw = readers.measurement_folder(spark, measurement_folder).select(*C.MEASUREMENT_COLUMNS)
    weather_raw = readers.weather_csv(spark, weather_path, weather_schema)
    if expected:
        headers = readers.headers(spark, f"{measurement_folder}/{C.MEASUREMENT_FILE_GLOB}")
        checks = quality.write_report(validate(spark, raw, weather_raw, expected, headers=headers), f"{out}/validation")
        if not quality.roll_up(checks).first()["passed"]:
            raise ValueError(f"raw data failed validation; see {out}/validation")

    def stored(name, df):
        path = f"{out}/parquet/{name}"
        if name in LAYOUT:
            writers.write_partitioned(df, path, *LAYOUT[name], placed=name in PLACED)
        else:
            writers.write_table(df, path)
        return readers.parquet_dataset(spark, path)

    raw_seen, rows_in = report.counted(raw, "pollutant_group", C.POLLUTANT_GROUPS)
    clean_seen, rows_out = report.counted(clean.clean_measurements(raw_seen), "pollutant_group", C.POLLUTANT_GROUPS)
    hourly = stored("hourly", clean_seen)
    typed_seen, hours_in = report.counted(weather.typed_weather(weather_raw))
    hours_seen, hours_out = report.counted(weather.placed_weather(typed_seen))
    station_hours = stored("weather", hours_seen)
    written = report.weather_report(station_hours, hours_in(), hours_out())
    values = stored("values", metrics.design_values(hourly, min_hours=min_hours, min_8h=min_8h))
    daily = stored("daily", aggregates.daily_stats(hourly, threshold))
    per_group = report.build_report(hourly, "pollutant_group", rows_in(), rows_out(), daily, "aqsid")
    written = stored("build_report", per_group.unionByName(written))
    lost = [row["name"] for row in written.where("NOT complete").collect()]
    if lost:
        raise ValueError(f"rows written and rows stored differ: {lost}")
    monthly = stored("monthly", aggregates.monthly_stats(daily))
    coords = stored("coords", merge.prefer_first(coordinate_sources, "aqsid", ["lat", "lon"]))
    pairing = stored("pairing", merge.pair_sites(daily, station_hours, coords))
    combined = stored("combined", merge.combine(daily, pairing, weather.daily_weather(station_hours)))
    sites = stored("registry", registry.site_registry(raw, coords))
    exports = dict(zip(C.EXPORT_NAMES, (daily, metrics.ordered(values), combined, registry.ordered(sites))))
    for name, df in exports.items():
        writers.write_csv(df, f"{out}/csv/{name}")
    tables = {
        "site_registry": sites, "naaqs_design_values": values, "pollutant_daily": daily,
        "pollutant_monthly": monthly, "aq_weather_daily": combined, "pollutant_hourly": hourly,
        "weather_hourly": station_hours, "build_report": written,
    }
    if output_rows:
        quality.write_report(quality.check_outputs(values, sites, output_rows), f"{out}/validation_outputs")
    for name, df in tables.items():
        df.createOrReplaceTempView(name)  # SQL strings run as they are
    return tables
