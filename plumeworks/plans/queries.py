"""Every registered query: the DataFrame side and the SQL that states its result.

Queries run over whole tables. Numbered names follow the operator inventory.
"""

from functools import reduce

from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.functions import expressions as X
from plumeworks.functions.filters import predicate
from plumeworks.operators import (
    aggregates, clean, geo, merge, metrics, quality, refresh, registry, report, series, weather,
)
from plumeworks.operators.quantiles import exact_quantiles
from plumeworks.plans import bindings
from plumeworks.plans import catalogue as cat
from plumeworks.plans.oracle import km, r, site, with_ctes
from plumeworks.plans.tables import tables, tidy
from plumeworks.session import work_folder
from plumeworks.sources import keys, readers, writers

QUERIES = {}
ORACLE = {}

# Parameters an analyst would type.
SITE, COUNTY, YEAR = "480290059", "Bexar", 2000
YEARS = (1998, 1999, 2000)
MONTHS = [f"2000-{m:02d}" for m in range(1, 13)]
STATION = "Bexar 1_URGENT"
KEY15 = ", ".join(C.MEASUREMENT_COLUMNS)
HOURLY_COLUMNS = KEY15 + ", datetime, year, month, hour, season"


def query(name, select=None, doubles=""):
    """Register a query; ``doubles`` names the columns the SQL side rounds as ``tidy`` does."""

    def add(fn):
        def run(spark, sf_dir):
            return tidy(fn(tables(spark, sf_dir)))

        QUERIES[name] = run
        if select:
            cols = doubles.split()
            rounded = ", ".join(f"{r(c)} AS {c}" for c in cols)
            text = f"SELECT * REPLACE ({rounded}) FROM ({select})" if cols else select
            ORACLE[name] = with_ctes(text)
        return fn

    return add


def folder(t, label):
    return work_folder(t.spark, label)


# ------------------------------------------------------------------ sources ---
_READING_STATS = """
  SELECT pollutant_group, parameter_code, data_source, count(*) AS n_rows, count(sample_measurement) AS n_values,
         count(DISTINCT aqsid) AS n_sites, min(sample_measurement) AS low, max(sample_measurement) AS high,
         min(date_local || time_local) AS first_time, max(method_code) AS method_code, count(county_name) AS n_counties
  FROM raw GROUP BY 1, 2, 3"""


def _reading_stats(df):
    moment = F.concat("date_local", "time_local")
    return df.groupBy("pollutant_group", "parameter_code", "data_source").agg(
        F.count("*").alias("n_rows"),
        F.count("sample_measurement").alias("n_values"),
        F.count_distinct("aqsid").alias("n_sites"),
        F.min("sample_measurement").alias("low"),
        F.max("sample_measurement").alias("high"),
        F.min(moment).alias("first_time"),
        F.max("method_code").alias("method_code"),
        F.count("county_name").alias("n_counties"),
    )


@query("S1_measurement_csv", _READING_STATS, "low high")
def _(t):
    path = writers.write_csv(t.raw(), folder(t, "s1"))
    return _reading_stats(readers.measurement_csv(t.spark, path))


def _spoilt(t):
    """Raw measurements as text, some values unreadable: words for numbers, a unit behind a value, a broken code."""
    rows = t.raw()
    value, site, poc = F.col("sample_measurement").cast("string"), F.col("site_number"), F.col("poc")
    return rows.withColumns({
        "sample_measurement": F.when((site % 5 == 0) & (poc == 2), F.lit("n/a")).when((site % 7 == 0) & (poc == 1), F.concat(F.lit("~"), F.col("data_source"))).otherwise(value),
        "poc": F.when(site % 11 == 0, F.concat(poc.cast("string"), F.lit("x"))).otherwise(poc.cast("string")),
    })


@query(
    "S1_rejects",
    """SELECT pollutant_group || '_AllCounties_spoilt.csv' AS file, col AS "column", txt AS text, 'not ' || CASE col WHEN 'poc' THEN 'int' ELSE 'double' END AS reason,
              count(*) AS n_rows FROM (
         SELECT pollutant_group, 'sample_measurement' AS col, CASE WHEN site_number % 5 = 0 AND poc = 2 THEN 'n/a' WHEN site_number % 7 = 0 AND poc = 1 THEN '~' || data_source END AS txt FROM raw
         UNION ALL SELECT pollutant_group, 'poc', CASE WHEN site_number % 11 = 0 THEN poc || 'x' END FROM raw) WHERE txt IS NOT NULL GROUP BY ALL""",
)
def _(t):
    path, rows = folder(t, "s1-rejects"), _spoilt(t)
    for group in C.POLLUTANT_GROUPS:
        one = rows.where(F.col("pollutant_group") == group)
        writers.write_csv(one, f"{path}/{group}_AllCounties_spoilt.csv")
    stored, rejects = readers.measurements_and_rejects(t.spark, f"{path}/{C.MEASUREMENT_FILE_GLOB}")
    return rejects.groupBy("file", "column", "text", "reason").agg(F.count("*").alias("n_rows"))


@query(
    "S2_partitioned_scan",
    "SELECT aqsid, datetime, sample_measurement, parameter_code, site_name, county_name FROM hourly WHERE pollutant_group = 'Ozone'",
    "sample_measurement",
)
def _(t):
    t.get("hourly")
    return readers.parquet_dataset(
        t.spark, f"{t.root}/hourly",
        ["aqsid", "datetime", "sample_measurement", "parameter_code", "site_name", "county_name"],
        [("pollutant_group", "=", "Ozone")],
    )


@query(
    "S3_filter_tuples",
    """SELECT aqsid, date_local, time_local, parameter_code, poc, data_source, sample_measurement FROM hourly
       WHERE pollutant_group IN ('PM2.5', 'PM10') AND year >= 1997 AND year <= 2000 AND parameter_code <> 88502
         AND sample_measurement > 5 AND hour < 12 AND data_source = 'EPA' AND poc = 1""",
    "sample_measurement",
)
def _(t):
    rows = t.get("hourly").where(
        predicate(
            [
                ("pollutant_group", "in", ["PM2.5", "PM10"]), ("year", ">=", 1997), ("year", "<=", 2000),
                ("parameter_code", "!=", 88502), ("sample_measurement", ">", 5), ("hour", "<", 12),
                ("data_source", "=", "EPA"), ("poc", "==", 1),
            ]
        )
    )
    return rows.select(*C.APPEND_KEY, "sample_measurement")


@query(
    "S4_weather_csv",
    """SELECT site_name, year, count(*) AS n_rows, count(lat) AS n_located, count(rain_1h) AS n_rain,
              avg(temp) AS temp, max(wind_deg) AS wind_deg, min(datetime_local) AS first_time FROM raw_weather GROUP BY 1, 2""",
    "temp wind_deg",
)
def _(t):
    raw = t.raw_weather()
    path = folder(t, "s4")
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    back = readers.weather_csv(t.spark, path, raw.schema)
    return back.groupBy("site_name", "year").agg(
        F.count("*").alias("n_rows"), F.count("lat").alias("n_located"), F.count("rain_1h").alias("n_rain"),
        F.avg("temp").alias("temp"), F.max("wind_deg").alias("wind_deg"),
        F.min("datetime_local").alias("first_time"),
    )


@query("S5_site_reference_csv", "SELECT aqsid, lat, lon FROM coords_1_all", "lat lon")
def _(t):
    return _reference_csv(t, t.coordinate_sources(complete=True)[0])


def _reference_csv(t, first):
    path = writers.write_csv(first.toDF("aqsid", "latitude", "longitude"), folder(t, "s5"))
    return readers.site_reference(t.spark, path)


@query("S6_second_coordinate_source", "SELECT aqsid, lat, lon FROM coords_2_all", "lat lon")
def _(t):
    return _second_source(t, t.coordinate_sources(complete=True)[1])


def _second_source(t, second):
    path = writers.write_table(second.toDF("AQS Site ID", "Latitude", "Longitude"), folder(t, "s6"))
    return readers.coordinates(t.spark.read.parquet(path), "AQS Site ID", "Latitude", "Longitude")


def _transaction_lines(t):
    """Raw measurements printed as pipe-separated lines, with a comment, another type and an over-long line."""
    li = bindings.table(t.spark, t.sf_dir, "lineitem")
    number = F.col("l_suppkey")
    fields = {
        "ttype": F.lit("RD"), "action": F.lit("I"), "state": F.lit("48"),
        "county": F.format_string("%03d", bindings.county_code(number)),
        "site": F.format_string("%04d", number),
        "param": F.when(F.col("l_linenumber") == 1, "44201").otherwise("42602"),
        "poc": (F.col("l_partkey") % 2 + 1).cast("string"), "dur": F.lit("1"), "unit": F.lit("008"),
        "meth": F.lit("047"), "date": F.date_format("l_shipdate", "yyyyMMdd"),
        "time": F.concat((F.col("l_orderkey") % 24).cast("string"), F.lit(":00")),
        "value": F.col("l_quantity").cast("string"),
    }
    parts = [fields.get(n, F.lit("")) for n in C.TRANSACTION_FIELDS]
    line = F.concat_ws("|", *parts)
    surplus = F.concat(line, F.lit("|x|y"))
    other = F.concat(F.lit("RP|"), line)
    return li.select(
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("# "), line))
        .when(F.col("l_tax") > 0.075, surplus)
        .when(F.col("l_discount") > 0.095, other)
        .otherwise(line)
        .alias("value")
    )


@query(
    "S7_transaction_file",
    f"""SELECT state_code, county_code, site_number, CASE WHEN l_linenumber = 1 THEN 44201 ELSE 42602 END AS parameter_code,
              CAST(l_partkey % 2 + 1 AS INTEGER) AS poc, strftime(l_shipdate, '%Y-%m-%d') AS date_local,
              lpad(CAST(l_orderkey % 24 AS VARCHAR) || ':00', 5, '0') AS time_local, l_quantity AS sample_measurement, 47 AS method_code,
              c.name AS county_name, CASE WHEN l_linenumber = 1 THEN 'Ozone' ELSE 'NO2' END AS pollutant_name, id AS aqsid,
              'TCEQ' AS data_source, 'Ozone' AS pollutant_group, coalesce(n.site_name, 'UNKNOWN_' || id) AS site_name
       FROM (SELECT *, 48 AS state_code, CAST(substr({site('l_suppkey')}, 3, 3) AS INTEGER) AS county_code, CAST(l_suppkey AS INTEGER) AS site_number,
                    {site('l_suppkey')} AS id FROM lineitem WHERE l_returnflag <> 'A' AND l_tax <= 0.075 AND l_discount <= 0.095)
       JOIN (VALUES {", ".join(f"({a}, '{b}')" for a, b in C.COUNTIES)}) c(code, name) ON c.code = county_code
       LEFT JOIN (VALUES {", ".join(f"('{a}', '{b}')" for a, b in C.SITE_NAMES)}) n(aqsid, site_name) ON n.aqsid = id""",
    "sample_measurement",
)
def _(t):
    path = folder(t, "s7")
    _transaction_lines(t).write.text(path)
    return refresh.from_transactions(readers.transactions(t.spark, path), "Ozone")


@query(
    "S7_rejects",
    """SELECT col AS "column", txt AS text, reason, count(*) AS n_rows FROM (
         SELECT unnest([CASE WHEN l_tax > 0.075 THEN {'col': '_surplus', 'txt': 'x', 'reason': 'too many fields'} END,
                        CASE WHEN l_tax <= 0.075 AND l_quantity = 13 THEN {'col': 'value', 'txt': 'n/a', 'reason': 'not double'} END], recursive := true)
         FROM lineitem WHERE l_returnflag <> 'A' AND (l_tax > 0.075 OR l_discount <= 0.095)) WHERE col IS NOT NULL GROUP BY ALL""",
)
def _(t):
    """The transaction lines with a word for one of the values; what of the raw-data lines cannot be read."""
    path = folder(t, "s7-rejects")
    _transaction_lines(t).select(F.regexp_replace("value", r"\|13(\.0+)?\|", "|n/a|").alias("value")).write.text(path)
    _, rejects = readers.transactions_and_rejects(t.spark, path)
    return rejects.groupBy("column", "text", "reason").agg(F.count("*").alias("n_rows"))


def _api_records(t):
    """Raw rows as API responses: all text, a code that is no number now and then, no county name."""
    raw = t.raw()
    text = [F.col(c).cast("string").alias(c) for c in (
        "state_code", "county_code", "site_number", "parameter_code", "date_local", "time_local",
        "sample_measurement", "method_code",
    )]
    poc = F.when((F.col("poc") == 2) & (F.col("data_source") == "TCEQ"), "n/a").otherwise(F.col("poc").cast("string"))
    return raw.select(*text, poc.alias("poc"))


@query(
    "S8_api_records",
    f"""SELECT pollutant_group, pollutant_name, county_name, site_name, poc, data_source, count(*) AS n_rows, sum(sample_measurement) AS total
       FROM (SELECT coalesce(p.pgroup, '') AS pollutant_group, coalesce(p.name, CAST(parameter_code AS VARCHAR)) AS pollutant_name, c.name AS county_name,
                    coalesce(n.site_name, c.name || '_' || printf('%04d', site_number)) AS site_name,
                    CASE WHEN poc = 2 AND data_source = 'TCEQ' THEN NULL ELSE poc END AS poc, 'EPA' AS data_source, sample_measurement, aqsid
             FROM (SELECT * REPLACE (NULL AS county_name, NULL AS site_name) FROM raw) r
             LEFT JOIN (VALUES {", ".join(f"({a}, '{b}', '{g}')" for a, b, g in C.PARAMETERS)}) p(code, name, pgroup) ON p.code = parameter_code
             JOIN (VALUES {", ".join(f"({a}, '{b}')" for a, b in C.COUNTIES)}) c(code, name) ON c.code = county_code
             LEFT JOIN (VALUES {", ".join(f"('{a}', '{b}')" for a, b in C.SITE_NAMES)}) n(id, site_name) ON n.id = aqsid
             WHERE sample_measurement IS NOT NULL) s
       WHERE NOT EXISTS (SELECT 1 FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in C.DEAD_SENSORS)}) d(id, what)
                         WHERE d.id = s.aqsid AND (d.what = s.pollutant_group OR d.what = s.pollutant_name))
       GROUP BY 1, 2, 3, 4, 5, 6""",
    "total",
)
def _(t):
    path = folder(t, "s8")
    _api_records(t).write.json(path)
    rows = refresh.from_api(readers.api_records(t.spark, path))
    keys = ["pollutant_group", "pollutant_name", "county_name", "site_name", "poc", "data_source"]
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.sum("sample_measurement").alias("total"))


@query(
    "S9_source_dispatch",
    """SELECT source, aqsid, lat, lon FROM coords_1_all CROSS JOIN (VALUES ('csv'), ('parquet'), ('parquet_dir')) v(source)""",
    "lat lon",
)
def _(t):
    return _dispatched(t, t.coordinate_sources(complete=True)[0])


def _dispatched(t, coords):
    paths = {k: folder(t, f"s9-{k}") for k in ("csv", "parquet", "parquet_dir")}
    writers.write_csv(coords, paths["csv"])
    writers.write_table(coords, paths["parquet"])
    state = coords.withColumn("state", F.substring("aqsid", 1, 2))
    writers.write_partitioned(state, paths["parquet_dir"], ["state"])
    parts = [
        readers.load(t.spark, path, kind, coords.schema).select(F.lit(kind).alias("source"), "aqsid", "lat", "lon")
        for kind, path in paths.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "S10_file_discovery",
    """SELECT pollutant_group || '_AllCounties_1995_2024.csv' AS source_file, count(*) AS n_rows, count(DISTINCT aqsid) AS n_sites
       FROM raw GROUP BY 1""",
)
def _(t):
    path = folder(t, "s10")
    raw = t.raw()
    for group in C.POLLUTANT_GROUPS:
        writers.write_csv(raw.where(F.col("pollutant_group") == group), f"{path}/{group}_AllCounties_1995_2024.csv")
    rows = readers.measurement_folder(t.spark, path)
    return rows.groupBy("source_file").agg(F.count("*").alias("n_rows"), F.count_distinct("aqsid").alias("n_sites"))


# ------------------------------------------------------------------ cleaning ---
@query("P1_exact_dedup", f"SELECT {KEY15} FROM dedup", "sample_measurement")
def _(t):
    return clean.drop_exact_duplicates(t.raw())


_BY_SITE = "SELECT aqsid, data_source, parameter_code, count(*) AS n_rows, sum(sample_measurement) AS total FROM {src} GROUP BY 1, 2, 3"


def _by_site(df):
    return df.groupBy("aqsid", "data_source", "parameter_code").agg(
        F.count("*").alias("n_rows"), F.sum("sample_measurement").alias("total")
    )


@query(
    "P2_rule_exclusion",
    _BY_SITE.format(src="""(SELECT * FROM raw WHERE NOT coalesce(aqsid = '480290059' AND data_source = 'TCEQ', false)
                             AND NOT coalesce(county_name = 'WEBB' AND poc = 2, false))"""),
    "total",
)
def _(t):
    rules = C.OUT_OF_SCOPE_RULES + [{"county_name": "WEBB", "poc": 2}, {"no_such_column": "x"}]
    return _by_site(clean.exclude_rows(t.raw(), rules))


@query(
    "P3_unit_conversion",
    _BY_SITE.format(src="""(SELECT * REPLACE (sample_measurement * CASE WHEN parameter_code = 44201 AND data_source = 'TCEQ' THEN 0.001 ELSE 1.0 END
                             AS sample_measurement) FROM raw)"""),
    "total",
)
def _(t):
    return _by_site(clean.convert_units(t.raw()))


@query("P4_P5_P7_time_columns", f"SELECT {HOURLY_COLUMNS} FROM hourly", "sample_measurement")
def _(t):
    return t.once("hourly").select(*HOURLY_COLUMNS.split(", "))


@query(
    "P4_time_parsing",
    """SELECT date_local, time_local, count(*) AS n_rows,
              min(strftime(try_strptime(date_local || ' ' || time_local, '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M:%S')) AS parsed FROM raw GROUP BY 1, 2""",
)
def _(t):
    rows = t.raw().groupBy("date_local", "time_local").agg(F.count("*").alias("n_rows"))
    return rows.withColumn("parsed", X.local_timestamp("date_local", "time_local").cast("string"))


@query(
    "P6_title_county",
    """SELECT upper(substr(county_name, 1, 1)) || lower(substr(county_name, 2)) AS county_name, count(*) AS n_rows FROM raw GROUP BY 1""",
)
def _(t):
    return clean.title_county(t.raw()).groupBy("county_name").agg(F.count("*").alias("n_rows"))


@query(
    "P8_to_P12_weather_store",
    """SELECT location, datetime_local, year, month, hour, temp_c, feels_like_c, dew_point_c, wind_deg, lat, lon FROM weather""",
    "temp_c feels_like_c dew_point_c wind_deg lat lon",
)
def _(t):
    return t.get("weather").select(
        "location", "datetime_local", "year", "month", "hour", "temp_c", "feels_like_c", "dew_point_c",
        "wind_deg", "lat", "lon",
    )


@query(
    "P9_time_from_text",
    """SELECT CAST(year(CAST(datetime_local AS TIMESTAMP)) AS INTEGER) AS year, CAST(month(CAST(datetime_local AS TIMESTAMP)) AS INTEGER) AS month,
              CAST(hour(CAST(datetime_local AS TIMESTAMP)) AS INTEGER) AS hour, count(*) AS n_rows FROM raw_weather GROUP BY 1, 2, 3""",
)
def _(t):
    bare = t.raw_weather().drop("year", "month", "hour_local")
    return weather.derive_columns(bare, weather.TIME).groupBy("year", "month", "hour").agg(F.count("*").alias("n_rows"))


@query(
    "P11_path_safe_name",
    """SELECT site_name, trim(regexp_replace(site_name, '[\\\\/:*?"<>|]', '_', 'g')) AS location, count(*) AS n_rows FROM raw_weather GROUP BY 1, 2""",
)
def _(t):
    return t.raw_weather().groupBy("site_name", X.path_safe("site_name").alias("location")).agg(
        F.count("*").alias("n_rows")
    )


@query(
    "P13_no2_only",
    """SELECT pollutant_group, parameter_code, count(*) AS n_rows FROM hourly
       WHERE pollutant_group <> 'NOx_Family' OR parameter_code = 42602 GROUP BY 1, 2""",
)
def _(t):
    return clean.restrict_no2(t.get("hourly")).groupBy("pollutant_group", "parameter_code").agg(
        F.count("*").alias("n_rows")
    )


@query(
    "P14_site_id",
    f"SELECT s_suppkey, {site('s_suppkey')} AS aqsid FROM supplier",
)
def _(t):
    s = bindings.table(t.spark, t.sf_dir, "supplier").withColumn("county", bindings.county_code(F.col("s_suppkey")))
    s = s.withColumn("state", F.lit(48))
    return s.select("s_suppkey", X.site_id("state", "county", "s_suppkey").alias("aqsid"))


@query(
    "P15_unknown_sites",
    f"""SELECT DISTINCT aqsid FROM raw WHERE aqsid NOT IN ({", ".join(f"'{a}'" for a, _ in C.SITE_NAMES)})""",
)
def _(t):
    return refresh.unknown_sites(t.raw())


@query(
    "P16_numeric_coercion",
    """SELECT poc, count(*) AS n_rows, count(sample_measurement) AS n_values
       FROM (SELECT sample_measurement, CASE WHEN poc = 2 AND data_source = 'TCEQ' THEN NULL ELSE poc END AS poc FROM raw) GROUP BY 1""",
)
def _(t):
    rows = _api_records(t).select(*refresh.numeric(["poc"]), *refresh.numeric(["sample_measurement"], "double"))
    return rows.groupBy("poc").agg(F.count("*").alias("n_rows"), F.count("sample_measurement").alias("n_values"))


@query("P17_drop_null_measurements", _BY_SITE.format(src="raw WHERE sample_measurement IS NOT NULL"), "total")
def _(t):
    return _by_site(t.raw().dropna(subset=["sample_measurement"]))


@query(
    "P18_dead_sensors",
    _BY_SITE.format(
        src="""(SELECT * FROM raw WHERE NOT ((aqsid = '480290059' AND (pollutant_group = 'PM10' OR pollutant_name = 'PM10'))
                OR (aqsid = '480130032' AND (pollutant_group = 'NO2' OR pollutant_name = 'NO2'))))"""
    ),
    "total",
)
def _(t):
    return _by_site(refresh.drop_dead_sensors(t.raw(), [("480290059", "PM10"), ("480130032", "NO2")]))


@query(
    "P19_date_and_time_text",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS date_local, lpad(CAST(l_orderkey % 24 AS VARCHAR) || ':00', 5, '0') AS time_local,
              count(*) AS n_rows FROM lineitem WHERE l_returnflag <> 'A' AND l_tax <= 0.075 AND l_discount <= 0.095 GROUP BY 1, 2""",
)
def _(t):
    path = folder(t, "p19")
    _transaction_lines(t).write.text(path)
    rows = refresh.from_transactions(readers.transactions(t.spark, path), "Ozone")
    return rows.groupBy("date_local", "time_local").agg(F.count("*").alias("n_rows"))


@query(
    "P20_local_date_variants",
    """SELECT variant, date_local, count(*) AS n_rows FROM (
         SELECT unnest(['date', 'text', 'unix']) AS variant, substr(date_local, 1, 10) AS date_local FROM raw_weather) GROUP BY 1, 2""",
)
def _(t):
    raw = t.raw_weather()
    variants = {
        "date": raw.select("date_local"), "text": raw.select("datetime_local"), "unix": raw.select("dt"),
    }
    parts = [
        weather.local_date(df).select(F.lit(name).alias("variant"), "date_local") for name, df in variants.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("variant", "date_local").agg(
        F.count("*").alias("n_rows")
    )


@query("P21_canonical_columns", f"SELECT {', '.join(C.REGISTRY_COLUMNS)} FROM registry", "lat lon")
def _(t):
    return t.get("registry").select(*C.REGISTRY_COLUMNS)


@query(
    "P22_predicates",
    """SELECT aqsid, date_local, time_local, parameter_code, poc, data_source FROM hourly
       WHERE year BETWEEN 1996 AND 1999 AND season IN ('JJA', 'DJF') AND sample_measurement IS NOT NULL
         AND regexp_matches(pollutant_name, 'PM|Ozone') AND site_name LIKE 'B%' AND county_name ILIKE 'bex%' AND hour >= 6""",
)
def _(t):
    rows = t.get("hourly").where(
        F.col("year").between(1996, 1999) & F.col("season").isin("JJA", "DJF")
        & F.col("sample_measurement").isNotNull() & F.col("pollutant_name").rlike("PM|Ozone")
        & F.col("site_name").like("B%") & F.col("county_name").ilike("bex%") & (F.col("hour") >= 6)
    )
    return rows.select(*C.APPEND_KEY)


# ------------------------------------------------------------------ series ---
@query("A1_site_series", "SELECT pollutant_group, aqsid, datetime, value FROM series_all", "value")
def _(t):
    return _series(t)


def _series(t):
    return series.site_series(clean.restrict_no2(t.get("hourly")), series.GROUP_SITE)


def _rolled(t):
    return series.rolling_mean(_series(t), series.GROUP_SITE)


@query("W1_rolling_8h", "SELECT pollutant_group, aqsid, datetime, value, mean_8h FROM rolled_all", "value mean_8h")
def _(t):
    return _rolled(t)


@query(
    "W1_one_site",
    """SELECT datetime, value, CASE WHEN count(value) OVER w >= 6 THEN avg(value) OVER w END AS mean_8h FROM (
         SELECT datetime, avg(sample_measurement) AS value FROM hourly WHERE aqsid IS NOT NULL GROUP BY 1) WINDOW w AS (ORDER BY datetime ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""",
    "value mean_8h",
)
def _(t):
    """All rows as if one site had measured them."""
    rows = t.get("hourly").where(F.col("aqsid").isNotNull()).withColumn("aqsid", F.lit("all"))
    return series.rolling_mean_in_blocks(series.site_series(rows)).select("datetime", "value", "mean_8h")


@query(
    "A2_daily_mean",
    """SELECT pollutant_group, aqsid, CAST(datetime AS DATE) AS day, count(value) AS n_hours,
              CASE WHEN count(value) >= 18 THEN avg(value) END AS daily_value FROM series_all GROUP BY 1, 2, 3""",
    "daily_value",
)
def _(t):
    return series.daily_means(_rolled(t), series.GROUP_SITE)


@query(
    "A3_daily_max",
    """SELECT pollutant_group, aqsid, CAST(datetime AS DATE) AS day, count(value) AS n_hours,
              CASE WHEN count(value) >= 18 THEN max(value) END AS daily_value FROM series_all GROUP BY 1, 2, 3""",
    "daily_value",
)
def _(t):
    return series.daily_maxima(_rolled(t), series.GROUP_SITE)


@query(
    "A4_daily_max_8h",
    "SELECT pollutant_group, aqsid, CAST(datetime AS DATE) AS day, max(mean_8h) AS max_8h FROM rolled_all GROUP BY 1, 2, 3",
    "max_8h",
)
def _(t):
    return series.daily_max_8h(_rolled(t), series.GROUP_SITE)


_METRIC_IDS = {
    "pm25_annual_mean": "A5", "pm25_24hr_p98": "A6", "pm10_24hr_exceedances": "A7", "co_8hr_max": "A8",
    "co_1hr_max": "A9", "so2_1hr_p99": "A10", "no2_1hr_p98": "A11", "no2_annual_mean": "A12",
    "ozone_8hr_4th_max": "A13",
}


def _metric_query(metric, ident, min_hours, suffix, source):
    @query(
        f"{ident}_{metric}{suffix}",
        f"SELECT aqsid, year, value FROM {source} WHERE metric = '{metric}' AND value IS NOT NULL", "value",
    )
    def _(t):
        rows = t.hourly_of({metrics.METRIC_BY_NAME[metric].group})
        return metrics.metric_from_hourly(rows, metric, min_hours=min_hours)


for _metric, _ident in _METRIC_IDS.items():
    _metric_query(_metric, _ident, C.MIN_HOURS_DAY, "", "metric_rows")
    if _metric in ("pm25_annual_mean", "pm25_24hr_p98", "pm10_24hr_exceedances", "so2_1hr_p99", "no2_1hr_p98"):
        _metric_query(_metric, _ident, 1, "_any_hour", "metric_rows_any")

_DV = "aqsid, year, pollutant_group, metric, value, units, naaqs_level, exceeds, site_name, county_name"


@query("A14_design_values", f"SELECT {_DV} FROM values_default", "value naaqs_level")
def _(t):
    return metrics.design_values(t.get("hourly"))


@query("A14_design_values_any_hour", f"SELECT {_DV} FROM dv", "value naaqs_level")
def _(t):
    return t.get("values").select(*_DV.split(", "))


@query(
    "W2_nth_highest_day",
    """SELECT aqsid, year, day, max_8h FROM (SELECT *, row_number() OVER (PARTITION BY aqsid, year ORDER BY round(max_8h, 9) DESC, day) AS rn
       FROM days WHERE pollutant_group = 'Ozone' AND max_8h IS NOT NULL) WHERE rn = 4""",
    "max_8h",
)
def _(t):
    days = series.site_days(_rolled(t).where(F.col("pollutant_group") == "Ozone"), series.GROUP_SITE).withColumn("max_8h", F.round("max_8h", 9))
    return metrics.nth_highest_day(days, 4).select("aqsid", "year", "day", "max_8h")


_DAILY = "aqsid, parameter_code, pollutant_name, pollutant_group, county_name, site_name, date_local, mean, min, max, std, n_hours, completeness_pct, valid_day"
_DAILY_DOUBLES = "mean min max std completeness_pct"
_MONTHLY = "aqsid, parameter_code, pollutant_name, pollutant_group, county_name, site_name, year_month, monthly_mean, monthly_min, monthly_max, monthly_std, n_valid_days"
_MONTHLY_DOUBLES = "monthly_mean monthly_min monthly_max monthly_std"


@query("A15_daily_stats", f"SELECT {_DAILY} FROM daily_default", _DAILY_DOUBLES)
def _(t):
    return aggregates.daily_stats(t.get("hourly")).select(*_DAILY.split(", "))


@query("A16_monthly_stats", f"SELECT {_MONTHLY} FROM monthly_default", _MONTHLY_DOUBLES)
def _(t):
    return aggregates.monthly_stats(aggregates.daily_stats(t.get("hourly"))).select(*_MONTHLY.split(", "))


@query("A16_monthly_stats_any_hour", f"SELECT {_MONTHLY} FROM monthly", _MONTHLY_DOUBLES)
def _(t):
    return t.get("monthly").select(*_MONTHLY.split(", "))


_WX = [
    f"{c}_{s}" if s != "mean" else c for c, stats in C.DAILY_WEATHER_AGGS.items() for s in stats
]


@query("A17_weather_daily", f"SELECT weather_station, date_local, {', '.join(_WX)} FROM weather_daily", " ".join(_WX))
def _(t):
    return t.get("weather_daily")


@query("A18_station_coordinates", "SELECT location, lat, lon FROM stations", "lat lon")
def _(t):
    return weather.station_coordinates(t.get("weather"))


@query("A19_site_list", "SELECT aqsid, site_name, county_name FROM sites")
def _(t):
    return series.site_names(t.get("daily"))


_ACTIVE = "aqsid, state_code, county_code, site_number, site_name, county_name, network, pollutants, n_pollutants, first_date, last_date, n_records"


@query("A20_active_sites", f"SELECT {_ACTIVE} FROM active")
def _(t):
    return registry.active_sites(t.raw()).select(*_ACTIVE.split(", "))


@query(
    "A21_coverage",
    """SELECT count(*) AS n_rows, count(DISTINCT aqsid) AS n_sites, count(DISTINCT year) AS n_years, count(DISTINCT metric) AS n_metrics FROM dv""",
)
def _(t):
    return metrics.coverage(t.metric_values())


@query(
    "A22_build_stats",
    """SELECT pollutant_group, rows_in, rows_out, n_sites, years FROM
         (SELECT pollutant_group, count(*) AS rows_in FROM raw GROUP BY 1) JOIN
         (SELECT pollutant_group, count(*) AS rows_out, count(DISTINCT aqsid) AS n_sites,
                 array_to_string(list_sort(list(DISTINCT year)), ',') AS years FROM hourly GROUP BY 1) USING (pollutant_group)""",
)
def _(t):
    return clean.build_stats(t.raw(), t.get("hourly"), "pollutant_group")


_UNPLACED = "CASE WHEN hour_local = 3 AND wind_deg > 180 THEN NULL ELSE year END"


@query(
    "A22_weather_stats",
    f"""SELECT 'weather' AS name, count(*) AS rows_in, count(y) AS rows_out, count(y) AS rows_stored,
               count(DISTINCT trim(regexp_replace(site_name, '[\\\\/:*?"<>|]', '_', 'g'))) FILTER (WHERE y IS NOT NULL) AS n_sites,
               array_to_string(list_sort(list(DISTINCT y) FILTER (WHERE y IS NOT NULL)), ',') AS years, true AS complete
        FROM (SELECT *, {_UNPLACED} AS y FROM raw_weather)""",
)
def _(t):
    """The counts of a weather build, taken during its write; some rows have no year and cannot be placed."""
    raw = t.raw_weather()
    lost = (F.col("hour_local") == 3) & (F.col("wind_deg") > 180)
    typed, rows_in = report.counted(weather.typed_weather(raw.withColumn("year", F.when(~F.coalesce(lost, F.lit(False)), F.col("year")))))
    placed, rows_out = report.counted(weather.placed_weather(typed))
    path = writers.write_partitioned(placed, folder(t, "a22"), ["location", "year"])
    return report.weather_report(t.spark.read.parquet(path), rows_in(), rows_out())


@query(
    "A22_group_report",
    """SELECT pollutant_group AS name, rows_in, rows_out, rows_out AS rows_stored, n_sites, years, true AS complete FROM
         (SELECT pollutant_group, count(*) AS rows_in FROM raw GROUP BY 1) JOIN
         (SELECT pollutant_group, count(*) AS rows_out, count(DISTINCT aqsid) AS n_sites,
                 array_to_string(list_sort(list(DISTINCT year)), ',') AS years FROM hourly GROUP BY 1) USING (pollutant_group)""",
)
def _(t):
    """The counts of a store build, taken during its write."""
    raw, rows_in = report.counted(t.raw(), "pollutant_group", C.POLLUTANT_GROUPS)
    rows, rows_out = report.counted(clean.clean_measurements(raw), "pollutant_group", C.POLLUTANT_GROUPS)
    path = writers.write_partitioned(rows, folder(t, "a22-groups"), ["pollutant_group", "year"], placed=True)
    stored = t.spark.read.parquet(path)
    return report.build_report(stored, "pollutant_group", rows_in(), rows_out(), stored, "aqsid")


@query(
    "A23_validity_tally",
    """SELECT count(*) AS n_days, count(*) FILTER (WHERE valid_day) AS n_valid, count(*) FILTER (WHERE NOT valid_day) AS n_invalid FROM daily_default""",
)
def _(t):
    return aggregates.validity_tally(aggregates.daily_stats(t.get("hourly")))


# ------------------------------------------------------------------ joins ---
@query(
    "J1_pair_daily",
    """SELECT d.aqsid, d.date_local, d.parameter_code, d.site_name, d.county_name, d.mean, p.weather_station, p.distance_km
       FROM daily d LEFT JOIN pairing p USING (aqsid) WHERE p.weather_station IS NOT NULL""",
    "mean distance_km",
)
def _(t):
    rows = merge.keep_paired(t.get("daily"), t.get("pairing"))
    return rows.select(
        "aqsid", "date_local", "parameter_code", "site_name", "county_name", "mean", "weather_station", "distance_km"
    )


@query(
    "J2_weather_of_the_day",
    """SELECT aqsid, date_local, parameter_code, county_name, mean, weather_station, temp_c, rain_1h_sum FROM combined""",
    "mean temp_c rain_1h_sum",
)
def _(t):
    rows = merge.combine(t.get("daily"), t.get("pairing"), t.get("weather_daily"))
    return rows.select(
        "aqsid", "date_local", "parameter_code", "county_name", "mean", "weather_station", "temp_c", "rain_1h_sum"
    )


@query("J3_attach_coordinates", "SELECT aqsid, site_name, county_name, lat, lon FROM sites", "lat lon")
def _(t):
    return merge.attach_coordinates(series.site_names(t.get("daily")), t.get("coords"))


_CUSTOMER_SITES = """SELECT c_name AS aqsid, (c_custkey * 611 % 6007) / 50.0 - 60.0 AS lat, (c_custkey * 907 % 17011) / 50.0 - 170.0 AS lon FROM customer"""
_SUPPLIER_STATIONS = """SELECT s_name AS location, (s_suppkey * 389 % 5003) / 45.0 - 55.0 AS slat, (s_suppkey * 733 % 15013) / 43.0 - 174.0 AS slon FROM supplier"""


_CROWDED_SITES = """SELECT c_name AS aqsid, 29.4 + (c_custkey * 611 % 10007) / 200140.0 AS lat, -98.5 + (c_custkey * 907 % 10009) / 200180.0 AS lon FROM customer"""
_CROWDED_STATIONS = """SELECT s_name AS location, 29.4 + (s_suppkey * 389 % 10007) / 200140.0 AS slat, -98.5 + (s_suppkey * 733 % 10009) / 200180.0 AS slon FROM supplier"""


def _nearest_sql(sites, stations):
    return f"""SELECT aqsid, lat, lon, location AS weather_station, d AS distance_km FROM (
          SELECT *, row_number() OVER (PARTITION BY aqsid ORDER BY round(d, 9), location) AS rn FROM (
            SELECT *, {km('lat', 'lon', 'slat', 'slon')} AS d FROM ({sites}) CROSS JOIN ({stations}))) WHERE rn = 1"""


@query("J4_nearest_station", _nearest_sql(_CUSTOMER_SITES, _SUPPLIER_STATIONS), "lat lon distance_km")
def _(t):
    return geo.nearest_station(
        bindings.customer_sites(t.spark, t.sf_dir), bindings.supplier_stations(t.spark, t.sf_dir)
    )


@query("J4_dense_cluster", _nearest_sql(_CROWDED_SITES, _CROWDED_STATIONS), "lat lon distance_km")
def _(t):
    return geo.nearest_station(
        bindings.crowded_sites(t.spark, t.sf_dir), bindings.crowded_stations(t.spark, t.sf_dir)
    )


@query(
    "J5_county_fallback",
    """SELECT county_name, weather_station FROM (
         SELECT c.county_name, (SELECT min(s.location) FROM stations s WHERE contains(lower(s.location), lower(c.county_name))) AS weather_station
         FROM (SELECT DISTINCT county_name FROM daily WHERE county_name IS NOT NULL) c) WHERE weather_station IS NOT NULL""",
)
def _(t):
    return geo.county_fallback(t.get("daily"), weather.station_coordinates(t.get("weather")))


@query("J6_source_priority", "SELECT aqsid, lat, lon FROM coords", "lat lon")
def _(t):
    return merge.prefer_first(t.coordinate_sources(), "aqsid", ["lat", "lon"])


@query(
    "J7_hourly_weather",
    """SELECT aqsid, pollutant_group, datetime, sample_measurement, weather_station, temp_c, humidity, wind_speed, wind_deg FROM hourly_weather""",
    "sample_measurement temp_c humidity wind_speed wind_deg",
)
def _(t):
    return t.hourly_weather().select(
        "aqsid", "pollutant_group", "datetime", "sample_measurement", "weather_station", "temp_c", "humidity",
        "wind_speed", "wind_deg",
    )


@query(
    "J7_one_station",
    """SELECT w.year AS year, count(*) AS n_rows, avg(sample_measurement) AS mean_value, avg(temp_c) AS temp_c FROM hourly h
       JOIN (SELECT * FROM weather WHERE location = (SELECT min(location) FROM weather)) w ON CAST(h.datetime AS DATE) = CAST(w.datetime_local AS DATE) GROUP BY 1""",
    "mean_value temp_c",
)
def _(t):
    """Every measurement with one station's weather of the day: a few keys hold all rows."""
    station = t.get("weather").agg(F.min("location")).scalar()
    days = t.get("weather").where(F.col("location") == station).select("year", "temp_c", F.to_date(F.col("datetime_local").try_cast("timestamp_ntz")).alias("day"))
    rows = t.get("hourly").select("sample_measurement", F.to_date("datetime").alias("day"))
    joined = merge.join_with_hot_keys(rows, days, ["day"], limit=50)
    return joined.groupBy("year").agg(F.count("*").alias("n_rows"), F.avg("sample_measurement").alias("mean_value"), F.avg("temp_c").alias("temp_c"))


@query(
    "J9_excluded_by_key",
    f"""SELECT {', '.join(C.APPEND_KEY)} FROM (SELECT DISTINCT {', '.join(C.APPEND_KEY)} FROM raw) d WHERE NOT EXISTS (
         SELECT 1 FROM hourly h WHERE {' AND '.join(f'h.{k} IS NOT DISTINCT FROM d.{k}' for k in C.APPEND_KEY)})""",
)
def _(t):
    return writers.new_rows(t.raw(), t.get("hourly"), C.APPEND_KEY).select(*C.APPEND_KEY)


# ------------------------------------------------------------------ sort, top-k, sets ---
@query("W3_keep_first", "SELECT aqsid, lat, lon FROM coords", "lat lon")
def _(t):
    sources = t.coordinate_sources()
    return merge.prefer_first(sources, "aqsid", ["lat", "lon"])


@query(
    "W3_earliest_row",
    """SELECT aqsid, parameter_code, datetime, data_source, poc, sample_measurement FROM (
         SELECT *, row_number() OVER (PARTITION BY aqsid, parameter_code ORDER BY datetime, data_source NULLS FIRST, poc NULLS FIRST, sample_measurement NULLS FIRST) AS n FROM hourly) WHERE n = 1""",
    "sample_measurement",
)
def _(t):
    rows = t.get("hourly").select("aqsid", "parameter_code", "datetime", "data_source", "poc", "sample_measurement")
    return merge.keep_first(rows, ["aqsid", "parameter_code"], ["datetime", "data_source", "poc"])


@query("T1_ordered_values", f"SELECT {_DV} FROM dv ORDER BY pollutant_group, aqsid, year, metric", "value naaqs_level")
def _(t):
    return metrics.ordered(t.get("values")).select(*_DV.split(", "))


@query(
    "T2_top_values",
    "SELECT aqsid, metric, year, value FROM dv WHERE metric = 'co_8hr_max' ORDER BY value DESC, aqsid, year LIMIT 25", "value",
)
def _(t):
    rows = t.get("values").where(F.col("metric") == "co_8hr_max").orderBy(F.desc("value"), "aqsid", "year")
    return rows.select("aqsid", "metric", "year", "value").limit(25)


@query(
    "U1_union_by_name",
    "SELECT aqsid, lat, lon, 'first' AS origin FROM coords_1_all UNION ALL SELECT aqsid, lat, lon, NULL FROM coords_2_all", "lat lon",
)
def _(t):
    first, second = t.coordinate_sources(complete=True)
    return first.withColumn("origin", F.lit("first")).unionByName(second, allowMissingColumns=True)


@query("U2_distinct", "SELECT DISTINCT aqsid, county_name, pollutant_group, data_source FROM hourly")
def _(t):
    return t.get("hourly").select("aqsid", "county_name", "pollutant_group", "data_source").distinct()


@query(
    "U3_pivot",
    """SELECT aqsid, avg(mean) FILTER (WHERE pollutant_group = 'Ozone') AS Ozone, avg(mean) FILTER (WHERE pollutant_group = 'PM10') AS PM10,
              avg(mean) FILTER (WHERE pollutant_group = 'CO') AS CO FROM daily GROUP BY aqsid""",
    "Ozone PM10 CO",
)
def _(t):
    return t.get("daily").groupBy("aqsid").pivot("pollutant_group", ["Ozone", "PM10", "CO"]).agg(F.avg("mean"))


# ------------------------------------------------------------------ composites ---
@query("R1_site_pairing", "SELECT aqsid, site_name, county_name, weather_station, distance_km FROM pairing", "distance_km")
def _(t):
    return merge.pair_sites(t.get("hourly"), t.get("weather"), t.get("coords"))


_COMBINED = _DAILY + ", weather_station, distance_km, " + ", ".join(_WX)


@query("R2_combined_daily", f"SELECT {_COMBINED} FROM combined", f"{_DAILY_DOUBLES} distance_km {' '.join(_WX)}")
def _(t):
    rows = merge.combine(t.get("daily"), t.get("pairing"), t.get("weather_daily"))
    return rows.select(*_COMBINED.split(", "))


@query("R3_site_registry", f"SELECT {', '.join(C.REGISTRY_COLUMNS)} FROM registry ORDER BY data_status, county_name, aqsid", "lat lon")
def _(t):
    return registry.ordered(registry.site_registry(t.raw(), t.get("coords")))


# ------------------------------------------------------------------ sinks ---
@query("K1_partition_overwrite", "SELECT pollutant_group, year, count(*) AS n_rows, sum(sample_measurement) AS total FROM hourly GROUP BY 1, 2", "total")
def _(t):
    """Write all, then write some partitions again: nothing doubles, nothing else is lost."""
    path, hourly = folder(t, "k1"), t.get("hourly")
    writers.write_partitioned(hourly, path, ["pollutant_group", "year"])
    writers.write_partitioned(hourly.where(F.col("pollutant_group") == "Ozone"), path, ["pollutant_group", "year"])
    return t.spark.read.parquet(path).groupBy("pollutant_group", "year").agg(
        F.count("*").alias("n_rows"), F.sum("sample_measurement").alias("total")
    )


@query("K2_result_parquet", f"SELECT {_MONTHLY} FROM monthly", _MONTHLY_DOUBLES)
def _(t):
    path = writers.write_table(t.get("monthly"), folder(t, "k2"))
    return t.spark.read.parquet(path).select(*_MONTHLY.split(", "))


@query("K3_csv_export", f"SELECT {_DV} FROM dv", "value naaqs_level")
def _(t):
    values = t.get("values")
    path = writers.write_csv(values, folder(t, "k3"))
    return t.spark.read.schema(values.schema).option("header", True).csv(path).select(*_DV.split(", "))


def _bronze(t):
    """Raw rows with the year their folder is named after."""
    return t.raw().withColumn("year", F.substring("date_local", 1, 4).cast("int"))


def _append(t, label):
    """A store holding one agency's rows receives the whole raw table as its delta."""
    path, rows = folder(t, label), _bronze(t)
    writers.write_partitioned(rows.where(F.col("data_source") == "EPA"), path, ["pollutant_group", "year"])
    return path, writers.append_delta(t.spark, rows, path)


_KEYS = ", ".join(C.APPEND_KEY)


@query(
    "K4_append_delta",
    f"""SELECT g.pollutant_group, count(*) FILTER (WHERE kind = 'old') AS rows_before, count(*) FILTER (WHERE kind = 'new') AS rows_added FROM (
          SELECT pollutant_group, 'old' AS kind FROM raw WHERE data_source = 'EPA'
          UNION ALL SELECT pollutant_group, 'new' FROM (SELECT DISTINCT pollutant_group, {_KEYS} FROM raw WHERE data_source = 'TCEQ')) g
        WHERE pollutant_group <> 'VOCs' GROUP BY 1""",
)
def _(t):
    return _append(t, "k4")[1]


@query(
    "K4_append_twice",
    "SELECT pollutant_group, CAST(0 AS BIGINT) AS rows_added FROM raw WHERE pollutant_group <> 'VOCs' GROUP BY 1",
)
def _(t):
    path, _ = _append(t, "k4-twice")
    return writers.append_delta(t.spark, _bronze(t), path).select("pollutant_group", "rows_added")


@query(
    "K4_repeated_batch",
    f"""SELECT pollutant_group, count(*) AS n_rows, count(DISTINCT ({_KEYS})) AS n_keys FROM (
          SELECT pollutant_group, {_KEYS} FROM raw WHERE data_source = 'EPA'
          UNION ALL SELECT DISTINCT pollutant_group, {_KEYS} FROM raw WHERE data_source = 'TCEQ') WHERE pollutant_group <> 'VOCs' GROUP BY 1""",
)
def _(t):
    """A batch that was cut off: the rows of one instrument are in the store, unknown to the key index. It is repeated twice."""
    path, rows = folder(t, "k4-repeat"), _bronze(t).where(F.col("pollutant_group").isin(*C.REFRESH_GROUPS))
    writers.write_partitioned(rows.where(F.col("data_source") == "EPA"), path, ["pollutant_group", "year"])
    keys.refresh(t.spark, path, ["pollutant_group", *C.APPEND_KEY], ["pollutant_group", "year"])
    late = writers.new_rows(rows, t.spark.read.parquet(path), ["pollutant_group", *C.APPEND_KEY])
    part = late.where(F.col("poc") == 1).select(*rows.columns)
    part.write.mode("append").partitionBy("pollutant_group", "year").parquet(path)
    for _ in range(2):
        writers.append_delta(t.spark, rows, path)
    return t.spark.read.parquet(path).groupBy("pollutant_group").agg(
        F.count("*").alias("n_rows"), F.count_distinct(F.struct(*C.APPEND_KEY)).alias("n_keys")
    )


@query(
    "K5_insert_absent",
    """SELECT pollutant_group, year, count(*) AS n_rows FROM (
         SELECT pollutant_group, year FROM hourly WHERE data_source = 'EPA'
         UNION ALL SELECT DISTINCT ON (aqsid, datetime, parameter_code, poc) pollutant_group, year FROM hourly h
         WHERE data_source = 'TCEQ' AND NOT EXISTS (SELECT 1 FROM hourly e WHERE e.data_source = 'EPA' AND e.aqsid = h.aqsid
           AND e.datetime = h.datetime AND e.parameter_code = h.parameter_code AND e.poc = h.poc)) GROUP BY 1, 2""",
)
def _(t):
    path, hourly = folder(t, "k5"), t.get("hourly")
    writers.write_partitioned(hourly.where(F.col("data_source") == "EPA"), path, ["pollutant_group", "year"])
    writers.insert_absent(t.spark, hourly.select(*C.MEASUREMENT_COLUMNS), path)
    return t.spark.read.parquet(path).groupBy("pollutant_group", "year").agg(F.count("*").alias("n_rows"))


@query(
    "K6_routed_groups",
    f"""SELECT pollutant_group, CAST(substr(date_local, 1, 4) AS INTEGER) AS year, count(*) AS n_rows FROM (
          SELECT pollutant_group, date_local FROM raw WHERE data_source = 'EPA'
          UNION ALL SELECT pollutant_group, date_local FROM (SELECT DISTINCT pollutant_group, {_KEYS} FROM raw WHERE data_source = 'TCEQ' AND pollutant_group <> 'VOCs'))
        GROUP BY 1, 2""",
)
def _(t):
    path, _ = _append(t, "k6")
    return t.spark.read.parquet(path).groupBy("pollutant_group", "year").agg(F.count("*").alias("n_rows"))


_PUBLISHED = {"naaqs_design_values": "values", "pollutant_monthly": "monthly", "site_registry": "registry"}


def _publish(t, label, source=None):
    """Publishes the three tables; they are read once, so they need not be stored before."""
    root = folder(t, label)
    named = {name: (source or t.once)(table) for name, table in _PUBLISHED.items()}
    writers.publish(named, root)
    return named, root


@query(
    "K7_published_sql",
    """SELECT pollutant_group, metric, year, count(*) FILTER (WHERE exceeds) AS n_exceeding_sites, count(*) AS n_sites FROM dv
       GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE exceeds) > 0""",
)
def _(t):
    _publish(t, "k7")
    return t.spark.sql(
        """SELECT pollutant_group, metric, year, COUNT(*) FILTER (WHERE exceeds) AS n_exceeding_sites, COUNT(*) AS n_sites
           FROM naaqs_design_values GROUP BY pollutant_group, metric, year
           HAVING COUNT(*) FILTER (WHERE exceeds) > 0 ORDER BY pollutant_group, metric, year"""
    )


@query(
    "K7_versioned_publish",
    "SELECT pollutant_group, count(*) AS n_rows, max(value) AS top FROM dv WHERE exceeds GROUP BY 1",
    "top",
)
def _(t):
    """Published whole, replaced by a part, and a further replacement that did not finish."""
    root, values = folder(t, "k7-versions"), t.get("values")
    writers.publish({"design_values": values}, root)
    writers.publish({"design_values": values.where("exceeds")}, root)
    values.where("NOT exceeds").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/design_values/version-000003-unfinished")
    return writers.published(t.spark, root, "design_values").groupBy("pollutant_group").agg(
        F.count("*").alias("n_rows"), F.max("value").alias("top")
    )


@query(
    "K8_reconciliation",
    """SELECT table_name, n AS source_rows, n AS written_rows, true AS matches FROM (
         SELECT 'naaqs_design_values' AS table_name, count(*) AS n FROM dv UNION ALL SELECT 'pollutant_monthly', count(*) FROM monthly
         UNION ALL SELECT 'site_registry', count(*) FROM registry)""",
)
def _(t):
    named, root = _publish(t, "k8", t.get)  # counted besides
    return writers.reconcile(named, root)


@query(
    "K9_output_manifest",
    """SELECT table_name, n > 0 AS present, n AS n_rows FROM (
         SELECT 'naaqs_design_values' AS table_name, count(*) AS n FROM dv UNION ALL SELECT 'pollutant_monthly', count(*) FROM monthly
         UNION ALL SELECT 'site_registry', count(*) FROM registry UNION ALL SELECT 'combined_aq_weather_daily', 0)""",
)
def _(t):
    _, root = _publish(t, "k9")
    return writers.manifest(t.spark, root, [*_PUBLISHED, "combined_aq_weather_daily"])


@query(
    "K10_pull_summary",
    f"""SELECT county_code, parameter_code, count(*) AS rows_raw, count(*) FILTER (WHERE kept) AS rows_kept,
              count(DISTINCT aqsid) FILTER (WHERE kept) AS n_sites FROM (
          SELECT *, sample_measurement IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in C.DEAD_SENSORS)}) d(id, what)
            WHERE d.id = raw.aqsid AND d.what IN (raw.pollutant_group, raw.pollutant_name)) AS kept FROM raw) GROUP BY 1, 2""",
)
def _(t):
    records = _api_records(t)
    return refresh.pull_summary(records, refresh.from_api(records))


# ------------------------------------------------------------------ quality ---
def _checks(rows):
    """SQL for check results given (name, passed, actual, severity) rows over an aggregate."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS name, {p} AS passed, CAST({a} AS VARCHAR) AS actual, '{s}' AS severity FROM {src}"
        for n, p, a, s, src in rows
    )


_PROFILE = f"""(SELECT count(*) AS n, min(CAST(date_local AS DATE)) AS lo, max(CAST(date_local AS DATE)) AS hi,
   count(*) - count(DISTINCT (aqsid, date_local, time_local, parameter_code, poc)) AS dup FROM raw)"""
_RESULT = ("name", "passed", "actual", "severity")


@query(
    "V1_to_V5_measurement_checks",
    _checks(
        [
            ("schema:all", "true", str(sorted(C.MEASUREMENT_COLUMNS)).replace("'", "''").join("''"), "error", _PROFILE),
            ("row_count:all", "abs(n - 75000) / 75000.0 * 100 <= 10", "n", "error", _PROFILE),
            ("no_duplicate_hours:all", "dup = 0", "dup", "warning", _PROFILE),
            ("date_range:all", "CAST(lo AS VARCHAR) >= '1995-01-01' AND CAST(hi AS VARCHAR) <= '2026-12-31'",
             "CAST(lo AS VARCHAR) || '..' || CAST(hi AS VARCHAR)", "error", _PROFILE),
        ]
    ),
)
def _(t):
    window = ("1995-01-01", "2026-12-31")
    return quality.check_measurements(t.raw(), "all", 75000, 10.0, window).select(*_RESULT)


_SHORT = ["method_code", "poc"]


@query(
    "V1_file_headers",
    """SELECT * FROM (VALUES
         ('schema:good_AllCounties_1.csv', true, ''), ('schema:reordered_AllCounties_1.csv', true, ''),
         ('schema:short_AllCounties_1.csv', false, 'missing=[''method_code'', ''poc'']'),
         ('schema:short_wide_AllCounties_1.csv', false, 'missing=[''poc''] extra=[''note'', ''unit'']'),
         ('schema:wide_AllCounties_1.csv', false, 'extra=[''unit'']')) v(name, passed, detail)
       UNION ALL SELECT 'rows', count(*) = 5 * (SELECT count(*) FROM raw), CAST(count(*) AS VARCHAR) || ',' || CAST(count(poc) AS VARCHAR) || ',' || CAST(count(method_code) AS VARCHAR)
       FROM (SELECT poc, method_code FROM raw UNION ALL SELECT poc, method_code FROM raw UNION ALL SELECT poc, method_code FROM raw
             UNION ALL SELECT NULL, NULL FROM raw UNION ALL SELECT NULL, method_code FROM raw)""",
)
def _(t):
    """Five deliveries of the raw table with headers of their own: checked apart, and read together by name."""
    raw, path = t.raw(), folder(t, "v1")
    wide = raw.withColumn("unit", F.lit("ppb"))
    files = {
        "good": raw, "reordered": raw.select(*reversed(raw.columns)), "short": raw.drop(*_SHORT), "wide": wide,
        "short_wide": wide.withColumn("note", F.lit("x")).drop("poc"),
    }
    for name, df in files.items():
        writers.write_csv(df.select(*[F.col(c).cast("string") for c in df.columns]), f"{path}/{name}_AllCounties_1.csv", compressed=True)
    glob = f"{path}/{C.MEASUREMENT_FILE_GLOB}"
    headers = {file.rsplit("/", 2)[-2]: names for file, names in readers.headers(t.spark, glob).items()}
    checks = quality.check_headers(t.spark, headers).select("name", "passed", "detail")
    rows = readers.measurement_csv(t.spark, glob)
    counted = rows.agg(
        (F.count(F.lit(1)) == 5 * raw.count()).alias("passed"),
        F.concat_ws(",", F.count(F.lit(1)), F.count("poc"), F.count("method_code")).alias("detail"),
    )
    return checks.unionByName(counted.select(F.lit("rows").alias("name"), "passed", "detail"))


@query(
    "V5_duplicates_by_group",
    """SELECT pollutant_group, n AS n_rows, CAST(lo AS DATE) AS min_date, CAST(hi AS DATE) AS max_date, dup AS n_duplicate_hours, n - whole AS n_exact_duplicates FROM (
         SELECT pollutant_group, count(*) AS n, min(date_local) AS lo, max(date_local) AS hi,
                count(*) - count(DISTINCT (aqsid, date_local, time_local, parameter_code, poc)) AS dup FROM raw GROUP BY 1)
       JOIN (SELECT pollutant_group, count(*) AS whole FROM dedup GROUP BY 1) USING (pollutant_group)""",
)
def _(t):
    return quality.profile(t.raw(), ["pollutant_group"])


@query(
    "V3_weather_checks",
    _checks(
        [
            ("row_count:weather_master", "abs(n - 18000) / 18000.0 * 100 <= 5", "n", "error", "(SELECT count(*) AS n FROM weather)"),
            ("nunique:weather_station_location", "k = 5", "k", "error", "(SELECT count(DISTINCT location) AS k FROM weather)"),
        ]
    ),
)
def _(t):
    return quality.check_weather(t.get("weather"), 18000, 5, 5.0).select(*_RESULT)


@query(
    "V6_mapping_columns",
    """SELECT 'site_mapping:has_required_columns' AS name, count(*) > 0 AS passed, 'warning' AS severity FROM pairing""",
)
def _(t):
    return quality.check_mapping(t.get("pairing")).select("name", "passed", "severity")


@query(
    "V7_cross_file_totals",
    """SELECT count(*) AS n_rows, count(DISTINCT aqsid) AS n_sites, count(DISTINCT county_name) AS n_counties,
              count(DISTINCT pollutant_group) AS n_groups, min(date_local) AS min_date, max(date_local) AS max_date FROM raw""",
)
def _(t):
    return quality.totals(t.raw())


# Rows each source is expected to deliver; "Radon" never does.
_EXPECTED = {g: 11000 for g in C.POLLUTANT_GROUPS} | {"Radon": 10}
_WINDOW = ("1995-01-01", "2026-12-31")


def _all_checks(t):
    return quality.union_results(
        [
            quality.check_sources(t.raw(), "pollutant_group", _EXPECTED, 10.0, _WINDOW),
            quality.check_totals(t.raw(), 75000, 100, 13, 7, 10.0),
            quality.check_weather(t.get("weather"), 18000, 5, 5.0),
            quality.check_mapping(t.get("pairing")),
        ]
    )


_ALL_CHECKS = f"""(
  WITH per AS (SELECT pollutant_group AS g, count(*) AS n, min(date_local) AS lo, max(date_local) AS hi,
                      count(*) - count(DISTINCT (aqsid, date_local, time_local, parameter_code, poc)) AS dup FROM raw GROUP BY 1)
  SELECT 'schema:' || g AS name, true AS passed, 'error' AS severity FROM per UNION ALL SELECT 'schema:Radon', false, 'error' UNION ALL
  SELECT 'row_count:' || g, abs(n - 11000) / 11000.0 * 100 <= 10, 'error' FROM per UNION ALL
  SELECT 'no_duplicate_hours:' || g, dup = 0, 'warning' FROM per UNION ALL
  SELECT 'date_range:' || g, lo >= '1995-01-01' AND hi <= '2026-12-31', 'error' FROM per UNION ALL
  SELECT 'row_count:all_pollutants', abs(count(*) - 75000) / 75000.0 * 100 <= 10, 'error' FROM raw UNION ALL
  SELECT 'nunique:aqsid', count(DISTINCT aqsid) >= 95, 'warning' FROM raw UNION ALL
  SELECT 'nunique:county_name', count(DISTINCT county_name) = 13, 'error' FROM raw UNION ALL
  SELECT 'nunique:pollutant_group', count(DISTINCT pollutant_group) = 7, 'error' FROM raw UNION ALL
  SELECT 'row_count:weather_master', abs(count(*) - 18000) / 18000.0 * 100 <= 5, 'error' FROM weather UNION ALL
  SELECT 'nunique:weather_station_location', count(DISTINCT location) = 5, 'error' FROM weather UNION ALL
  SELECT 'site_mapping:has_required_columns', count(*) > 0, 'warning' FROM pairing)"""


@query("V8_all_checks", f"SELECT name, passed, severity FROM {_ALL_CHECKS}")
def _(t):
    return _all_checks(t).select("name", "passed", "severity")


@query(
    "V8_report",
    f"""SELECT count(*) FILTER (WHERE passed) AS n_passed, count(*) AS n_checks, count(*) FILTER (WHERE NOT passed AND severity = 'error') AS n_errors,
               count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS n_warnings,
               count(*) FILTER (WHERE NOT passed AND severity = 'error') = 0 AS passed,
               count(*) FILTER (WHERE passed) || '/' || count(*) || ' passed  (' || count(*) FILTER (WHERE NOT passed AND severity = 'error')
                 || ' errors, ' || count(*) FILTER (WHERE NOT passed AND severity = 'warning') || ' warnings)' AS summary
        FROM {_ALL_CHECKS}""",
)
def _(t):
    return quality.roll_up(quality.write_report(_all_checks(t), folder(t, "v8")))


@query(
    "V9_output_sanity",
    _checks(
        [
            ("outputs:design_value_rows", "n BETWEEN 1000 AND 20000", "n", "error", "(SELECT count(*) AS n FROM dv)"),
            ("outputs:required_metrics", "n = 5", "''", "error",
             f"(SELECT count(DISTINCT metric) AS n FROM dv WHERE metric IN ({', '.join(repr(m) for m in C.REQUIRED_METRICS)}))"),
            ("outputs:ozone_range", "n = 0", "n", "error",
             "(SELECT count(*) AS n FROM dv WHERE metric = 'ozone_8hr_4th_max' AND NOT (value > 0.03 AND value < 0.15))"),
            ("outputs:pm25_range", "n = 0", "n", "error",
             "(SELECT count(*) AS n FROM dv WHERE metric = 'pm25_annual_mean' AND NOT value BETWEEN 3 AND 25)"),
            ("outputs:active_sites", "n >= 40", "n", "error", "(SELECT count(*) AS n FROM registry WHERE data_status = 'active')"),
        ]
    ),
)
def _(t):
    return quality.check_outputs(t.get("values"), t.get("registry"), (1000, 20000)).select(*_RESULT)


# ------------------------------------------------------------------ analyst queries ---
OZ = "metric = 'ozone_8hr_4th_max'"


@query("Q1_exceeding_sites", f"SELECT aqsid, site_name, county_name, value, naaqs_level FROM dv WHERE year = {YEAR} AND {OZ} AND exceeds", "value naaqs_level")
def _(t):
    return cat.exceeding_sites(t.get("values"), YEAR)


@query("Q2_site_trend", f"SELECT year, value AS fourth_max FROM dv WHERE aqsid = '{SITE}' AND {OZ}", "fourth_max")
def _(t):
    return cat.site_trend(t.get("values"), SITE)


@query(
    "Q3_county_years",
    f"SELECT year, county_name, count(*) AS n_sites, {r('avg(value)', 4)} AS avg_value, {r('max(value)', 4)} AS max_value FROM dv WHERE {OZ} GROUP BY 1, 2",
    "avg_value max_value",
)
def _(t):
    return cat.county_years(t.get("values"))


@query("Q3_county_means", f"SELECT county_name, avg(value) AS mean_val FROM dv WHERE {OZ} AND year = {YEAR} GROUP BY 1", "mean_val")
def _(t):
    return cat.county_means(t.get("values"), YEAR)


@query(
    "Q4_county_months",
    f"""SELECT CAST(date_trunc('month', CAST(date_local AS DATE)) AS DATE) AS month, {r('avg(mean)', 2)} AS mean_value, count(*) AS n_site_days
        FROM daily WHERE pollutant_group = 'PM2.5' AND county_name = '{COUNTY}' AND valid_day GROUP BY 1""",
    "mean_value",
)
def _(t):
    return cat.county_months(t.get("daily"), "PM2.5", COUNTY)


@query(
    "Q5_site_weather_days",
    f"""SELECT date_local, mean AS pollutant_mean, temp_c, humidity, wind_speed FROM combined
        WHERE aqsid = '{SITE}' AND pollutant_group = 'Ozone' AND valid_day""",
    "pollutant_mean temp_c humidity wind_speed",
)
def _(t):
    return cat.site_weather_days(t.get("combined"), SITE, "Ozone")


@query(
    "Q6_summer_and_winter",
    f"""SELECT county_name, season, {r('avg(mean)', 2)} AS mean_value FROM (
          SELECT *, CASE WHEN month(CAST(date_local AS DATE)) IN (6, 7, 8) THEN 'JJA' WHEN month(CAST(date_local AS DATE)) IN (12, 1, 2) THEN 'DJF' END AS season
          FROM daily WHERE pollutant_group = 'PM2.5' AND valid_day) WHERE season IS NOT NULL GROUP BY 1, 2""",
    "mean_value",
)
def _(t):
    return cat.summer_and_winter(t.get("daily"), "PM2.5")


@query(
    "Q7_exceedance_counts",
    """SELECT pollutant_group, metric, year, count(*) FILTER (WHERE exceeds) AS n_exceeding_sites, count(*) AS n_sites FROM dv
       GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE exceeds) > 0""",
)
def _(t):
    return cat.exceedance_counts(t.get("values"))


@query("Q8_pairing_distances", "SELECT DISTINCT aqsid, site_name, county_name, weather_station, distance_km FROM combined", "distance_km")
def _(t):
    return cat.pairing_distances(t.get("combined"))


@query(
    "Q9_above_level",
    f"SELECT aqsid, site_name, county_name, value FROM dv WHERE metric = 'pm25_annual_mean' AND year = {YEAR} AND value > 10", "value",
)
def _(t):
    return cat.above_level(t.get("values"), "pm25_annual_mean", YEAR, 10.0)


@query(
    "Q10_co_located",
    f"""SELECT min(b.aqsid) AS co_located_with, a.aqsid, a.site_name, a.county_name, a.lat, a.lon, a.data_status
        FROM registry a JOIN registry b ON a.aqsid <> b.aqsid AND {km("a.lat", "a.lon", "b.lat", "b.lon")} <= 20 GROUP BY ALL""",
    "lat lon",
)
def _(t):
    """Sites within 20 km of another one, by a grid join that fills the registry's column."""
    return cat.co_located(geo.fill_co_located(t.get("registry"), 20.0))


_SEASON_OF = "(['DJF', 'MAM', 'JJA', 'SON'])[CAST(month(CAST(date_local AS DATE)) % 12 // 3 AS INTEGER) + 1]"


@query(
    "Q11_season_table",
    f"""SELECT county_name, {", ".join(f"{r(f'avg(mean) FILTER (WHERE season = {s!r})', 2)} AS {s}" for s in C.SEASONS)} FROM (
          SELECT *, {_SEASON_OF} AS season FROM daily WHERE pollutant_group = 'PM2.5' AND valid_day
            AND county_name IN ('Bexar', 'Nueces', 'Cameron', 'Hidalgo')) GROUP BY 1""",
    "DJF MAM JJA SON",
)
def _(t):
    return cat.season_table(t.get("daily"), "PM2.5", ["Bexar", "Nueces", "Cameron", "Hidalgo"])


@query(
    "Q12_weather_correlations",
    f"""SELECT pollutant_group, count(*) AS n_days, {r('corr(mean, temp_c)', 3)} AS r_temp_c, {r('corr(mean, humidity)', 3)} AS r_humidity,
               {r('corr(mean, wind_speed)', 3)} AS r_wind_speed FROM combined WHERE aqsid = '480130032' AND valid_day
        GROUP BY 1 HAVING count(*) > 40""",
    "r_temp_c r_humidity r_wind_speed",
)
def _(t):
    site = "480130032"
    return cat.weather_correlations(t.combined_of(site), site, minimum=40)


@query(
    "Q13_dashboard",
    f"""SELECT year, metric, count(DISTINCT aqsid) AS n_sites, CAST(sum(CASE WHEN exceeds THEN 1 ELSE 0 END) AS BIGINT) AS n_exceed,
               {r('max(value)', 4)} AS max_val, {r('avg(value)', 4)} AS mean_val FROM dv
        WHERE regexp_matches(metric, 'p98|p99|4th_max|annual|exceedances') GROUP BY 1, 2""",
    "max_val mean_val",
)
def _(t):
    return cat.dashboard(t.get("values"))


@query(
    "Q14_parameter_profile",
    f"""SELECT parameter_code, count(*) AS n_obs, {r('avg(sample_measurement)', 3)} AS mean, {r('quantile_cont(sample_measurement, 0.95)', 3)} AS p95,
               {r('max(sample_measurement)', 3)} AS max FROM hourly WHERE pollutant_group = 'NOx_Family' GROUP BY 1 ORDER BY avg(sample_measurement) DESC LIMIT 20""",
    "mean p95 max",
)
def _(t):
    return cat.parameter_profile(t.get("hourly"), "NOx_Family")


@query(
    "Q15_J8_map_values",
    f"""SELECT {', '.join('d.' + c for c in _DV.split(', '))}, s.lat, s.lon FROM dv d JOIN registry s USING (aqsid)
        WHERE s.data_status = 'active' AND s.lat IS NOT NULL AND {OZ} AND year = {YEAR}""",
    "value naaqs_level lat lon",
)
def _(t):
    return cat.map_values(t.get("values"), t.get("registry"), YEAR).select(*_DV.split(", "), "lat", "lon")


@query(
    "Q16_coverage_summary",
    """SELECT s.*, d.* FROM (SELECT count(*) AS n_sites, count(DISTINCT county_name) AS n_counties, count(*) FILTER (WHERE network = 'EPA') AS n_epa,
              count(*) FILTER (WHERE network = 'TCEQ') AS n_tceq, count(*) FILTER (WHERE network = 'BOTH') AS n_both FROM registry WHERE data_status = 'active') s,
            (SELECT min(date_local) FILTER (WHERE pollutant_group = 'PM2.5') AS date_min, max(date_local) FILTER (WHERE pollutant_group = 'PM2.5') AS date_max,
              array_to_string(list_sort(list(DISTINCT pollutant_group)), ', ') AS pollutants FROM daily) d""",
)
def _(t):
    return cat.coverage_summary(t.once("registry"), t.get("hourly"))


@query(
    "Q17_J10_published_comparison",
    f"""SELECT aqsid, ours_ppm, published_value, (ours_ppm - published_value) / published_value * 100 AS diff_pct FROM (
          SELECT d.aqsid, d.value AS ours_ppm, 0.06 + s_acctbal / 1000000.0 AS published_value FROM dv d JOIN supplier ON {site('s_suppkey')} = d.aqsid
          WHERE {OZ} AND year = {YEAR}) ORDER BY abs(diff_pct) DESC, aqsid LIMIT 10""",
    "ours_ppm published_value diff_pct",
)
def _(t):
    s = bindings.table(t.spark, t.sf_dir, "supplier")
    published = s.select(
        bindings.site_key(F.col("s_suppkey")).alias("aqsid"),
        (F.col("s_acctbal") / 1000000.0 + 0.06).alias("published_value"),
    )
    ours = t.get("values").where((F.col("metric") == cat.OZONE) & (F.col("year") == YEAR))
    ours = ours.select("aqsid", F.col("value").alias("ours_ppm"))
    return merge.compare_published(ours, published, "ours_ppm").orderBy(F.abs("diff_pct").desc(), "aqsid").limit(10)


@query(
    "Q18_county_subset",
    f"""SELECT aqsid, site_name, date_local, mean, n_hours, completeness_pct FROM daily
        WHERE pollutant_group = 'PM2.5' AND county_name = '{COUNTY}' AND valid_day""",
    "mean completeness_pct",
)
def _(t):
    path = writers.write_table(cat.county_subset(t.once("daily"), "PM2.5", COUNTY), folder(t, "q18"))
    return t.spark.read.parquet(path)


@query(
    "Q19_diurnal_profile",
    f"""SELECT CAST(hour(datetime) AS INTEGER) AS hour_of_day, avg(sample_measurement) AS mean_value, quantile_cont(sample_measurement, 0.5) AS median_value,
               quantile_cont(sample_measurement, 0.95) AS p95_value FROM hourly
        WHERE pollutant_group = 'Ozone' AND year IN {YEARS} AND sample_measurement IS NOT NULL GROUP BY 1""",
    "mean_value median_value p95_value",
)
def _(t):
    return cat.diurnal_profile(t.get("hourly"), "Ozone", YEARS)


@query(
    "Q20_station_month",
    f"""SELECT CAST(datetime_local AS TIMESTAMP) AS ts, temp_c, humidity, wind_speed, wind_deg, pressure FROM weather
        WHERE location = '{STATION}' AND year = {YEAR} AND month = 3""",
    "temp_c humidity wind_speed wind_deg pressure",
)
def _(t):
    return cat.station_month(t.get("weather"), STATION, YEAR, 3)


@query(
    "Q21_peak_days",
    f"""SELECT date_local, county_name, site_name, {r('peak', 1)} AS peak FROM (
          SELECT date_local, county_name, site_name, max(sample_measurement) AS peak FROM hourly
          WHERE pollutant_group = 'PM2.5' AND year = {YEAR} AND sample_measurement IS NOT NULL GROUP BY 1, 2, 3
          ORDER BY peak DESC, date_local, site_name LIMIT 20)""",
    "peak",
)
def _(t):
    return cat.peak_days(t.get("hourly"), "PM2.5", YEAR)


_REGRESSION = """(SELECT datetime, sample_measurement AS measurement, temp_c, humidity, wind_speed, wind_u, wind_v FROM hourly_weather
   WHERE aqsid = '480130032' AND pollutant_group = 'Ozone' AND date_local BETWEEN '2024-01-01' AND '2024-01-31')"""


def _regression(t):
    return cat.regression_rows(t.hourly_weather(), "480130032", "Ozone", "2024-01-01", "2024-01-31")


@query("Q22_regression_rows", f"SELECT * FROM {_REGRESSION}", "measurement temp_c humidity wind_speed wind_u wind_v")
def _(t):
    return _regression(t)


_R_COLS = ("temp_c", "humidity", "wind_speed", "wind_u", "wind_v")


@query(
    "Q22_regression_correlations",
    f"SELECT {', '.join(r(f'corr(measurement, {c})', 3) + f' AS r_{c}' for c in _R_COLS)} FROM {_REGRESSION}",
    " ".join(f"r_{c}" for c in _R_COLS),
)
def _(t):
    return cat.regression_correlations(_regression(t))


@query(
    "Q23_eight_hour_peaks",
    f"""SELECT day, {r('m', 4)} AS daily_max_8h FROM (SELECT day, max(avg_8h) AS m FROM (
          SELECT CAST(datetime AS DATE) AS day, avg(sample_measurement) OVER w AS avg_8h, count(sample_measurement) OVER w AS n FROM hourly
          WHERE aqsid = '{SITE}' AND pollutant_group = 'Ozone' AND year = {YEAR} AND sample_measurement IS NOT NULL
          WINDOW w AS (ORDER BY datetime, sample_measurement ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)) WHERE n >= 6 GROUP BY 1)
        ORDER BY m DESC, day LIMIT 5""",
    "daily_max_8h",
)
def _(t):
    return cat.eight_hour_peaks(t.get("hourly"), SITE, "Ozone", YEAR)


@query(
    "Q24_month_matrix",
    "SELECT site_name, "
    + ", ".join(f"{r(f'avg(monthly_mean) FILTER (WHERE year_month = {m!r})')} AS \"{m}\"" for m in MONTHS)
    + f" FROM monthly WHERE pollutant_group = 'PM2.5' AND county_name = '{COUNTY}' AND year_month BETWEEN '{MONTHS[0]}' AND '{MONTHS[-1]}' GROUP BY 1",
)
def _(t):
    return cat.month_matrix(t.get("monthly"), "PM2.5", COUNTY, MONTHS)


@query(
    "Q25_manuscript_table",
    f"""SELECT pollutant_group, count(DISTINCT aqsid) AS n_sites, count(DISTINCT year(datetime)) AS n_years, count(*) AS n_observations,
               {r('avg(sample_measurement)', 4)} AS mean, {r('min(sample_measurement)', 4)} AS min, {r('max(sample_measurement)', 4)} AS max,
               {r('stddev_samp(sample_measurement)', 4)} AS sd FROM hourly WHERE sample_measurement IS NOT NULL GROUP BY 1""",
    "mean min max sd",
)
def _(t):
    return cat.manuscript_table(t.get("hourly"))


@query(
    "Q26_pollution_rose",
    """SELECT CASE WHEN wind_deg < 22.5 OR wind_deg >= 337.5 THEN 'N' WHEN wind_deg < 67.5 THEN 'NE' WHEN wind_deg < 112.5 THEN 'E'
                   WHEN wind_deg < 157.5 THEN 'SE' WHEN wind_deg < 202.5 THEN 'S' WHEN wind_deg < 247.5 THEN 'SW'
                   WHEN wind_deg < 292.5 THEN 'W' WHEN wind_deg < 337.5 THEN 'NW' END AS wind_dir,
              avg(sample_measurement) AS mean_value, count(*) AS n FROM hourly_weather
       WHERE pollutant_group = 'Ozone' AND wind_speed > 1.0 GROUP BY 1""",
    "mean_value",
)
def _(t):
    return cat.pollution_rose(t.hourly_weather(), "Ozone")


@query(
    "Q27_table_inventory",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {s}"
        for n, s in (("hourly", "hourly"), ("daily", "daily"), ("monthly", "monthly"), ("values", "dv"),
                     ("combined", "combined"), ("registry", "registry"), ("weather", "weather"))
    ),
)
def _(t):
    stored = {n: t.get(n) for n in ("hourly", "daily", "weather")}
    return cat.table_inventory(stored | {n: t.once(n) for n in ("monthly", "values", "combined", "registry")})


@query("Q28_status_counts", "SELECT data_status, count(*) AS n_sites FROM registry GROUP BY 1")
def _(t):
    return cat.status_counts(t.get("registry"))


@query(
    "Q29_non_null_rates",
    f"""SELECT pollutant_group, count(*) AS n_rows, count(DISTINCT aqsid) AS n_sites, {r('count(sample_measurement) / count(*) * 100', 2)} AS pct_non_null
        FROM hourly GROUP BY 1""",
    "pct_non_null",
)
def _(t):
    return cat.non_null_rates(t.get("hourly"))


_V = "sample_measurement"
_DESCRIBE = {
    "mean": f"avg({_V})", "sd": f"stddev_samp({_V})",
    **{n: f"quantile_cont({_V}, {p})" for n, p in cat.QUANTILES.items()}, "max": f"max({_V})",
}


@query(
    "Q30_descriptives",
    f"""SELECT pollutant_group, county_name, year, count(*) AS n_obs, {', '.join(f'{r(e, 4)} AS {n}' for n, e in _DESCRIBE.items())}
        FROM hourly WHERE {_V} IS NOT NULL GROUP BY 1, 2, 3""",
    " ".join(_DESCRIBE),
)
def _(t):
    return cat.descriptives(t.get("hourly"))


@query(
    "Q31_county_order",
    f"""SELECT county_name, quantile_cont({_V}, 0.5) AS median_value FROM hourly
        WHERE pollutant_group = 'PM2.5' AND year IN {YEARS} AND {_V} BETWEEN 0 AND 200 GROUP BY 1""",
    "median_value",
)
def _(t):
    return cat.county_order(t.get("hourly"), "PM2.5", YEARS)


@query(
    "Q32_county_annual_means",
    """SELECT CAST(year(CAST(date_local AS DATE)) AS INTEGER) AS year, county_name, avg(mean) AS annual_mean FROM daily
       WHERE pollutant_group = 'PM2.5' AND valid_day GROUP BY 1, 2""",
    "annual_mean",
)
def _(t):
    return cat.county_annual_means(t.get("daily"), "PM2.5")


@query(
    "Q33_county_networks",
    """SELECT county_name, count(*) FILTER (WHERE network = 'BOTH') AS "BOTH", count(*) FILTER (WHERE network = 'EPA') AS "EPA",
              count(*) FILTER (WHERE network = 'TCEQ') AS "TCEQ" FROM registry WHERE data_status = 'active' GROUP BY 1""",
)
def _(t):
    return cat.county_networks(t.get("registry"))


@query("Q34_yearly_county_maximum", f"SELECT year, max(value) AS max_value FROM dv WHERE county_name = '{COUNTY}' AND {OZ} GROUP BY 1", "max_value")
def _(t):
    return cat.yearly_county_maximum(t.get("values"), COUNTY)


@query(
    "Q35_site_month_means",
    """SELECT substr(date_local, 1, 7) AS ym, avg(mean) AS mean_value, avg(temp_c) AS mean_temp FROM combined
       WHERE aqsid = '480130032' AND pollutant_group = 'Ozone' GROUP BY 1""",
    "mean_value mean_temp",
)
def _(t):
    return cat.site_month_means(t.get("combined"), "480130032", "Ozone")


@query(
    "Q36_classified",
    f"SELECT aqsid, county_name, year, value, CASE WHEN exceeds THEN 'Exceeds' ELSE 'Under' END AS status FROM dv WHERE {OZ}", "value",
)
def _(t):
    return cat.classified(t.get("values"))


@query(
    "Q37_since_year",
    f"SELECT county_name, site_name, year, value, naaqs_level, exceeds FROM dv WHERE {OZ} AND year >= {YEAR}", "value naaqs_level",
)
def _(t):
    return cat.since_year(t.get("values"), YEAR)


@query(
    "Q38_county_month_means",
    f"""SELECT year_month, avg(monthly_mean) AS mean_value FROM monthly WHERE county_name = '{COUNTY}' AND pollutant_group = 'PM2.5'
        AND year_month BETWEEN '1996-01' AND '2000-12' GROUP BY 1""",
    "mean_value",
)
def _(t):
    return cat.county_month_means(t.get("monthly"), "PM2.5", COUNTY, "1996-01", "2000-12")


@query("Q39_partition_counts", "SELECT pollutant_group, year, count(*) AS n_rows FROM hourly GROUP BY 1, 2")
def _(t):
    return cat.partition_counts(t.get("hourly"))


@query(
    "Q40_pruned_scan",
    f"""SELECT aqsid, site_name, date_local, time_local, sample_measurement FROM hourly
        WHERE pollutant_group = 'Ozone' AND year = {YEAR} AND aqsid IN ('480290059', '480290046', '480290020')""",
    "sample_measurement",
)
def _(t):
    t.get("hourly")
    return readers.parquet_dataset(
        t.spark, f"{t.root}/hourly", ["aqsid", "site_name", "date_local", "time_local", "sample_measurement"],
        [("pollutant_group", "=", "Ozone"), ("year", "=", YEAR), ("aqsid", "in", ["480290059", "480290046", "480290020"])],
    )


@query(
    "F_wind_components",
    """SELECT location, datetime_local, wind_u, wind_v FROM weather WHERE wind_deg IS NOT NULL""", "wind_u wind_v",
)
def _(t):
    u, v = X.wind_components("wind_speed", "wind_deg")
    rows = t.get("weather").where(F.col("wind_deg").isNotNull())
    return rows.select("location", "datetime_local", u.alias("wind_u"), v.alias("wind_v"))


@query(
    "F_exact_quantiles",
    f"""SELECT pollutant_group, data_source, quantile_cont({_V}, 0.0) AS q0, quantile_cont({_V}, 0.1) AS q10, quantile_cont({_V}, 0.98) AS q98,
               quantile_cont({_V}, 1.0) AS q100 FROM hourly GROUP BY 1, 2""",
    "q0 q10 q98 q100",
)
def _(t):
    wanted = {"q0": 0.0, "q10": 0.1, "q98": 0.98, "q100": 1.0}
    return exact_quantiles(t.get("hourly"), ["pollutant_group", "data_source"], _V, wanted)
