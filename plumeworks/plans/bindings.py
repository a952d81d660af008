"""Projections that read the star-schema test tables as monitoring data.

``lineitem`` and ``events`` together become raw measurements (seven years of sparse sites plus
one dense month), ``orders`` and ``events`` the weather master, ``supplier`` two overlapping
coordinate files. Only columns are derived and every row takes part, but for the suppliers: the overlapping
coordinate files hold those of some balances (:func:`site_coordinate_sources`).
"""

from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.functions.expressions import wind_components, zero_fill

TABLES = ["lineitem", "events", "orders", "customer", "supplier"]

_PARAMETER_BY_LINE = [44201, 88101, 81102, 42101, 42401, 42602, 43202]
_GROUP_BY_LINE = ["Ozone", "PM2.5", "PM10", "CO", "SO2", "NOx_Family", "VOCs"]
_LINE_BY_EVENT = {"view": 1, "click": 2, "purchase": 3, "signup": 4}
_PRIORITY_BY_EVENT = {
    "view": "1-URGENT", "click": "2-HIGH", "purchase": "3-MEDIUM", "signup": "4-NOT SPECIFIED",
}
_STATION_COUNTY = ["Bexar", "Atascosa", "Cameron", "Comal", "Kleberg"]


def table(spark, sf_dir, name):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, position):
    return F.get(F.array(*[F.lit(v) for v in values]), position)


def _county_position(number):
    """Sites are spread over the counties by number; site 59 lands in the second one."""
    return ((number + 7) % len(C.COUNTIES)).cast("int")


def county_code(number):
    return _pick([c for c, _ in C.COUNTIES], _county_position(number))


def county_name(number):
    return _pick([n for _, n in C.COUNTIES], _county_position(number))


def site_key(number):
    prefix = _pick([f"48{c:03d}" for c, _ in C.COUNTIES], _county_position(number))
    return F.concat(prefix, zero_fill(number.cast("string"), 4))


def _measurements(rows):
    """Shared projection from (number, line, variant, source, poc, day, clock, x)."""
    number, line, x = F.col("number"), F.col("line"), F.col("x")
    tceq = F.col("source") == "TCEQ"
    parameter = (
        F.when((line == 2) & tceq, 88502)
        .when((line == 6) & (F.col("variant") == "F"), 42601)
        .otherwise(_pick(_PARAMETER_BY_LINE, line - 1))
    )
    name = (
        F.when(line == 6, F.when(F.col("variant") == "F", "NO").otherwise("NO2"))
        .when(line == 7, "VOC_43202")
        .otherwise(_pick(_GROUP_BY_LINE, line - 1))
    )
    scaled = (
        F.when((line == 1) & ~tceq, x * 0.001)
        .when(line == 2, x * 0.2)
        .when(line == 3, x * 3.0)
        .when(line == 4, x * 0.1)
        .otherwise(x)
    )
    upper_name = _pick([n.upper() for _, n in C.COUNTIES], _county_position(number))
    county = F.when(~((line == 7) & (F.col("variant") == "O")), upper_name)
    return rows.select(
        F.lit(48).alias("state_code"),
        county_code(number).alias("county_code"),
        number.cast("int").alias("site_number"),
        parameter.alias("parameter_code"),
        F.col("poc").cast("int").alias("poc"),
        F.col("day").alias("date_local"),
        F.col("clock").alias("time_local"),
        F.when(x >= 5.0, scaled).alias("sample_measurement"),
        (F.lit(40) + line).cast("int").alias("method_code"),
        county.alias("county_name"),
        name.alias("pollutant_name"),
        site_key(number).alias("aqsid"),
        F.col("source").alias("data_source"),
        _pick(_GROUP_BY_LINE, line - 1).alias("pollutant_group"),
        F.concat(county_name(number), F.lit("_"), zero_fill(number.cast("string"), 4)).alias("site_name"),
    )


def raw_measurements(spark, sf_dir):
    """The 15-column raw table, with exact copies, unparseable times, nulls and both sources."""
    li = table(spark, sf_dir, "lineitem")
    hour = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24).cast("string")
    broken = (F.col("l_tax") > 0.075) & (F.col("l_discount") > 0.095)
    copies = F.when(F.col("l_discount") > 0.085, 2).otherwise(1)
    lines = li.select(
        F.col("l_suppkey").alias("number"),
        F.col("l_linenumber").alias("line"),
        F.col("l_linestatus").alias("variant"),
        F.when(F.col("l_returnflag") == "N", "TCEQ").otherwise("EPA").alias("source"),
        (F.col("l_partkey") % 2 + 1).alias("poc"),
        F.to_date("l_shipdate").cast("string").alias("day"),
        F.concat(F.when(broken, "24").otherwise(hour), F.lit(":00")).alias("clock"),
        (F.col("l_extendedprice") / 1000.0).alias("x"),
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")
    ev = table(spark, sf_dir, "events")
    even = F.col("user_id") % 2 == 0
    kinds = F.when(F.col("event_type") == "error", F.when(even, 5).otherwise(6))
    for event, position in _LINE_BY_EVENT.items():
        kinds = kinds.when(F.col("event_type") == event, position)
    hits = ev.select(
        F.when(even, 32).otherwise(52).cast("long").alias("number"),
        kinds.alias("line"),
        F.lit("O").alias("variant"),
        F.when(F.col("user_id") % 4 < 2, "EPA").otherwise("TCEQ").alias("source"),
        (F.col("user_id") % 3 + 1).alias("poc"),
        F.to_date("ts").cast("string").alias("day"),
        F.concat(zero_fill(F.hour("ts").cast("string"), 2), F.lit(":00")).alias("clock"),
        F.col("value").alias("x"),
    )
    return _measurements(lines).unionByName(_measurements(hits))


def raw_weather(spark, sf_dir):
    """The weather master: one row per station and hour, temperature in Kelvin."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"),
        F.timestamp_add("HOUR", ((F.col("o_orderkey") * 5) % 24).cast("int"), F.col("o_orderdate")).alias("h"),
        (F.col("o_totalprice") / 1000.0).alias("x"),
    )
    by_event = F.lit("5-LOW")
    for event, priority in _PRIORITY_BY_EVENT.items():
        by_event = F.when(F.col("event_type") == event, priority).otherwise(by_event)
    hour = F.timestamp_add("HOUR", F.hour("ts"), F.to_date("ts").cast("timestamp_ntz"))
    events = table(spark, sf_dir, "events").select(
        by_event.alias("priority"), hour.alias("h"), F.col("value").alias("x")
    )
    hours = orders.unionByName(events).groupBy("priority", "h").agg(F.max("x").alias("x"))
    x = F.col("x")
    number = F.substring("priority", 1, 1).cast("int")
    county = _pick(_STATION_COUNTY, number - 1)
    label = F.concat(F.lit(" "), county, F.lit(" "), F.translate("priority", "-", "/"), F.lit(" "))
    hours = hours.withColumn("wind_speed", x / 40.0).withColumn(
        "wind_deg", F.when(x >= 10.0, (x * 7.2) % 360.0)
    )
    wind_u, wind_v = wind_components("wind_speed", "wind_deg")
    located = x >= 20.0
    return hours.select(
        F.floor(F.unix_micros(F.col("h").cast("timestamp")) / 1000000).cast("long").alias("dt"),
        F.col("h").cast("string").alias("datetime_local"),
        F.substring(F.col("h").cast("string"), 1, 16).alias("date_local"),
        F.year("h").alias("year"),
        F.month("h").alias("month"),
        F.hour("h").alias("hour_local"),
        label.alias("site_name"),
        F.upper(county).alias("county_name"),
        F.when(located, F.lit(26.013) + number * 0.817).alias("lat"),
        F.when(located, F.lit(-97.021) - number * 0.533).alias("lon"),
        (x / 20.0 + 278.15).alias("temp"),
        (x / 20.0 + 4.0).alias("feels_like"),
        (x / 25.0 + 270.15).alias("dew_point"),
        F.least(x / 5.0 + 20.0, F.lit(100.0)).alias("humidity"),
        (x / 10.0 + 990.0).alias("pressure"),
        F.least(x / 4.0, F.lit(100.0)).alias("clouds_all"),
        (F.lit(10000.0) - x * 10.0).alias("visibility"),
        "wind_speed",
        "wind_deg",
        (x / 30.0).alias("wind_gust"),
        wind_u.alias("wind_u"),
        wind_v.alias("wind_v"),
        F.when(x >= 60.0, x / 100.0).alias("rain_1h"),
        F.when(x >= 100.0, x / 10.0).alias("heat_index_c"),
        (x * 2.0).alias("ghi_cloudy_sky"),
        F.when(x >= 20.0, x * 2.5).alias("ghi_clear_sky"),
    )


def site_coordinate_sources(spark, sf_dir, complete=False):
    """A verified and a second coordinate list; they overlap and neither is complete, unless all suppliers are asked for."""
    s = table(spark, sf_dir, "supplier")
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    lat = (key * 37 % 500) / 100.0 + 25.013
    lon = (key * 91 % 400) / 100.0 - 100.017
    first = (s if complete else s.where(balance >= 6000.0)).select(
        site_key(key).alias("aqsid"), lat.alias("lat"), lon.alias("lon")
    )
    second = (s if complete else s.where(balance.between(0.0, 7000.0))).select(
        site_key(key).alias("aqsid"),
        (lat + 0.5).alias("lat"),
        F.when(F.col("s_nationkey") != 3, lon + 0.5).alias("lon"),
    )
    return [first, second]


def customer_sites(spark, sf_dir):
    """Customers as sites with coordinates, for the nearest-station join at table size."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("aqsid"),
        ((key * 611 % 6007) / 50.0 - 60.0).alias("lat"),
        ((key * 907 % 17011) / 50.0 - 170.0).alias("lon"),
    )


def supplier_stations(spark, sf_dir):
    """Suppliers as stations with coordinates."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("location"),
        ((key * 389 % 5003) / 45.0 - 55.0).alias("lat"),
        ((key * 733 % 15013) / 43.0 - 174.0).alias("lon"),
    )


def crowded(places, key, lat_step, lon_step):
    """The places of a table moved into one town: a square of a twentieth of a degree, some 5 km wide."""
    return places.withColumns({
        "lat": F.lit(29.4) + (key * lat_step % 10007) / 200140.0,
        "lon": F.lit(-98.5) + (key * lon_step % 10009) / 200180.0,
    })


def crowded_sites(spark, sf_dir):
    """All customers as sites of one town."""
    key = F.col("c_custkey")
    return crowded(table(spark, sf_dir, "customer"), key, 611, 907).select(F.col("c_name").alias("aqsid"), "lat", "lon")


def crowded_stations(spark, sf_dir):
    """All suppliers as stations of the same town."""
    key = F.col("s_suppkey")
    return crowded(table(spark, sf_dir, "supplier"), key, 389, 733).select(F.col("s_name").alias("location"), "lat", "lon")
