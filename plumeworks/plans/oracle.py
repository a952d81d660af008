"""SQL statements that state, independently of the DataFrame code, what each query returns.

Shared derivations are common table expressions; ``with_ctes`` prepends those a query names.
"""

import re

from plumeworks import constants as C

_CODES = ", ".join(str(c) for c, _ in C.COUNTIES)
_NAMES = ", ".join(f"'{n}'" for _, n in C.COUNTIES)


def r(expression, digits=6):
    """Rounding with the same nudge off decimal ties as the DataFrame side."""
    return f"round({expression} + 3.7e-10, {digits})"


def code(number):
    return f"([{_CODES}])[CAST(({number} + 7) % 13 AS INTEGER) + 1]"


def county(number):
    return f"([{_NAMES}])[CAST(({number} + 7) % 13 AS INTEGER) + 1]"


def site(number):
    return f"printf('48%03d%04d', {code(number)}, CAST({number} AS BIGINT))"


def km(lat1, lon1, lat2, lon2):
    return (
        f"2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"
    )


_METRIC_ROWS = """
  SELECT 'Ozone' AS pollutant_group, aqsid, year, 'ozone_8hr_4th_max' AS metric, 'ppm' AS units, 0.07 AS naaqs_level, max_8h AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY aqsid, year ORDER BY max_8h DESC) AS rn FROM {days}
        WHERE pollutant_group = 'Ozone' AND max_8h IS NOT NULL) WHERE rn = 4
  UNION ALL SELECT 'PM2.5', aqsid, year, 'pm25_annual_mean', 'ug/m3', 9.0, avg(valid_mean) FROM {days} WHERE pollutant_group = 'PM2.5' GROUP BY aqsid, year
  UNION ALL SELECT 'PM2.5', aqsid, year, 'pm25_24hr_p98', 'ug/m3', 35.0, quantile_cont(valid_mean, 0.98) FROM {days} WHERE pollutant_group = 'PM2.5' GROUP BY aqsid, year
  UNION ALL SELECT 'PM10', s.aqsid, s.year, 'pm10_24hr_exceedances', 'count', NULL, CAST(coalesce(count(d.day), 0) AS DOUBLE)
  FROM (SELECT aqsid, CAST(unnest(generate_series(min(year), max(year))) AS INTEGER) AS year FROM {days} WHERE pollutant_group = 'PM10' GROUP BY aqsid) s
  LEFT JOIN (SELECT * FROM {days} WHERE pollutant_group = 'PM10' AND valid_mean > 150) d ON d.aqsid = s.aqsid AND d.year = s.year
  GROUP BY s.aqsid, s.year
  UNION ALL SELECT 'CO', aqsid, year, 'co_8hr_max', 'ppm', 9.0, max(mean_8h) FROM rolled_years WHERE pollutant_group = 'CO' GROUP BY aqsid, year
  UNION ALL SELECT 'CO', aqsid, year, 'co_1hr_max', 'ppm', 35.0, max(value) FROM rolled_years WHERE pollutant_group = 'CO' GROUP BY aqsid, year
  UNION ALL SELECT 'SO2', aqsid, year, 'so2_1hr_p99', 'ppb', 75.0, quantile_cont(valid_max, 0.99) FROM {days} WHERE pollutant_group = 'SO2' GROUP BY aqsid, year
  UNION ALL SELECT 'NOx_Family', aqsid, year, 'no2_1hr_p98', 'ppb', 100.0, quantile_cont(valid_max, 0.98) FROM {days} WHERE pollutant_group = 'NOx_Family' GROUP BY aqsid, year
  UNION ALL SELECT 'NOx_Family', aqsid, year, 'no2_annual_mean', 'ppb', 53.0, avg(valid_mean) FROM {days} WHERE pollutant_group = 'NOx_Family' GROUP BY aqsid, year
"""


def _days(min_hours):
    return f"""
  SELECT pollutant_group, aqsid, CAST(datetime AS DATE) AS day, CAST(year(datetime) AS INTEGER) AS year, count(value) AS n_hours,
         CASE WHEN count(value) >= {min_hours} THEN avg(value) END AS valid_mean,
         CASE WHEN count(value) >= {min_hours} THEN max(value) END AS valid_max,
         max(mean_8h) AS max_8h
  FROM rolled GROUP BY 1, 2, 3, 4"""


def _values(rows):
    return f"""
  SELECT m.aqsid, m.year, m.pollutant_group, m.metric, m.value, m.units, CAST(m.naaqs_level AS DOUBLE) AS naaqs_level,
         coalesce(m.value > m.naaqs_level, false) AS exceeds, n.site_name, n.county_name
  FROM {rows} m JOIN series_names n USING (pollutant_group, aqsid) WHERE m.value IS NOT NULL"""


def _daily(threshold):
    return f"""
  SELECT *, n_hours / 24.0 AS completeness_pct, CAST(n_hours / 24.0 AS DOUBLE) >= {threshold} AS valid_day FROM (
    SELECT aqsid, parameter_code, pollutant_name, pollutant_group, county_name, site_name, date_local,
           avg(sample_measurement) AS mean, min(sample_measurement) AS min, max(sample_measurement) AS max,
           stddev_samp(sample_measurement) AS std, count(sample_measurement) AS n_hours
    FROM hourly GROUP BY ALL)"""


def _monthly(daily):
    return f"""
  SELECT aqsid, parameter_code, pollutant_name, pollutant_group, county_name, site_name, substr(date_local, 1, 7) AS year_month,
         avg(mean) AS monthly_mean, min(mean) AS monthly_min, max(mean) AS monthly_max,
         stddev_samp(mean) AS monthly_std, count(mean) AS n_valid_days
  FROM {daily} WHERE valid_day GROUP BY ALL"""


def _static_rows():
    rows = []
    for aqsid, county_no, number, name, county_name, pollutants, status, notes in C.STATIC_REGISTRY_ROWS:
        rows.append(
            f"('{aqsid}', {county_no}, {number}, '{name}', '{county_name}', '{pollutants}', '{status}', '{notes}')"
        )
    return ", ".join(rows)


CTES = {
    "readings": """
  SELECT l_suppkey AS number, l_linenumber AS line, l_linestatus AS variant,
         CASE WHEN l_returnflag = 'N' THEN 'TCEQ' ELSE 'EPA' END AS source, l_partkey % 2 + 1 AS poc,
         strftime(l_shipdate, '%Y-%m-%d') AS day,
         CASE WHEN l_tax > 0.075 AND l_discount > 0.095 THEN '24' ELSE CAST((l_orderkey * 7 + l_linenumber) % 24 AS VARCHAR) END || ':00' AS clock,
         l_extendedprice / 1000.0 AS x
  FROM lineitem CROSS JOIN (VALUES (1), (2)) c(copy) WHERE copy = 1 OR l_discount > 0.085
  UNION ALL
  SELECT CASE WHEN user_id % 2 = 0 THEN 32 ELSE 52 END,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4
              WHEN 'error' THEN CASE WHEN user_id % 2 = 0 THEN 5 ELSE 6 END END,
         'O', CASE WHEN user_id % 4 < 2 THEN 'EPA' ELSE 'TCEQ' END, user_id % 3 + 1,
         strftime(ts, '%Y-%m-%d'), strftime(ts, '%H') || ':00', value
  FROM events""",
    "raw": f"""
  SELECT 48 AS state_code, {code('number')} AS county_code, CAST(number AS INTEGER) AS site_number,
         CASE WHEN line = 2 AND source = 'TCEQ' THEN 88502 WHEN line = 6 AND variant = 'F' THEN 42601
              ELSE ([44201, 88101, 81102, 42101, 42401, 42602, 43202])[line] END AS parameter_code,
         CAST(poc AS INTEGER) AS poc, day AS date_local, clock AS time_local,
         CASE WHEN x >= 5.0 THEN CASE WHEN line = 1 AND source <> 'TCEQ' THEN x * 0.001 WHEN line = 2 THEN x * 0.2
              WHEN line = 3 THEN x * 3.0 WHEN line = 4 THEN x * 0.1 ELSE x END END AS sample_measurement,
         CAST(40 + line AS INTEGER) AS method_code,
         CASE WHEN line = 7 AND variant = 'O' THEN NULL ELSE upper({county('number')}) END AS county_name,
         CASE WHEN line = 6 THEN CASE WHEN variant = 'F' THEN 'NO' ELSE 'NO2' END WHEN line = 7 THEN 'VOC_43202'
              ELSE (['Ozone', 'PM2.5', 'PM10', 'CO', 'SO2'])[line] END AS pollutant_name,
         {site('number')} AS aqsid, source AS data_source,
         (['Ozone', 'PM2.5', 'PM10', 'CO', 'SO2', 'NOx_Family', 'VOCs'])[line] AS pollutant_group,
         {county('number')} || '_' || printf('%04d', CAST(number AS BIGINT)) AS site_name
  FROM readings""",
    "dedup": " SELECT DISTINCT * FROM raw",
    "timed": """
  SELECT * REPLACE (upper(substr(county_name, 1, 1)) || lower(substr(county_name, 2)) AS county_name,
                    sample_measurement * CASE WHEN parameter_code = 44201 AND data_source = 'TCEQ' THEN 0.001 ELSE 1.0 END AS sample_measurement),
         try_strptime(date_local || ' ' || time_local, '%Y-%m-%d %H:%M') AS datetime
  FROM dedup WHERE NOT coalesce(aqsid = '480290059' AND data_source = 'TCEQ', false)""",
    "hourly": """
  SELECT *, CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month, CAST(hour(datetime) AS INTEGER) AS hour,
         (['DJF', 'MAM', 'JJA', 'SON'])[CAST(month(datetime) % 12 // 3 AS INTEGER) + 1] AS season
  FROM timed WHERE datetime IS NOT NULL""",
    "series": """
  SELECT pollutant_group, aqsid, datetime, avg(sample_measurement) AS value FROM hourly
  WHERE pollutant_group <> 'VOCs' AND (pollutant_group <> 'NOx_Family' OR parameter_code = 42602) GROUP BY 1, 2, 3""",
    "series_names": """
  SELECT pollutant_group, aqsid, min(site_name) AS site_name, min(county_name) AS county_name FROM hourly
  WHERE pollutant_group <> 'NOx_Family' OR parameter_code = 42602 GROUP BY 1, 2""",
    "rolled": """
  SELECT *, CASE WHEN count(value) OVER w >= 6 THEN avg(value) OVER w END AS mean_8h FROM series
  WINDOW w AS (PARTITION BY pollutant_group, aqsid ORDER BY datetime ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""",
    "rolled_years": " SELECT *, CAST(year(datetime) AS INTEGER) AS year FROM rolled",
    "days": _days(18),
    "days_any": _days(1),
    "metric_rows": _METRIC_ROWS.format(days="days"),
    "metric_rows_any": _METRIC_ROWS.format(days="days_any"),
    "values_default": _values("metric_rows"),
    "dv": _values("metric_rows_any"),
    "daily_default": _daily("0.75"),
    "daily": _daily("CAST(1.0 AS DOUBLE) / 24.0"),
    "monthly_default": _monthly("daily_default"),
    "monthly": _monthly("daily"),
    "weather_hours": """
  SELECT priority, h, max(x) AS x FROM (
    SELECT o_orderpriority AS priority, o_orderdate + to_hours(CAST((o_orderkey * 5) % 24 AS INTEGER)) AS h, o_totalprice / 1000.0 AS x FROM orders
    UNION ALL
    SELECT CASE event_type WHEN 'view' THEN '1-URGENT' WHEN 'click' THEN '2-HIGH' WHEN 'purchase' THEN '3-MEDIUM'
           WHEN 'signup' THEN '4-NOT SPECIFIED' ELSE '5-LOW' END, date_trunc('hour', ts), value FROM events) GROUP BY 1, 2""",
    "raw_weather": """
  SELECT CAST(epoch(h) AS BIGINT) AS dt, strftime(h, '%Y-%m-%d %H:%M:%S') AS datetime_local, strftime(h, '%Y-%m-%d %H:%M') AS date_local,
         CAST(year(h) AS INTEGER) AS year, CAST(month(h) AS INTEGER) AS month, CAST(hour(h) AS INTEGER) AS hour_local,
         ' ' || place || ' ' || replace(priority, '-', '/') || ' ' AS site_name, upper(place) AS county_name,
         CASE WHEN x >= 20.0 THEN CAST(26.013 AS DOUBLE) + number * CAST(0.817 AS DOUBLE) END AS lat,
         CASE WHEN x >= 20.0 THEN CAST(-97.021 AS DOUBLE) - number * CAST(0.533 AS DOUBLE) END AS lon,
         x / 20.0 + 278.15 AS temp, x / 20.0 + 4.0 AS feels_like, x / 25.0 + 270.15 AS dew_point,
         least(x / 5.0 + 20.0, 100.0) AS humidity, x / 10.0 + 990.0 AS pressure, least(x / 4.0, 100.0) AS clouds_all,
         10000.0 - x * 10.0 AS visibility, wind_speed, wind_deg, x / 30.0 AS wind_gust,
         -wind_speed * sin(radians(wind_deg)) AS wind_u, -wind_speed * cos(radians(wind_deg)) AS wind_v,
         CASE WHEN x >= 60.0 THEN x / 100.0 END AS rain_1h, CASE WHEN x >= 100.0 THEN x / 10.0 END AS heat_index_c,
         x * 2.0 AS ghi_cloudy_sky, CASE WHEN x >= 20.0 THEN x * 2.5 END AS ghi_clear_sky
  FROM (SELECT *, CAST(substr(priority, 1, 1) AS INTEGER) AS number, x / 40.0 AS wind_speed,
               CASE WHEN x >= 10.0 THEN (x * CAST(7.2 AS DOUBLE)) % CAST(360 AS DOUBLE) END AS wind_deg,
               (['Bexar', 'Atascosa', 'Cameron', 'Comal', 'Kleberg'])[CAST(substr(priority, 1, 1) AS INTEGER)] AS place
        FROM weather_hours)""",
    "weather": """
  SELECT * EXCLUDE (site_name), trim(regexp_replace(site_name, '[\\\\/:*?"<>|]', '_', 'g')) AS location, hour_local AS hour,
         CASE WHEN (SELECT avg(temp) FROM raw_weather) < 60 THEN temp ELSE temp - 273.15 END AS temp_c,
         CASE WHEN (SELECT avg(feels_like) FROM raw_weather) < 60 THEN feels_like ELSE feels_like - 273.15 END AS feels_like_c,
         CASE WHEN (SELECT avg(dew_point) FROM raw_weather) < 60 THEN dew_point ELSE dew_point - 273.15 END AS dew_point_c
  FROM raw_weather WHERE year IS NOT NULL""",
    "weather_daily": """
  SELECT location AS weather_station, substr(date_local, 1, 10) AS date_local,
         avg(temp_c) AS temp_c, min(temp_c) AS temp_c_min, max(temp_c) AS temp_c_max, avg(feels_like_c) AS feels_like_c,
         avg(dew_point_c) AS dew_point_c, avg(humidity) AS humidity, min(humidity) AS humidity_min, max(humidity) AS humidity_max,
         avg(pressure) AS pressure, avg(wind_speed) AS wind_speed, max(wind_speed) AS wind_speed_max, avg(wind_u) AS wind_u,
         avg(wind_v) AS wind_v, max(wind_gust) AS wind_gust_max, avg(clouds_all) AS clouds_all, avg(visibility) AS visibility,
         coalesce(sum(rain_1h), 0.0) AS rain_1h_sum, coalesce(sum(ghi_cloudy_sky), 0.0) AS ghi_cloudy_sky_sum,
         coalesce(sum(ghi_clear_sky), 0.0) AS ghi_clear_sky_sum, max(heat_index_c) AS heat_index_c_max
  FROM weather GROUP BY 1, 2""",
    "coords_1": f"""
  SELECT {site('s_suppkey')} AS aqsid, (s_suppkey * 37 % 500) / 100.0 + CAST(25.013 AS DOUBLE) AS lat,
         (s_suppkey * 91 % 400) / 100.0 - CAST(100.017 AS DOUBLE) AS lon FROM supplier WHERE s_acctbal >= 6000""",
    "coords_2": f"""
  SELECT {site('s_suppkey')} AS aqsid, (s_suppkey * 37 % 500) / 100.0 + CAST(25.013 AS DOUBLE) + 0.5 AS lat,
         CASE WHEN s_nationkey <> 3 THEN (s_suppkey * 91 % 400) / 100.0 - CAST(100.017 AS DOUBLE) + 0.5 END AS lon
  FROM supplier WHERE s_acctbal BETWEEN 0 AND 7000""",
    "coords": """
  SELECT aqsid, lat, lon FROM coords_1
  UNION ALL SELECT aqsid, lat, lon FROM coords_2 WHERE aqsid NOT IN (SELECT aqsid FROM coords_1)""",
    "stations": """
  SELECT location, lat, lon FROM (
    SELECT location, lat, lon, row_number() OVER (PARTITION BY location ORDER BY dt) AS rn FROM weather
    WHERE lat IS NOT NULL AND lon IS NOT NULL) WHERE rn = 1""",
    "sites": """
  SELECT d.*, c.lat, c.lon FROM (SELECT aqsid, min(site_name) AS site_name, min(county_name) AS county_name FROM daily GROUP BY aqsid) d
  LEFT JOIN coords c USING (aqsid)""",
    "pairing": f"""
  SELECT aqsid, site_name, county_name, weather_station, distance_km FROM (
    SELECT s.aqsid, s.site_name, s.county_name, t.location AS weather_station, {km('s.lat', 's.lon', 't.lat', 't.lon')} AS distance_km,
           row_number() OVER (PARTITION BY s.aqsid ORDER BY round({km('s.lat', 's.lon', 't.lat', 't.lon')}, 9), t.location) AS rn
    FROM sites s CROSS JOIN stations t WHERE s.lat IS NOT NULL AND s.lon IS NOT NULL) WHERE rn = 1
  UNION ALL
  SELECT s.aqsid, s.site_name, s.county_name,
         (SELECT min(t.location) FROM stations t WHERE contains(lower(t.location), lower(s.county_name))), NULL
  FROM sites s WHERE s.lat IS NULL OR s.lon IS NULL""",
    "combined": """
  SELECT d.*, p.weather_station, p.distance_km, w.* EXCLUDE (weather_station, date_local)
  FROM daily d JOIN pairing p ON p.aqsid = d.aqsid AND p.weather_station IS NOT NULL
  LEFT JOIN weather_daily w ON w.weather_station = p.weather_station AND w.date_local = d.date_local""",
    "hourly_weather": """
  SELECT h.aqsid, h.pollutant_group, h.date_local, h.datetime, h.sample_measurement, p.weather_station,
         w.temp_c, w.humidity, w.wind_speed, w.wind_deg, w.wind_u, w.wind_v
  FROM hourly h JOIN pairing p ON p.aqsid = h.aqsid
  JOIN weather w ON w.location = p.weather_station AND CAST(w.datetime_local AS TIMESTAMP) = h.datetime""",
    "active": """
  SELECT aqsid, state_code, county_code, site_number, min(site_name) AS site_name,
         min(upper(substr(county_name, 1, 1)) || lower(substr(county_name, 2))) AS county_name,
         CASE WHEN count(DISTINCT data_source) > 1 THEN 'BOTH' ELSE coalesce(min(data_source), '') END AS network,
         array_to_string(list_sort(list(DISTINCT pollutant_group)), ';') AS pollutants,
         CAST(count(DISTINCT pollutant_group) AS INTEGER) AS n_pollutants,
         min(date_local) AS first_date, max(date_local) AS last_date, count(*) AS n_records
  FROM raw GROUP BY 1, 2, 3, 4""",
    "registry": f"""
  SELECT s.*, c.lat, c.lon FROM (
    SELECT aqsid, state_code, county_code, site_number, site_name, county_name, network, pollutants, n_pollutants,
           first_date, last_date, n_records, 'active' AS data_status, '' AS co_located_with, '' AS notes FROM active
    UNION ALL
    SELECT aqsid, 48, county_code, site_number, site_name, county_name, 'TCEQ', pollutants, 0, NULL, NULL, 0, data_status, '', notes
    FROM (VALUES {_static_rows()}) v(aqsid, county_code, site_number, site_name, county_name, pollutants, data_status, notes)
    WHERE data_status <> 'excluded' OR aqsid NOT IN (SELECT aqsid FROM active)) s LEFT JOIN coords c USING (aqsid)""",
    "series_all": """
  SELECT pollutant_group, aqsid, datetime, avg(sample_measurement) AS value FROM hourly
  WHERE pollutant_group <> 'NOx_Family' OR parameter_code = 42602 GROUP BY 1, 2, 3""",
    "rolled_all": """
  SELECT *, CASE WHEN count(value) OVER w >= 6 THEN avg(value) OVER w END AS mean_8h FROM series_all
  WINDOW w AS (PARTITION BY pollutant_group, aqsid ORDER BY datetime ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""",
    "coords_1_all": f"""
  SELECT {site('s_suppkey')} AS aqsid, (s_suppkey * 37 % 500) / 100.0 + CAST(25.013 AS DOUBLE) AS lat,
         (s_suppkey * 91 % 400) / 100.0 - CAST(100.017 AS DOUBLE) AS lon FROM supplier""",
    "coords_2_all": f"""
  SELECT {site('s_suppkey')} AS aqsid, (s_suppkey * 37 % 500) / 100.0 + CAST(25.013 AS DOUBLE) + 0.5 AS lat,
         CASE WHEN s_nationkey <> 3 THEN (s_suppkey * 91 % 400) / 100.0 - CAST(100.017 AS DOUBLE) + 0.5 END AS lon
  FROM supplier""",
}


def _needed(text):
    """Names of common table expressions a statement refers to, in definition order."""
    found, queue = set(), [text]
    while queue:
        words = set(re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", queue.pop())))
        for name in words & set(CTES) - found:
            found.add(name)
            queue.append(CTES[name])
    return [n for n in CTES if n in found]


def with_ctes(select):
    """The statement with the common table expressions it needs."""
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in _needed(select))
    return f"WITH {parts}\n{select}" if parts else select
