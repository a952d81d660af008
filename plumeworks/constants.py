"""Schemas and domain tables.

Everything below is a fixed value: these codes, names, thresholds and column
lists define the data model, so results are only right when they are exact.
"""

from pyspark.sql import types as T

# --- fixed values: measurement schema ---------------------------------------
MEASUREMENT_SCHEMA = T.StructType(
    [
        T.StructField("state_code", T.IntegerType()),
        T.StructField("county_code", T.IntegerType()),
        T.StructField("site_number", T.IntegerType()),
        T.StructField("parameter_code", T.IntegerType()),
        T.StructField("poc", T.IntegerType()),
        T.StructField("date_local", T.StringType()),
        T.StructField("time_local", T.StringType()),
        T.StructField("sample_measurement", T.DoubleType()),
        T.StructField("method_code", T.IntegerType()),
        T.StructField("county_name", T.StringType()),
        T.StructField("pollutant_name", T.StringType()),
        T.StructField("aqsid", T.StringType()),
        T.StructField("data_source", T.StringType()),
        T.StructField("pollutant_group", T.StringType()),
        T.StructField("site_name", T.StringType()),
    ]
)
MEASUREMENT_COLUMNS = MEASUREMENT_SCHEMA.fieldNames()

# --- fixed values: weather master schema ------------------------------------
WEATHER_SCHEMA = T.StructType(
    [
        T.StructField("dt", T.LongType()),
        T.StructField("datetime_local", T.StringType()),
        T.StructField("datetime_utc", T.StringType()),
        T.StructField("date_local", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("hour_local", T.IntegerType()),
        T.StructField("site_name", T.StringType()),
        T.StructField("county_name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("temp", T.DoubleType()),
        T.StructField("temp_f", T.DoubleType()),
        T.StructField("feels_like", T.DoubleType()),
        T.StructField("dew_point", T.DoubleType()),
        T.StructField("td_spread", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("clouds_all", T.DoubleType()),
        T.StructField("visibility", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("wind_deg", T.DoubleType()),
        T.StructField("wind_gust", T.DoubleType()),
        T.StructField("wind_u", T.DoubleType()),
        T.StructField("wind_v", T.DoubleType()),
        T.StructField("rain_1h", T.DoubleType()),
        T.StructField("snow_1h", T.DoubleType()),
        T.StructField("is_raining", T.BooleanType()),
        T.StructField("heat_index_c", T.DoubleType()),
        T.StructField("ghi_cloudy_sky", T.DoubleType()),
        T.StructField("ghi_clear_sky", T.DoubleType()),
        T.StructField("dni_cloudy_sky", T.DoubleType()),
        T.StructField("dhi_cloudy_sky", T.DoubleType()),
    ]
)
WEATHER_OTHER_COLUMNS = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("station", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("temp_c", T.DoubleType()),
        T.StructField("feels_like_c", T.DoubleType()),
        T.StructField("dew_point_c", T.DoubleType()),
    ]
)
STATION_COLUMN_CANDIDATES = ("location", "site_name", "station", "station_name")

# --- fixed values: site coordinate files ------------------------------------
SITE_REFERENCE_SCHEMA = "aqsid string, latitude double, longitude double"

# --- fixed values: raw-data transaction file, 28 pipe-separated fields ------
TRANSACTION_FIELDS = [
    "ttype", "action", "state", "county", "site", "param", "poc", "dur", "unit", "meth", "date", "time",
    "value", "null_cd", "freq", "proto", "q1", "q2", "q3", "q4", "q5", "q6", "q7", "q8", "q9", "q10", "mdl",
    "unc",
]

# --- fixed values: file name patterns ---------------------------------------
MEASUREMENT_FILE_GLOB = "*_AllCounties_*.csv"
PARQUET_GLOB = "*.parquet"

# --- fixed values: seasons by month -----------------------------------------
SEASONS = {"DJF": (12, 1, 2), "MAM": (3, 4, 5), "JJA": (6, 7, 8), "SON": (9, 10, 11)}

# --- fixed values: unit conversions (parameter_code, data_source, factor) ---
UNIT_CONVERSIONS = [(44201, "TCEQ", 0.001)]

# --- fixed values: rows outside the study (AND of column = value) -----------
OUT_OF_SCOPE_RULES = [{"aqsid": "480290059", "data_source": "TCEQ"}]

# --- fixed values: parameter code, pollutant name, pollutant group ----------
PARAMETERS = [
    (42101, "CO", "CO"),
    (42401, "SO2", "SO2"),
    (42601, "NO", "NOx_Family"),
    (42602, "NO2", "NOx_Family"),
    (42603, "NOx", "NOx_Family"),
    (44201, "Ozone", "Ozone"),
    (81102, "PM10", "PM10"),
    (85101, "PM10", "PM10"),
    (88101, "PM2.5", "PM2.5"),
    (88500, "PM2.5", "PM2.5"),
    (88502, "PM2.5", "PM2.5"),
]
NO2_PARAMETER = 42602
POLLUTANT_GROUPS = ("CO", "NOx_Family", "Ozone", "PM10", "PM2.5", "SO2", "VOCs")
REFRESH_GROUPS = ("CO", "NOx_Family", "Ozone", "PM10", "PM2.5", "SO2")

# --- fixed values: county code, county name ---------------------------------
COUNTIES = [
    (13, "Atascosa"),
    (29, "Bexar"),
    (61, "Cameron"),
    (91, "Comal"),
    (187, "Guadalupe"),
    (215, "Hidalgo"),
    (255, "Karnes"),
    (273, "Kleberg"),
    (323, "Maverick"),
    (355, "Nueces"),
    (469, "Victoria"),
    (479, "Webb"),
    (493, "Wilson"),
]

# --- fixed values: site id, canonical site name -----------------------------
SITE_NAMES = [
    ("480131090", "Pleasanton_1090"),
    ("480290032", "San Antonio Northwest_0032"),
    ("480290052", "Camp Bullis_0052"),
    ("480290053", "Live Oak_0053"),
    ("480290055", "CPS Pecan Valley_0055"),
    ("480290059", "Calaveras Lake_0059"),
    ("480290060", "San Antonio Palo Alto_0060"),
    ("480290501", "Elm Creek Elementary_0501"),
    ("480290502", "Fair Oaks Ranch_0502"),
    ("480290677", "San Antonio Old Hwy 90_0677"),
    ("480291069", "Converse_1069"),
    ("480291080", "Heritage MS SO2_1080"),
    ("480291087", "Windcrest_1087"),
    ("480291097", "Von Ormy_1097"),
    ("480291610", "Government Canyon_1610"),
    ("480610006", "Brownsville_0006"),
    ("480611023", "Harlingen_1023"),
    ("480611098", "Brownsville Roca_1098"),
    ("480612004", "Port Isabel_2004"),
    ("480910503", "Bulverde Elementary_0503"),
    ("480910505", "City of Garden Ridge_0505"),
    ("481870504", "New Braunfels Airport_0504"),
    ("481870506", "Seguin Outdoor Learning Center_0506"),
    ("482150043", "Mission_0043"),
    ("482151046", "Edinburg_1046"),
    ("482551070", "Karnes City_1070"),
    ("482730314", "Kingsville_0314"),
    ("483230004", "Eagle Pass_0004"),
    ("483550025", "Corpus Christi West_0025"),
    ("483550026", "Corpus Christi Tuloso_0026"),
    ("483550032", "Corpus Christi Dona Park_0032"),
    ("483550034", "Corpus Christi Holly_0034"),
    ("484690003", "Victoria_0003"),
    ("484790016", "Laredo Vidaurri_0016"),
    ("484790017", "Laredo Santa Maria_0017"),
    ("484790313", "Laredo Hachar_0313"),
    ("484931038", "Floresville_1038"),
]

# --- fixed values: retired sensors (site id, pollutant group or name) -------
DEAD_SENSORS = [
    ("480290053", "PM10"),
    ("480291080", "SO2"),
    ("480610006", "Ozone"),
    ("480610006", "PM2.5"),
    ("482151046", "PM10"),
    ("484790017", "CO"),
]

# --- fixed values: keys that identify a measurement -------------------------
APPEND_KEY = ["aqsid", "date_local", "time_local", "parameter_code", "poc", "data_source"]
INSERT_KEY = ["aqsid", "datetime", "parameter_code", "poc"]
DUPLICATE_HOUR_KEY = ["aqsid", "date_local", "time_local", "parameter_code", "poc"]

# --- fixed values: completeness thresholds ----------------------------------
MIN_HOURS_8H = 6
MIN_HOURS_DAY = 18
HOURLY_COMPLETENESS = 0.75
PM10_DAILY_LEVEL = 150.0

# --- fixed values: daily weather roll-up (column, aggregates) ---------------
DAILY_WEATHER_AGGS = {
    "temp_c": ("mean", "min", "max"),
    "feels_like_c": ("mean",),
    "dew_point_c": ("mean",),
    "humidity": ("mean", "min", "max"),
    "pressure": ("mean",),
    "wind_speed": ("mean", "max"),
    "wind_u": ("mean",),
    "wind_v": ("mean",),
    "wind_gust": ("max",),
    "clouds_all": ("mean",),
    "visibility": ("mean",),
    "rain_1h": ("sum",),
    "ghi_cloudy_sky": ("sum",),
    "ghi_clear_sky": ("sum",),
    "heat_index_c": ("max",),
}

# --- fixed values: Earth radius in km, Kelvin offset and Celsius test -------
EARTH_RADIUS_KM = 6371.0088
KELVIN_OFFSET = 273.15
CELSIUS_MEAN_LIMIT = 60.0

# --- fixed values: registry columns and rows without measurements -----------
REGISTRY_COLUMNS = [
    "aqsid", "state_code", "county_code", "site_number", "site_name", "county_name", "network", "pollutants",
    "n_pollutants", "first_date", "last_date", "n_records", "data_status", "co_located_with", "notes", "lat",
    "lon",
]
# aqsid, county_code, site_number, site_name, county_name, pollutants, data_status, notes
STATIC_REGISTRY_ROWS = [
    ("480290623", 29, 623, "Gardner Rd. Gas SubStation", "Bexar", "", "reference",
     "CPS Energy fence-line monitor; registered in inventory, no measurement data"),
    ("480290625", 29, 625, "Gate 9A CPS", "Bexar", "", "reference",
     "CPS Energy fence-line monitor; registered in inventory, no measurement data"),
    ("480290626", 29, 626, "Gate 58 CPS", "Bexar", "", "reference",
     "CPS Energy fence-line monitor; registered in inventory, no measurement data"),
    ("480291609", 29, 1609, "Calaveras Lake Park", "Bexar", "TSP", "excluded",
     "TSP only — outside project scope (PM2.5/PM10/O3/CO/NOx/SO2/VOCs)"),
    ("483551024", 355, 1024, "Williams Park", "Nueces", "", "disabled",
     "Disabled per 06_HTML_Reports/10_Site_Inventory_Report.html"),
]

# --- fixed values: wind sectors (upper bound in degrees, label) -------------
WIND_SECTORS = [
    (22.5, "N"), (67.5, "NE"), (112.5, "E"), (157.5, "SE"),
    (202.5, "S"), (247.5, "SW"), (292.5, "W"), (337.5, "NW"),
]

# --- fixed values: data-quality expectations --------------------------------
DATE_WINDOW = ("2015-01-01", "2026-12-31")
REQUIRED_METRICS = (
    "ozone_8hr_4th_max", "pm25_annual_mean", "pm25_24hr_p98", "so2_1hr_p99", "no2_1hr_p98",
)
EXPORT_NAMES = (
    "daily_pollutant_means", "naaqs_design_values", "combined_aq_weather_daily", "site_registry",
)
