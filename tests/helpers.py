"""Small fixtures: measurement rows with sensible defaults."""

import datetime as dt

from plumeworks.constants import MEASUREMENT_SCHEMA

DEFAULTS = {
    "state_code": 48, "county_code": 29, "site_number": 52, "parameter_code": 44201, "poc": 1,
    "date_local": "2023-07-01", "time_local": "13:00", "sample_measurement": 0.061, "method_code": 47,
    "county_name": "BEXAR", "pollutant_name": "Ozone", "aqsid": "480290052", "data_source": "EPA",
    "pollutant_group": "Ozone", "site_name": "Camp Bullis_0052",
}


def raw(spark, *rows):
    full = [{**DEFAULTS, **r} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in DEFAULTS) for r in full], MEASUREMENT_SCHEMA)


def hours(spark, start, values, aqsid="A", group="Ozone", parameter=44201, step=1):
    """Consecutive hourly rows as the hourly store has them; ``values`` may hold None."""
    begin = dt.datetime.fromisoformat(start)
    rows = [
        (aqsid, group, parameter, begin + dt.timedelta(hours=i * step), v, f"Site {aqsid}", "Bexar")
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows,
        "aqsid string, pollutant_group string, parameter_code int, datetime timestamp_ntz, "
        "sample_measurement double, site_name string, county_name string",
    )


def table(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]
