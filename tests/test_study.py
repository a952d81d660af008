import csv
import datetime as dt
import os

import pytest

from helpers import DEFAULTS
from plumeworks import constants as C
from plumeworks.operators import report
from plumeworks.plans.study import build_study


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows([["" if v is None else v for v in r] for r in rows])


@pytest.fixture
def inputs(folder):
    def rows(group, parameter, value, days=3, **over):
        for d in range(days):
            for h in range(24):
                row = {**DEFAULTS, "pollutant_group": group, "parameter_code": parameter, "pollutant_name": group,
                       "date_local": f"2023-07-0{d + 1}", "time_local": f"{h:02d}:00", "sample_measurement": value(d, h), **over}
                yield list(row.values())
    ozone = list(rows("Ozone", 44201, lambda d, h: 0.05 + d / 100))
    ozone += list(rows("Ozone", 44201, lambda d, h: 60.0, data_source="TCEQ", aqsid="480290059", site_name="gone"))
    write_csv(f"{folder}/raw/Ozone_AllCounties_2015_2025.csv", DEFAULTS, ozone + ozone[:5])
    write_csv(f"{folder}/raw/PM2.5_AllCounties_2015_2025.csv", DEFAULTS,
              rows("PM2.5", 88101, lambda d, h: 10.0, aqsid="483550025", county_name="NUECES", site_name="CC"))
    names = C.WEATHER_SCHEMA.fieldNames()
    wx = []
    for station, lat, lon in (("Bexar North", 29.5, -98.5), ("Nueces/Bay", 27.8, -97.4)):
        for h in range(48):
            ts = dt.datetime(2023, 7, 1) + dt.timedelta(hours=h)
            row = dict.fromkeys(names)
            row.update(dt=int(ts.timestamp()), datetime_local=str(ts), date_local=str(ts)[:10], year=2023, month=7,
                       hour_local=ts.hour, site_name=station, lat=lat, lon=lon, temp=27.0, humidity=50.0)
            wx.append([row[n] for n in names])
    write_csv(f"{folder}/weather.csv", names, wx)
    return folder


def build(spark, folder, expected=None):
    coords = [spark.createDataFrame([("480290052", 29.6, -98.6)], "aqsid string, lat double, lon double")]
    return build_study(spark, f"{folder}/raw", f"{folder}/weather.csv", coords, f"{folder}/out", expected)


def test_from_files_to_tables_twice(spark, inputs):
    for _ in range(2):
        tables = build(spark, inputs)
        assert tables["pollutant_hourly"].count() == 144
    values = {r["metric"]: round(r["value"], 6) for r in tables["naaqs_design_values"].collect()}
    assert values == {"pm25_annual_mean": 10.0, "pm25_24hr_p98": 10.0}  # three days give no fourth highest
    combined = {(r["aqsid"], r["date_local"]): r for r in tables["aq_weather_daily"].collect()}
    assert combined[("480290052", "2023-07-01")]["weather_station"] == "Bexar North"
    assert round(combined[("480290052", "2023-07-01")]["temp_c"], 6) == 27.0
    assert combined[("483550025", "2023-07-02")]["weather_station"] == "Nueces_Bay"
    assert combined[("483550025", "2023-07-03")]["temp_c"] is None
    assert len(combined) == 6
    row = spark.sql("SELECT county_name, ROUND(AVG(mean), 3) AS m FROM pollutant_daily WHERE valid_day "
                    "AND pollutant_group = 'Ozone' GROUP BY county_name").first()
    assert tuple(row) == ("Bexar", 0.06)
    assert tables["site_registry"].where("data_status = 'active'").count() == 3
    assert sorted(os.listdir(f"{inputs}/out/csv")) == sorted(C.EXPORT_NAMES)


def test_the_build_counts_what_it_writes_and_scans_no_input_for_it(spark, inputs):
    tables = build(spark, inputs)
    found = {r["name"]: tuple(r)[1:] for r in tables["build_report"].collect()}
    assert found == {
        "Ozone": (149, 72, 72, 1, "2023", True), "PM2.5": (72, 72, 72, 1, "2023", True), "weather": (96, 96, 96, 2, "2023", True)}
    # no source file is read for the report: its plan knows the stores and the daily table only
    stores = {"hourly": tables["pollutant_hourly"], "daily": tables["pollutant_daily"]}
    again = report.build_report(stores["hourly"], "pollutant_group", {None: 1, "Ozone": 149}, {None: 1, "Ozone": 71}, stores["daily"], "aqsid")
    assert again.first()["complete"] is False
    plan = again._jdf.queryExecution().toString()
    assert ".csv" not in plan and f"{inputs}/raw" not in plan


def test_failed_checks_stop_the_build(spark, inputs):
    expected = {"rows": {"Ozone": 10_000, "PM2.5": 72}, "sites": 3, "counties": 2, "groups": 2, "weather_rows": 96,
                "stations": 2}
    with pytest.raises(ValueError):
        build(spark, inputs, expected)
    assert not os.path.exists(f"{inputs}/out/parquet")
    good = {**expected, "rows": {"Ozone": 149, "PM2.5": 72}}
    assert build(spark, inputs, good)["pollutant_hourly"].count() == 144
