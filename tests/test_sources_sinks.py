import json
import os

import pytest
from helpers import DEFAULTS, raw, table
from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.functions.filters import predicate
from plumeworks.operators import clean, quality, refresh, weather
from plumeworks.sources import keys, readers, writers


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


HEADER = ",".join(DEFAULTS)


def test_measurement_csv_keeps_text_and_types(spark, folder):
    row = "48,29,52,44201,1,2023-07-01,07:00,0.061,,BEXAR,Ozone,040290052,EPA,Ozone,0032"
    df = readers.measurement_csv(spark, write(f"{folder}/m.csv", f"{HEADER}\n{row}\n"))
    got = df.first()
    assert df.schema == C.MEASUREMENT_SCHEMA
    assert (got["aqsid"], got["site_name"], got["time_local"], got["method_code"]) == ("040290052", "0032", "07:00", None)


def test_folder_discovery_ignores_other_files(spark, folder):
    row = "48,29,52,44201,1,2023-07-01,07:00,0.061,,BEXAR,Ozone,480290052,EPA,Ozone,x"
    write(f"{folder}/CO_AllCounties_2015_2025.csv", f"{HEADER}\n{row}\n{row}\n")
    write(f"{folder}/Ozone_AllCounties_2015_2025.csv", f"{HEADER}\n{row}\n")
    write(f"{folder}/notes.csv", "hello\n")
    counts = readers.measurement_folder(spark, folder).groupBy("source_file").count()
    assert table(counts, "source_file") == [
        ("CO_AllCounties_2015_2025.csv", 2), ("Ozone_AllCounties_2015_2025.csv", 1),
    ]


def test_files_of_any_column_order_are_read_by_name(spark, folder):
    names = list(DEFAULTS)
    swapped = [*reversed(names), "surplus"]
    row = dict(DEFAULTS, poc="47.0", method_code="XX", site_name="a, b")
    write(f"{folder}/CO_AllCounties_1.csv", ",".join(swapped) + "\n" + ",".join(f'"{row.get(n, 1)}"' for n in swapped) + "\n")
    short = [n for n in names if n != "site_name"]
    write(f"{folder}/PM2.5_AllCounties_2 b.csv", "\ufeff" + ",".join(short) + "\n" + ",".join(str(DEFAULTS[n]) for n in short) + "\n")
    write(f"{folder}/SO2_AllCounties_3.csv", "")
    rows = {r["source_file"]: r for r in readers.measurement_folder(spark, folder).collect()}
    one, two = rows["CO_AllCounties_1.csv"], rows["PM2.5_AllCounties_2 b.csv"]
    assert len(rows) == 2
    assert (one["poc"], one["method_code"], one["site_name"], one["aqsid"]) == (47, None, "a, b", DEFAULTS["aqsid"])
    assert (two["site_name"], two["state_code"], two["aqsid"]) == (None, DEFAULTS["state_code"], DEFAULTS["aqsid"])
    found = readers.headers(spark, f"{folder}/*_AllCounties_1.csv")
    got = {r["name"]: (r["passed"], r["detail"]) for r in quality.check_headers(spark, found).collect()}
    assert got == {"schema:CO_AllCounties_1.csv": (False, "extra=['surplus']")}


def test_weather_layouts(spark, folder):
    path = write(f"{folder}/w.csv", "humidity,location,note,temp,datetime_local\n50,Bay,x,300.15,2023-07-01 05:00:00\n")
    df = readers.weather_csv(spark, path)
    assert set(df.columns) == {"humidity", "location", "note", "temp", "datetime_local"}
    got = weather.build_weather(df).first()
    assert (got["location"], got["hour"], got["year"], round(got["temp_c"], 6)) == ("Bay", 5, 2023, 27.0)


def test_filters(spark):
    df = raw(spark, {"poc": 1}, {"poc": 2}, {"poc": 3, "aqsid": "B"})
    def n(*filters):
        return df.where(predicate(filters)).count()
    assert (n(), n(("poc", "=", 1)), n(("poc", "==", 1)), n(("poc", "!=", 1)), n(("poc", ">", 1))) == (3, 1, 1, 2, 2)
    assert (n(("poc", ">=", 2)), n(("poc", "<", 2)), n(("poc", "<=", 2)), n(("poc", "in", [1, 3]))) == (2, 1, 2, 2)
    assert n(("poc", ">", 1), ("aqsid", "=", "B")) == 1
    with pytest.raises(ValueError):
        predicate([("poc", "~", 1)])


@pytest.fixture
def store(spark, folder):
    rows = raw(
        spark, {}, {"date_local": "2022-05-01"}, {"pollutant_group": "CO", "parameter_code": 42101},
        {"aqsid": "480290059", "sample_measurement": 0.05},
    )
    path = f"{folder}/hourly"
    writers.write_partitioned(clean.clean_measurements(rows), path, ["pollutant_group", "year"])
    write(f"{path}/desktop.ini", "junk")
    return path


def test_scan_prunes_partitions_and_columns(spark, store):
    df = readers.parquet_dataset(
        spark, store, ["aqsid", "sample_measurement"], [("pollutant_group", "=", "Ozone"), ("year", "=", 2023),
                                                        ("aqsid", "in", ["480290059", "480290052"])],
    )
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "pollutant_group" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "PushedFilters: [In(aqsid" in plan or "In(aqsid" in plan.split("PushedFilters:")[1]
    assert "site_name" not in plan.split("ReadSchema:")[1]


def test_partition_overwrite_is_idempotent_and_local(spark, store):
    before = table(readers.parquet_dataset(spark, store).groupBy("pollutant_group", "year").count(), "pollutant_group", "year")
    rows = raw(spark, {}, {"aqsid": "480290059", "sample_measurement": 0.05})
    for _ in range(2):
        writers.write_partitioned(clean.clean_measurements(rows), store, ["pollutant_group", "year"])
    after = table(readers.parquet_dataset(spark, store).groupBy("pollutant_group", "year").count(), "pollutant_group", "year")
    assert after == before


def bronze(spark, *rows):
    return raw(spark, *rows).withColumn("year", F.substring("date_local", 1, 4).cast("int"))


def test_append_adds_only_new_keys(spark, folder):
    path = f"{folder}/bronze"
    writers.write_partitioned(bronze(spark, {}, {"poc": None}), path, ["pollutant_group", "year"])
    delta = bronze(
        spark,
        {"sample_measurement": 9.0},            # known key, other value
        {"poc": None, "sample_measurement": 8.0},  # known key with a null
        {"time_local": "14:00"}, {"time_local": "14:00", "sample_measurement": 0.01},  # one new key twice
        {"data_source": "TCEQ"},                # new by source
        {"pollutant_group": "CO"},              # new group folder
        {"pollutant_group": "VOCs"},            # not a refresh group
    )
    report = {r[0]: (r[1], r[2]) for r in writers.append_delta(spark, delta, path).collect()}
    assert report["Ozone"] == (2, 2) and report["CO"] == (0, 1) and report["PM10"] == (0, 0)
    stored = spark.read.parquet(path)
    assert stored.count() == 5 and stored.where("sample_measurement > 1").count() == 0
    assert stored.where("time_local = '14:00'").first()["sample_measurement"] == 0.01
    again = {r[0]: r[2] for r in writers.append_delta(spark, delta, path).collect()}
    assert sum(again.values()) == 0 and spark.read.parquet(path).count() == 5


def test_append_opens_only_files_that_may_hold_a_key(spark, folder):
    """Files are looked up by key; a file unknown to the index is added to it, one that is gone is passed over."""
    path, cols = f"{folder}/bronze", ["pollutant_group", "year"]
    for hour in ("01:00", "02:00", "03:00"):
        bronze(spark, {"time_local": hour}, {"time_local": hour, "poc": None}).coalesce(1).write.mode("append").partitionBy(*cols).parquet(path)
    bronze(spark, {"pollutant_group": "CO"}).coalesce(1).write.mode("append").partitionBy(*cols).parquet(path)

    def opened(*rows):
        return keys.files_with_keys(bronze(spark, *rows), path, C.APPEND_KEY, cols)

    assert len(opened({"time_local": "02:00", "poc": None})) == 1 and opened({"time_local": "09:00"}) == []
    assert len(opened({"time_local": "01:00"}, {"time_local": "03:00"}, {"time_local": "05:00"})) == 2
    indexed = spark.read.parquet(f"{path}/{keys.INDEX}")
    assert indexed.count() == 6  # the folder of the other group was never reached
    bronze(spark, {"time_local": "09:00"}).write.mode("append").partitionBy(*cols).parquet(path)
    assert len(opened({"time_local": "09:00"})) == 1
    writers.write_partitioned(bronze(spark, {"time_local": "07:00"}), path, cols)
    assert opened({"time_local": "02:00"}) == [] and len(opened({"time_local": "07:00"})) == 1
    assert readers.parquet_dataset(spark, path).count() == 2


def test_a_failed_append_is_repeated(spark, folder):
    """Some rows of a batch reach the store before it fails; the repeated batch adds the others once."""
    path, cols = f"{folder}/bronze", ["pollutant_group", "year"]
    writers.write_partitioned(bronze(spark, {}), path, cols)
    delta = bronze(spark, *[{"time_local": f"{h:02d}:00"} for h in range(6)])
    writers.append_delta(spark, delta.where("time_local = '00:00'"), path)
    delta.where("time_local < '03:00' AND time_local > '00:00'").write.mode("append").partitionBy(*cols).parquet(path)
    for want in (3, 0):
        assert {r[0]: r[2] for r in writers.append_delta(spark, delta, path).collect()}["Ozone"] == want
    assert spark.read.parquet(path).count() == 7


def test_a_replacement_that_fails_leaves_the_old_table(spark, folder):
    rows = raw(spark, {}, {"poc": 2})
    writers.publish({"one": rows}, folder)
    bad = rows.withColumn("poc", F.when(F.col("poc") == 2, F.raise_error(F.lit("cut off"))).otherwise(F.col("poc")).cast("int"))
    with pytest.raises(Exception, match="cut off"):
        writers.publish({"one": bad}, folder)
    assert writers.published(spark, folder, "one").count() == 2 and spark.table("one").count() == 2
    writers.publish({"one": rows.limit(1)}, folder)
    assert writers.published(spark, folder, "one").count() == 1 and len(writers.versions(spark, folder, "one")) == 2
    assert writers.published(spark, folder, "none") is None


def test_insert_absent_derives_time_and_keeps_existing(spark, store):
    before = readers.parquet_dataset(spark, store).count()
    delta = raw(spark, {"data_source": "TCEQ"}, {"time_local": "15:00"}, {"time_local": "bad"})
    for _ in range(2):
        writers.insert_absent(spark, delta, store)
        assert readers.parquet_dataset(spark, store).count() == before + 1
    row = readers.parquet_dataset(spark, store).where("time_local = '15:00'").first()
    assert (row["hour"], row["season"], row["year"]) == (15, "JJA", 2023)


def test_append_reads_only_touched_partitions(spark, store):
    existing = readers.parquet_dataset(spark, store)
    delta = clean.derive_time(raw(spark, {}))
    df = writers.touched_partitions(existing, delta, ["pollutant_group", "year"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Ozone" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    files = [r[0] for r in df.select("_metadata.file_path").distinct().collect()]
    assert files and all("pollutant_group=Ozone/year=2023" in f for f in files)


def test_publish_reconcile_and_manifest(spark, folder):
    tables = {"one": raw(spark, {}, {}), "two": raw(spark, {})}
    writers.publish(tables, folder)
    assert spark.sql("SELECT COUNT(*) FILTER (WHERE poc = 1) FROM one").first()[0] == 2
    assert table(writers.reconcile(tables, folder), "table_name") == [("one", 2, 2, True), ("two", 1, 1, True)]
    writers.publish({"two": tables["two"]}, folder, mode="append")
    assert table(writers.reconcile({"two": tables["two"]}, folder), "table_name") == [("two", 1, 2, False)]
    assert table(writers.manifest(spark, folder, ["one", "gone"]), "table_name") == [("gone", False, 0), ("one", True, 2)]


def test_exports_and_dispatch(spark, folder):
    df = raw(spark, {"aqsid": "040290052"})
    writers.write_csv(df, f"{folder}/c")
    writers.write_table(df, f"{folder}/p")
    for path, kind in (("c", "csv"), ("p", "parquet"), ("p", "parquet_dir")):
        assert readers.load(spark, f"{folder}/{path}", kind).first()["aqsid"] == "040290052"
    with pytest.raises(ValueError):
        readers.load(spark, folder, "xlsx")


def test_site_reference(spark, folder):
    path = write(f"{folder}/s.csv", "aqsid,latitude,longitude\n040290052,29.5,-98.5\n")
    assert tuple(readers.site_reference(spark, path).first()) == ("040290052", 29.5, -98.5)
    other = write(f"{folder}/o.csv", "site_name,AQSID,longitude,aqsid,latitude\nX,Y,-98.5,040290052,29.5\n")
    assert tuple(readers.site_reference(spark, other).first()) == ("040290052", 29.5, -98.5)


def rd(**over):
    fields = dict.fromkeys(C.TRANSACTION_FIELDS, "")
    fields.update(ttype="RD", action="I", state="48", county="029", site="0055", param="44201", poc="1", meth="47",
                  date="20251113", time="7:00", value="41.5", unit="008", **over)
    return "|".join(fields.values())


def test_transactions(spark, folder):
    lines = ["# header", "Transaction Type|Action|State Cd", rd(), rd(q1="x") + "|surplus", rd().replace("RD", "RP", 1),
             rd().replace("0055", "9999")]
    path = write(f"{folder}/t.txt", "\n".join(lines) + "\n")
    out = refresh.from_transactions(readers.transactions(spark, path), "Ozone")
    assert out.columns == C.MEASUREMENT_COLUMNS
    got = {r["aqsid"]: r for r in out.collect()}
    row = got["480290055"]
    assert (row["date_local"], row["time_local"], row["sample_measurement"]) == ("2025-11-13", "07:00", 41.5)
    assert (row["site_name"], row["county_name"], row["pollutant_name"], row["data_source"]) == (
        "CPS Pecan Valley_0055", "Bexar", "Ozone", "TCEQ",
    )
    assert got["480299999"]["site_name"] == "UNKNOWN_480299999"
    assert [r[0] for r in refresh.unknown_sites(out).collect()] == ["480299999"]
    # The native unit survives the refresh; the store build converts it exactly once.
    assert [r[0] for r in clean.clean_measurements(out).select("sample_measurement").collect()] == pytest.approx([0.0415] * 2)


def api(**over):
    base = dict(state_code="48", county_code="029", site_number="0052", parameter_code="44201", poc=1,
                date_local="2025-11-01", time_local="00:00", sample_measurement=0.03, method_code="047")
    return {**base, **over}


def test_api_records(spark, folder):
    records = [
        api(), api(sample_measurement=None), api(method_code="n/a"), api(site_number="7777"),
        api(site_number="1080", parameter_code="42401"),  # retired sensor
        {k: v for k, v in api().items() if k != "poc"},
    ]
    path = write(f"{folder}/a.json", json.dumps(records))
    raw_rows = readers.api_records(spark, path, whole_documents=True)
    out = refresh.from_api(raw_rows)
    assert out.schema.names == C.MEASUREMENT_COLUMNS
    assert [f.dataType for f in out.schema] == [f.dataType for f in C.MEASUREMENT_SCHEMA]
    rows = out.collect()
    assert len(rows) == 4
    assert sorted(r["site_name"] for r in rows) == ["Bexar_7777"] + ["Camp Bullis_0052"] * 3
    assert sorted(str(r["method_code"]) for r in rows) == ["47", "47", "47", "None"]
    assert sum(r["poc"] is None for r in rows) == 1
    summary = {(r["county_code"], r["parameter_code"]): tuple(r)[2:] for r in refresh.pull_summary(raw_rows, out).collect()}
    assert summary == {(29, 44201): (5, 4, 2), (29, 42401): (1, 0, 0)}


def test_empty_api_response_keeps_the_schema(spark, folder):
    out = refresh.from_api(readers.api_records(spark, write(f"{folder}/e.json", "[]"), whole_documents=True))
    assert out.columns == C.MEASUREMENT_COLUMNS and out.count() == 0


def test_dead_sensors_match_group_or_name_and_keep_nulls(spark):
    df = raw(
        spark,
        {"aqsid": "484790017", "pollutant_group": "CO"}, {"aqsid": "484790017", "pollutant_name": "CO"},
        {"aqsid": "484790017"}, {"aqsid": None, "pollutant_group": "CO"}, {"aqsid": "484790017", "pollutant_group": None},
    )
    assert refresh.drop_dead_sensors(df).count() == 3


def test_no_data_is_committed():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for base, dirs, files in os.walk(root):
        dirs[:] = [d for d in dirs if not d.startswith((".", "__"))]
        assert not [f for f in files if f.endswith((".parquet", ".csv"))], base


def test_unreadable_values_are_reported_and_the_rest_is_kept(spark, folder):
    """Good, short, reordered and spoilt files in one read."""
    head = ",".join(C.MEASUREMENT_COLUMNS)
    good = ",".join(str(DEFAULTS[c]) for c in C.MEASUREMENT_COLUMNS)
    spoilt = ",".join({"poc": "1b", "sample_measurement": "n/a"}.get(c, str(DEFAULTS[c])) for c in C.MEASUREMENT_COLUMNS)
    files = {"a.csv": f"{head}\n{good}\n{spoilt}\n", "b.csv": "poc,aqsid\n2,7\n47.0,8\n4.5,9\n,\n", "c.csv": ""}
    for name, text in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    stored, rejects = readers.measurements_and_rejects(spark, folder)
    assert table(rejects, "file", "column") == [
        ("a.csv", "poc", "1b", "not int"), ("a.csv", "sample_measurement", "n/a", "not double"), ("b.csv", "poc", "4.5", "not int")]
    assert stored.columns == C.MEASUREMENT_COLUMNS and stored.count() == 6
    assert [tuple(r) for r in stored.where("aqsid IN ('7', '8', '9')").orderBy("aqsid").select("poc").collect()] == [(2,), (47,), (None,)]


def test_bad_transaction_fields_do_not_end_the_run(spark, folder):
    fields = {"ttype": "RD", "state": "48", "county": "029", "site": "0052", "param": "44201", "poc": "1", "meth": "047", "date": "20230701", "time": "7:00", "value": "0.5"}
    lines = [fields, {**fields, "value": "?"}, {**fields, "date": "2023-07", "meth": "x"}, {**fields, "poc": ""}]
    text = ["|".join(r.get(n, "") for n in C.TRANSACTION_FIELDS) for r in lines]
    with open(f"{folder}/t.txt", "w") as f:
        f.write("\n".join(["# head", *text, text[0] + "|a|b"]) + "\n")
    kept, rejects = readers.transactions_and_rejects(spark, f"{folder}/t.txt")
    assert table(rejects.select("column", "text", "reason"), "column") == [
        ("_surplus", "a", "too many fields"), ("date", "2023-07", "not yyyyMMdd"), ("meth", "x", "not int"), ("value", "?", "not double")]
    rows = refresh.from_transactions(kept, "Ozone")
    assert rows.count() == 4 and rows.where("sample_measurement IS NULL").count() == 1 and rows.where("poc IS NULL").count() == 1
