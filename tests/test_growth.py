"""What a task holds and how often rows are shuffled must not grow faster than the input."""

import glob
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from helpers import raw
from plumeworks.functions.expressions import haversine_km
from plumeworks.operators import aggregates, clean, geo
from plumeworks.plans import queries, tables as tab
from plumeworks.plans.queries import QUERIES
from plumeworks.session import BYTES_PER_PARTITION, FIRST_PARTITIONS, TASK_BYTES, bound_tasks, shuffle_partitions
from plumeworks.sources import writers

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", [clean.drop_exact_duplicates, clean.clean_measurements, aggregates.daily_stats])
def test_wide_rows_are_shuffled_once_and_folded_after_it(spark, step):
    t = tab.tables(spark, FOLDER)
    plan = plan_of(step(t.get("hourly") if step is aggregates.daily_stats else t.raw()))
    assert len(re.findall(r"\bExchange\b", plan)) == 1
    assert "Aggregate" not in plan[plan.index("Exchange"):]


def test_placed_copies_collapse(spark):
    rows = raw(spark, {}, {}, {"poc": None}, {"poc": None}, {"sample_measurement": 0.0}, {"sample_measurement": -0.0})
    assert clean.clean_measurements(rows).count() == 3


@pytest.mark.parametrize("name", sorted(tab.PLACED))
def test_placed_tables_are_written_where_they_are(spark, name, monkeypatch):
    seen = {}
    monkeypatch.setattr(tab.writers, "write_partitioned", lambda df, path, *layout, placed=False: seen.update({path.split("/")[-1]: placed}) or df.write.parquet(path))
    tab.Tables(spark, FOLDER).get(name)
    assert seen[name]


def test_a_task_takes_a_bounded_share(spark):
    tab.tables(spark, FOLDER)
    assert {key: spark.conf.get(key) for key in TASK_BYTES} == TASK_BYTES


def test_shuffles_have_partitions_in_proportion_to_the_input(spark):
    t = tab.tables(spark, FOLDER)
    assert shuffle_partitions(spark) == max(4, -(-t.input_bytes // BYTES_PER_PARTITION))
    bound_tasks(spark, 40 * BYTES_PER_PARTITION)
    try:
        plan = plan_of(clean.clean_measurements(t.raw()))
        assert re.search(r"Exchange hashpartitioning\(.*, 40\)", plan) and re.search(r"pmod\(xxhash64\(.*\), 5\)", plan)
    finally:
        bound_tasks(spark, t.input_bytes)


def test_a_session_keeps_a_number_of_partitions_of_its_own(spark, monkeypatch):
    class Given:
        def contains(self, key):
            return True

    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: Given())
    before = spark.conf.get(FIRST_PARTITIONS, None)
    bound_tasks(spark, 1 << 40)
    assert spark.conf.get(FIRST_PARTITIONS, None) == before


@pytest.mark.parametrize("name, spared", [
    ("R1_site_pairing", {"daily"}), ("Q16_coverage_summary", {"daily", "registry"}), ("Q18_county_subset", {"daily"}),
    ("A22_group_report", {"hourly", "daily"}), ("K9_output_manifest", {"monthly", "values", "registry"}),
    ("K7_published_sql", {"monthly", "values", "registry"}), ("R2_combined_daily", {"combined"}),
    ("Q27_table_inventory", {"monthly", "values", "registry", "combined"}), ("P4_P5_P7_time_columns", {"hourly"}),
    ("A13_ozone_8hr_4th_max", {"hourly"}), ("A21_coverage", {"hourly", "values"}),
])
def test_tables_of_a_single_use_are_not_stored(spark, name, spared, monkeypatch):
    monkeypatch.setattr(tab, "_OPEN", {})
    QUERIES[name](spark, FOLDER).collect()
    assert not spared & tab.tables(spark, FOLDER).done


def _sites(spark, spots, each):
    rows = spark.range(spots * each).withColumn("spot", F.col("id") % spots)
    return rows.select(F.format_string("s%05d", (F.col("id") * 7919) % (spots * each)).alias("aqsid"), (29.0 + F.col("spot") * 0.07).alias("lat"), F.lit(-98.0).alias("lon"))


def test_crowds_at_one_spot_make_no_pairs(spark, monkeypatch):
    compared, plain = [], geo.neighbours_within

    def counting(points, km, key="aqsid"):
        compared.append(points.count())
        return plain(points, km, key)

    monkeypatch.setattr(geo, "neighbours_within", counting)
    registry = _sites(spark, 3, 500).withColumn("co_located_with", F.lit(""))
    filled = geo.fill_co_located(registry, 10.0)
    assert filled.where(F.col("co_located_with") == "").count() == 0 and compared == [3]


def test_first_co_located_equals_all_pairs(spark):
    sites = _sites(spark, 9, 3).unionByName(spark.createDataFrame(
        [("alone", 10.0, 10.0), ("nowhere", None, 1.0), ("z", 0.0, 20.0), ("y", -0.0, 20.0), ("x1", 40.0, 179.99), ("x2", 40.0, -179.99)], "aqsid string, lat double, lon double"))
    b = sites.toDF("other", "blat", "blon")
    near = haversine_km(F.col("lat"), F.col("lon"), F.col("blat"), F.col("blon")) <= 16.0
    want = sites.join(b, F.col("aqsid") != F.col("other")).where(near).groupBy("aqsid").agg(F.min("other").alias("_other"))
    found = geo.first_within(sites, 16.0)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_months_follow_days_without_a_shuffle(spark):
    hourly = tab.tables(spark, FOLDER).get("hourly")
    monthly = aggregates.monthly_stats(aggregates.daily_stats(hourly, tab.SPARSE_THRESHOLD, month=True))
    assert len(re.findall(r"\bExchange\b", plan_of(monthly))) == 1
    plain = aggregates.monthly_stats(aggregates.daily_stats(hourly, tab.SPARSE_THRESHOLD))
    keys = [*aggregates.IDENTITY, "year_month", "n_valid_days"]
    assert monthly.columns == plain.columns and sorted(map(str, monthly.select(keys).collect())) == sorted(map(str, plain.select(keys).collect()))


def test_groups_are_chosen_before_rows_are_cleaned(spark):
    t = tab.Tables(spark, FOLDER)
    plan = plan_of(t.hourly_of({"Ozone"}))
    scan = next(line for line in plan.splitlines() if "Filter" in line and "Ozone" in line and "RLIKE" in line)
    assert scan.index("= Ozone") < scan.index("RLIKE")
    some = t.hourly_of({"Ozone", "CO"}).select("aqsid", "datetime", "sample_measurement")
    kept = t.get("hourly").where("pollutant_group IN ('CO', 'Ozone')").select(*some.columns)
    assert some.exceptAll(kept).isEmpty() and kept.exceptAll(some).isEmpty()
    again = t.hourly_of({"Ozone", "CO"})
    assert again.inputFiles() and all("/hourly/" in f for f in again.inputFiles())


def test_metric_values_are_design_values_without_names(spark):
    t = tab.Tables(spark, FOLDER)
    bare = t.metric_values()
    named = t.get("values").select(*bare.columns)
    found, want = (sorted(map(str, tab.tidy(df).collect())) for df in (bare, named))
    assert found and found == want


def test_combined_rows_of_a_site_are_chosen_before_rows_are_folded(spark):
    """As the stored table holds them, whether the tables it is made of are stored or not; a site that is not there has none."""
    site, order = "480130032", ["pollutant_group", "pollutant_name", "parameter_code", "date_local"]
    bare = tab.Tables(spark, FOLDER)
    some = bare.combined_of(site)
    rows = [tuple(r) for r in tab.tidy(some).orderBy(*order).collect()]
    assert not {"hourly", "daily", "pairing", "combined"} & bare.done
    assert bare.combined_of("nowhere").count() == 0
    t = tab.Tables(spark, FOLDER)
    for stored in ("hourly", "daily", "combined"):
        t.get(stored)
        again = tab.tidy(t.combined_of(site).select(*some.columns))
        assert rows and [tuple(r) for r in again.orderBy(*order).collect()] == rows


def test_correlations_of_a_site_store_no_table_of_all_sites(spark, monkeypatch):
    monkeypatch.setattr(tab, "_OPEN", {})
    QUERIES["Q12_weather_correlations"](spark, FOLDER).collect()
    assert not {"hourly", "daily", "pairing", "combined"} & tab.tables(spark, FOLDER).done


def test_deliveries_with_headers_of_their_own_are_compressed(spark, monkeypatch, folder):
    """All rows are there, and every part is gzip."""
    monkeypatch.setattr(queries, "folder", lambda t, label: f"{folder}/{label}")
    found = {r["name"]: r["passed"] for r in QUERIES["V1_file_headers"](spark, FOLDER).collect()}
    assert found["rows"] and len(found) == 6
    parts = glob.glob(f"{folder}/v1/*.csv/part-*")
    assert len({os.path.dirname(p) for p in parts}) == 5 and all(p.endswith(".csv.gz") for p in parts)


def shuffle_files(spark):
    """Files of shuffles that this session has on disk."""
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in local for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


@pytest.mark.parametrize("label", ["append", "insert"])
def test_appends_leave_neither_shuffles_nor_copies_behind(spark, label, folder):
    """No file of a shuffle and no copy of the delta is left when the rows are in the store."""
    tab.tables(spark, FOLDER)
    rows = raw(spark, *[{"time_local": f"{h:02d}:00", "poc": p} for h in range(24) for p in (1, 2)])
    store = rows.withColumn("year", F.lit(2023)) if label == "append" else clean.derive_time(rows)
    writers.write_partitioned(store.where("poc = 1"), f"{folder}/store", ["pollutant_group", "year"])
    kept = f"{spark.conf.get('spark.checkpoint.dir')}/plumeworks/{label}-*"
    copies, files = set(glob.glob(kept)), shuffle_files(spark)
    if label == "append":
        writers.append_delta(spark, store, f"{folder}/store").collect()
    else:
        writers.insert_absent(spark, rows, f"{folder}/store")
    assert spark.read.parquet(f"{folder}/store").count() == 48
    assert set(glob.glob(kept)) == copies
    until = time.time() + 20
    while shuffle_files(spark) - files and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - files
