"""A sample of registered queries against their SQL, and the registry's own rules."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from plumeworks.plans.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "A7_pm10_24hr_exceedances", "A13_ozone_8hr_4th_max", "A14_design_values_any_hour", "A15_daily_stats", "A17_weather_daily",
    "R1_site_pairing", "R3_site_registry", "K4_append_delta", "V8_all_checks", "Q11_season_table", "Q23_eight_hour_peaks",
    "Q26_pollution_rose", "Q30_descriptives",
]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return str(v) if hasattr(v, "isoformat") else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    rel = db.execute(ORACLE[name])
    columns = [c[0] for c in rel.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, rel.fetchall())


def test_every_query_has_sql():
    """Of the library's own; some training-data queries can't be stated in SQL, but no SQL lacks a query."""
    assert set(entry.catalogue.QUERIES) == set(entry.catalogue.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "metric" in df.columns


@pytest.mark.parametrize("name", ["A14_design_values", "R2_combined_daily", "Q22_regression_rows", "Q30_descriptives"])
def test_plans_have_no_pairwise_joins_or_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoop|PythonUDF|ArrowEval|BatchEval", plan)


def test_series_of_all_groups_hold_vocs(spark, db):
    name = "A1_site_series"
    found = QUERIES[name](spark, FOLDER)
    assert found.where("pollutant_group = 'VOCs'").count() > 0
    rel = db.execute(ORACLE[name])
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows([c[0] for c in rel.description], rel.fetchall())


@pytest.mark.parametrize("name, times", [("S5_site_reference_csv", 1), ("S6_second_coordinate_source", 1), ("S9_source_dispatch", 3), ("U1_union_by_name", 2)])
def test_all_sites_hold_every_supplier(spark, db, name, times):
    found = QUERIES[name](spark, FOLDER)
    data = [tuple(r) for r in found.collect()]
    assert len(data) == times * db.execute("SELECT count(*) FROM supplier").fetchone()[0]
    rel = db.execute(ORACLE[name])
    assert rows(found.columns, data) == rows([c[0] for c in rel.description], rel.fetchall())
