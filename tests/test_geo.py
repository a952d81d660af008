import math
import random

import pytest
from pyspark.sql import functions as F

from plumeworks.functions.expressions import haversine_km
from plumeworks.operators import geo


def km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(a)))


def sites(spark, points):
    return spark.createDataFrame([(f"s{i}", *p) for i, p in enumerate(points)], "aqsid string, lat double, lon double")


def stations(spark, points):
    return spark.createDataFrame(
        [(f"w{i:04d}", *p) for i, p in enumerate(points)], "location string, lat double, lon double"
    )


def test_one_degree_on_the_equator(spark):
    row = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()
    assert row[0] == pytest.approx(111.195, abs=1e-3)


def check(spark, places, posts):
    got = {r["aqsid"]: (r["weather_station"], r["distance_km"]) for r in
           geo.nearest_station(sites(spark, places), stations(spark, posts)).collect()}
    assert len(got) == len(places)
    for i, p in enumerate(places):
        best = min(range(len(posts)), key=lambda j: (round(km(*p, *posts[j]), 9), j))
        assert got[f"s{i}"][0] == f"w{best:04d}", (p, posts[best], got[f"s{i}"])
        assert got[f"s{i}"][1] == pytest.approx(km(*p, *posts[best]), abs=1e-6)


def test_nearest_equals_brute_force_over_the_globe(spark):
    rng = random.Random(11)
    def anywhere():
        return (rng.uniform(-90, 90), rng.uniform(-180, 180))
    check(spark, [anywhere() for _ in range(150)], [anywhere() for _ in range(200)])


def test_nearest_equals_brute_force_around_a_dense_cluster(spark):
    rng = random.Random(12)
    cluster = [(29.4 + rng.gauss(0, 0.05), -98.5 + rng.gauss(0, 0.05)) for _ in range(150)]
    far = [(rng.uniform(25, 36), rng.uniform(-106, -94)) for _ in range(60)] + cluster[:20]
    check(spark, far, cluster + [(60.0, 20.0)])


def test_date_line_and_poles(spark):
    check(
        spark,
        [(10.0, 179.9), (10.0, -179.9), (89.9, 0.0), (-89.5, 100.0), (0.0, 180.0), (90.0, 0.0)],
        [(10.0, -179.8), (10.0, 170.0), (89.9, 179.0), (-89.0, -80.0), (85.0, 0.0)],
    )


def test_ties_go_to_the_first_name_and_shared_spots_all_answer(spark):
    out = geo.nearest_station(
        sites(spark, [(0.0, 0.0), (0.0, 0.0)]),
        stations(spark, [(5.0, 5.0), (0.0, 1.0), (0.0, -1.0), (0.0, 1.0)]),
    )
    assert sorted((r["aqsid"], r["weather_station"]) for r in out.collect()) == [("s0", "w0001"), ("s1", "w0001")]


def test_no_pairwise_join_in_the_plan(spark):
    df = geo.nearest_station(sites(spark, [(0.0, 0.0)]), stations(spark, [(1.0, 1.0)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_county_fallback(spark):
    names = ["SA Bexar North", "bexar airport", "Corpus (Nueces)", "Laredo"]
    posts = spark.createDataFrame([(n,) for n in names], "location string")
    wanted = spark.createDataFrame([("Bexar",), ("Nueces",), ("Webb",), (None,), ("Bexar",), ("",)], "county_name string")
    got = {r[0]: r[1] for r in geo.county_fallback(wanted, posts).collect()}
    assert got == {"Bexar": "SA Bexar North", "Nueces": "Corpus (Nueces)", "": "Corpus (Nueces)"}
    plan = geo.county_fallback(wanted, posts)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_crowded_town_is_split_until_cells_are_small(spark):
    """All stations within a few km: exact, and each site meets a bounded number of them."""
    rng = random.Random(13)
    posts = [(29.4 + rng.random() * 0.02, -98.5 + rng.random() * 0.02) for _ in range(1500)] + [(29.41, -98.49)] * 400
    places = [(29.4 + rng.random() * 0.02, -98.5 + rng.random() * 0.02) for _ in range(300)] + [(29.41, -98.49), (-60.0, 10.0)]
    check(spark, places, posts)
    pairs = geo.candidate_pairs(sites(spark, places), stations(spark, posts)).groupBy("lat", "lon").count()
    near = pairs.where("lat > 0").agg(F.max("count"), F.avg("count")).first()
    assert near[0] <= 9 * geo.LEAF and near[1] <= 3 * geo.LEAF
    levels, ends = geo.split_cells(stations(spark, posts).groupBy("lat", "lon").agg(F.min("location").alias("location")))
    assert len(levels) > 4 and ends.count() == 1501 and ends.groupBy("level", "row", "col").count().agg(F.max("count")).first()[0] <= geo.LEAF


def test_neighbours_within_equal_all_pairs(spark):
    """Towns, the date line and both poles."""
    rng = random.Random(14)
    points = [(rng.choice([29.4, -12.0, 71.0]) + rng.gauss(0, 0.3), rng.choice([-98.5, 179.9, -179.9]) + rng.gauss(0, 0.3)) for _ in range(250)]
    points = [(lat, (lon + 180) % 360 - 180) for lat, lon in points] + [(89.95, 10.0), (89.96, -170.0), (-90.0, 0.0), (-89.99, 77.0), (29.4, -98.5), (29.4, -98.5)]
    for reach in (3.0, 25.0):
        got = {(r["aqsid"], r["other"]) for r in geo.neighbours_within(sites(spark, points), reach).collect()}
        want = {(f"s{i}", f"s{j}") for i, p in enumerate(points) for j, q in enumerate(points) if i != j and km(*p, *q) <= reach}
        assert got == want
