"""Nearest-station join and the county fallback, both as equi joins.

Comparing every site with every station grows with the product of the two tables. The
nearest join instead walks down a tree of cells: the globe splits into cells, and a cell that
holds more than ``LEAF`` places splits again, level by level, as deep as the crowd needs. Each
site starts at the top and keeps, level by level, only the cells that can still hold its
nearest station. The pruning bound is a distance to a real station, so nothing that
could win is dropped and the result equals the exhaustive comparison. A site is compared with
at most ``LEAF`` places of a cell it reaches, however many stations a town has.
"""

import math
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.functions.expressions import haversine_km, km_from_haversine
from plumeworks.session import settle

SPLIT = 8  # each cell splits into SPLIT x SPLIT children
LEAF = 32  # places in a cell that is not split any further
DEEPEST = 15  # cells of this level are 5e-12 degrees wide, beyond what coordinates can tell apart
BROADCAST_LEVELS = 2  # at most SPLIT**4 = 4096 cells exist there: a fixed bound
KM_PER_DEGREE = math.pi * C.EARTH_RADIUS_KM / 180
_EXTENT = ["south", "north", "west", "east", "member_lat", "member_lon", "leaf"]


def _cell(level):
    """Row and column of a coordinate's cell on a level; the parent's are those divided by ``SPLIT``."""
    n = SPLIT**level

    def index(degrees, span):
        step = F.floor((F.col(degrees) / span + 0.5) * n)
        return F.least(F.greatest(step, F.lit(0)), F.lit(n - 1)).cast("long")

    return index("lat", 180.0), index("lon", 360.0)


def _at_level(places, level):
    row, col = _cell(level)
    return places.withColumns({"row": row, "col": col})


def split_cells(places):
    """The cells of each level, from the top, and the ``(level, row, col)`` each place ends in.

    A level holds the children of the crowded cells above it: their extent, one real place,
    and whether they are leaves. It is settled, and levels end where no cell is crowded.
    """
    levels, held = [], places
    while True:
        level = len(levels) + 1
        counted = _at_level(held, level).groupBy("row", "col").agg(
            F.min("lat").alias("south"), F.max("lat").alias("north"),
            F.min("lon").alias("west"), F.max("lon").alias("east"),
            F.max("lat").alias("member_lat"), F.max_by("lon", "lat").alias("member_lon"),
            ((F.count("*") <= LEAF) | F.lit(level >= DEEPEST)).alias("leaf"),
        )
        cells = settle(counted.withColumn("level", F.lit(level)), "station-cells")
        levels.append(cells)
        crowded = cells.where(~F.col("leaf")).select("row", "col")
        if crowded.isEmpty():
            break
        held = _at_level(places, level).join(crowded, ["row", "col"], "left_semi").select(*places.columns)
    ends = [
        _at_level(places, k).join(cells.where("leaf").select("level", "row", "col"), ["row", "col"])
        for k, cells in enumerate(levels, 1)
    ]
    return levels, reduce(lambda a, b: a.unionByName(b), ends)


def _least_km_to_extent():
    """Lower bound of the distance from (lat, lon) to any point of a cell's extent."""
    dlat = F.greatest(F.col("south") - F.col("lat"), F.col("lat") - F.col("north"), F.lit(0.0))
    def around(edge):
        gap = F.abs(F.col(edge) - F.col("lon")) % 360.0
        return F.least(gap, 360.0 - gap)
    inside = F.col("lon").between(F.col("west"), F.col("east"))
    dlon = F.when(inside, 0.0).otherwise(F.least(around("west"), around("east")))
    narrowest = F.least(F.cos(F.radians("south")), F.cos(F.radians("north")))
    term = F.pow(F.sin(F.radians(dlat) / 2), 2) + (
        F.cos(F.radians("lat")) * F.greatest(narrowest, F.lit(0.0)) * F.pow(F.sin(F.radians(dlon) / 2), 2)
    )
    return km_from_haversine(term)


def _keep_possible(pairs, entered):
    """Of a spot's cells, those that can hold something nearer than a station already known.

    Cells just ``entered`` are measured; leaves reached on an earlier level keep their figures.
    """
    real = haversine_km(F.col("lat"), F.col("lon"), F.col("member_lat"), F.col("member_lon"))
    measured = pairs.withColumns({
        "least_km": F.when(entered, _least_km_to_extent()).otherwise(F.col("least_km")),
        "bound": F.least("bound", F.when(entered, real)),
    })
    slack = 1.0 + 1e-9  # keeps exact ties alive through rounding
    bound = F.min("bound").over(Window.partitionBy("lat", "lon"))
    kept = measured.withColumn("bound", bound).where(F.col("least_km") <= F.col("bound") * slack + 1e-9)
    return kept.select("lat", "lon", "level", "row", "col", "leaf", "least_km", "bound")


def candidate_pairs(sites, stations):
    """``(lat, lon, location, slat, slon)``: every spot of a site with the places it has to be compared with.

    Stations at one place are folded into the first by name, which wins any tie between them.
    """
    places = stations.groupBy("lat", "lon").agg(F.min("location").alias("location"))
    levels, members = split_cells(settle(places, "station-places"))
    # Level 1 has at most SPLIT x SPLIT cells, so every spot starts from that short list.
    top = levels[0].agg(F.collect_list(F.struct("level", "row", "col", *_EXTENT))).scalar()
    live = sites.select("lat", "lon").distinct().select("lat", "lon", F.inline(top))
    nothing = F.lit(None).cast("double")
    live = _keep_possible(live.withColumns({"least_km": nothing, "bound": nothing}), F.lit(True))
    for above, cells in enumerate(levels[1:], 1):
        children = cells.select(
            F.lit(above).alias("level"), F.floor(F.col("row") / SPLIT).alias("row"), F.floor(F.col("col") / SPLIT).alias("col"),
            F.struct("level", "row", "col", *_EXTENT).alias("child"),
        )
        if above < BROADCAST_LEVELS:
            children = F.broadcast(children)  # bounded by the grid, and few keys to spread by
        # A leaf has no children, so it stays as it is.
        joined = live.join(children, ["level", "row", "col"], "left")
        entered = F.col("child").isNotNull()
        own = {c: F.coalesce(f"child.{c}", c) for c in ("level", "row", "col", "leaf")}
        live = _keep_possible(
            joined.select(
                "lat", "lon", "least_km", "bound", "child", *[e.alias(c) for c, e in own.items()],
                *[F.col(f"child.{c}") for c in _EXTENT if c != "leaf"],
            ),
            entered,
        )
    places = members.select("level", "row", "col", "location", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    return live.join(places, ["level", "row", "col"]).select("lat", "lon", "location", "slat", "slon")


def nearest_station(sites, stations, key="aqsid"):
    """``sites`` plus ``weather_station`` and ``distance_km``; ties go to the first name.

    Sites need ``key, lat, lon`` and stations ``location, lat, lon``, all non-null. Sites at
    one spot are looked up once.
    """
    distance = haversine_km(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon"))
    best = (
        candidate_pairs(sites, stations)
        .select("lat", "lon", distance.alias("distance_km"), "location")
        .groupBy("lat", "lon")
        .agg(F.min(F.struct(F.round("distance_km", 9).alias("order_km"), "location", "distance_km")).alias("best"))
    )
    return sites.join(best, ["lat", "lon"]).select(
        *sites.columns,
        F.col("best.location").alias("weather_station"),
        F.col("best.distance_km").alias("distance_km"),
    )


def _columns_of_band(band, km):
    """Cells of a latitude band: as many as fit if each is at least as wide as ``km`` reaches anywhere in it or next to it."""
    height = km / KM_PER_DEGREE
    edge = F.greatest(F.abs(band - 1), F.abs(band + 2)) * height
    reach = F.sin(F.lit(km / (2 * C.EARTH_RADIUS_KM))) / F.cos(F.radians(F.least(edge, F.lit(89.999))))
    width = F.degrees(2 * F.asin(F.least(reach, F.lit(1.0))))
    return F.when(edge >= 89.9, 1).otherwise(F.greatest(F.floor(360.0 / width), F.lit(1))).cast("long")


def neighbours_within(points, km, key="aqsid"):
    """``(key, other)``: pairs of points at most ``km`` apart, each pair both ways; ``points`` have ``key, lat, lon``.

    A grid join: bands of latitude ``km`` high, cut into cells at least ``km`` wide. A point looks into its own cell
    and those around it, across the date line too; bands at the poles are one cell.
    """
    rows = points.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(key, "lat", "lon")
    own_band = F.floor(F.col("lat") / (km / KM_PER_DEGREE)).cast("long")

    def column(band):
        n = _columns_of_band(band, km)
        return F.least(F.floor(F.pmod(F.col("lon"), F.lit(360.0)) / 360.0 * n), n - 1).cast("long")

    placed = rows.withColumn("band", own_band).withColumn("column", column(F.col("band")))
    around = rows.withColumn("band", F.explode(F.array(*[own_band + d for d in (-1, 0, 1)])))
    n = _columns_of_band(F.col("band"), km)
    around = around.withColumn("column", F.explode(F.array_distinct(F.array(*[F.pmod(column(F.col("band")) + d, n) for d in (-1, 0, 1)]))))
    near = placed.select("band", "column", F.col(key).alias("other"), F.col("lat").alias("other_lat"), F.col("lon").alias("other_lon"))
    pairs = around.join(near, ["band", "column"]).where(F.col(key) != F.col("other"))
    return pairs.where(haversine_km(F.col("lat"), F.col("lon"), F.col("other_lat"), F.col("other_lon")) <= km).select(key, "other")


def first_within(points, km, key="aqsid"):
    """``(key, _other)``: the smallest other key at most ``km`` away, for the points that have one.

    Points at one spot fold into its two smallest keys before spots are compared, so crowds of them make no pairs.
    """
    spot = F.struct("lat", "lon").alias("spot")
    located = points.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    placed = settle(located.select(key, (F.col("lat") + 0.0).alias("lat"), (F.col("lon") + 0.0).alias("lon")).distinct().select(key, "lat", "lon", spot), "spots")
    least = placed.groupBy("spot", "lat", "lon").agg(F.min(key).alias("_1st"))
    others = placed.join(least.select("spot", "_1st"), "spot").where(F.col(key) != F.col("_1st"))
    spots = settle(least.join(others.groupBy("spot").agg(F.min(key).alias("_2nd")), "spot", "left"), "spot-keys")
    itself = spots.select("spot", F.col("spot").alias("other"))
    near = neighbours_within(spots.select("spot", "lat", "lon"), km, "spot").unionByName(itself)
    near = near.join(spots.select(F.col("spot").alias("other"), "_1st", "_2nd"), "other").drop("other")
    other = F.when(F.col("_1st") != F.col(key), F.col("_1st")).otherwise(F.col("_2nd"))
    return placed.select(key, "spot").join(near, "spot").groupBy(key).agg(F.min(other).alias("_other")).where(F.col("_other").isNotNull())


def fill_co_located(registry, km):
    """``registry`` with ``co_located_with`` as the first id among the sites within ``km``; sites without one keep the empty text."""
    first = first_within(registry.select("aqsid", "lat", "lon"), km)
    filled = registry.join(first, "aqsid", "left").withColumn("co_located_with", F.coalesce("_other", "co_located_with"))
    return filled.select(*registry.columns)


def county_fallback(counties, stations):
    """``(county_name, weather_station)``: the first station whose name contains the county.

    Containment becomes an equi join: every substring of a station name is a possible county,
    so the work is linear in the stations and no pair is tested twice.
    """
    name = F.lower("location")
    starts = F.sequence(F.lit(1), F.length("location"))
    substrings = F.flatten(
        F.transform(
            starts,
            lambda i: F.transform(
                F.sequence(F.lit(1), F.length("location") - i + 1), lambda n: F.substring(name, i, n)
            ),
        )
    )
    needles = F.array_distinct(F.concat(F.array(F.lit("")), substrings))
    by_needle = (
        stations.where(F.length("location") > 0)
        .select("location", F.explode(needles).alias("needle"))
        .groupBy("needle")
        .agg(F.min("location").alias("weather_station"))
    )
    wanted = counties.select("county_name").where(F.col("county_name").isNotNull()).distinct()
    return wanted.join(by_needle, F.lower("county_name") == F.col("needle")).select(
        "county_name", "weather_station"
    )
