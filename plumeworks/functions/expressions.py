"""Column expressions shared by the operators. No Python UDFs: all stay in codegen."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumeworks import constants as C


def local_timestamp(date_text, time_text):
    """tz-naive timestamp from date + time text; anything but ``yyyy-M-d H:mm`` is null.

    Casting straight to TIMESTAMP_NTZ keeps the result independent of the session
    time zone (a zoned parse would shift hours that fall in a DST gap).
    """
    text = F.concat(F.col(date_text), F.lit(" "), F.col(time_text))
    shaped = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}$")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def season_of(month):
    """DJF / MAM / JJA / SON from a month column."""
    branches = [(F.col(month).isin(*months), name) for name, months in C.SEASONS.items()]
    head, *rest = branches
    return reduce(lambda acc, b: acc.when(b[0], b[1]), rest, F.when(*head))


def zero_fill(text, width):
    """Left-pad with zeros up to ``width``; longer text is kept whole."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def site_id(state, county, number):
    """Nine-digit site id; missing parts count as zero and long parts are never cut."""
    parts = [
        zero_fill(F.coalesce(F.col(c).cast("int"), F.lit(0)).cast("string"), width)
        for c, width in ((state, 2), (county, 3), (number, 4))
    ]
    return F.concat(*parts)


def path_safe(text):
    """Replace characters that cannot appear in partition folder names, then trim."""
    return F.trim(F.regexp_replace(F.col(text), r'[\\/:*?"<>|]', "_"))


def haversine_km(lat1, lon1, lat2, lon2):
    """Great-circle distance in km between two coordinate pairs given in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_dp = (p2 - p1) / 2
    half_dl = (F.radians(lon2) - F.radians(lon1)) / 2
    return km_from_haversine(F.pow(F.sin(half_dp), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_dl), 2))


def km_from_haversine(a):
    """Distance in km from the haversine term, clipped against rounding past 1."""
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * C.EARTH_RADIUS_KM)


def wind_sector(degrees):
    """Eight compass sectors; the north sector wraps, null stays null."""
    deg = F.col(degrees)
    out = F.when((deg < C.WIND_SECTORS[0][0]) | (deg >= C.WIND_SECTORS[-1][0]), "N")
    for upper, label in C.WIND_SECTORS[1:]:
        out = out.when(deg < upper, label)
    return out


def wind_components(speed, degrees):
    """Eastward and northward wind components from speed and direction."""
    rad = F.radians(F.col(degrees))
    return -F.col(speed) * F.sin(rad), -F.col(speed) * F.cos(rad)


def stable_round(value, digits):
    """Round half up, with decimal ties nudged upwards.

    A distributed float sum can differ in its last bit from run to run; without the nudge a
    value sitting on a tie would flip between two roundings.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column + 3.7e-10, digits)


def all_of(conditions):
    """AND of a list of columns."""
    return reduce(Column.__and__, conditions)


def join_same(left, right, keys, how="inner"):
    """Equi join on keys with nulls equal; the result carries the left keys only."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = all_of([F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def inline_table(spark, names, rows):
    """A literal table. The row list is code, so its size is fixed and safe to broadcast."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
