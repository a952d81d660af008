"""Helpers shared by the operators of this folder."""

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

import plumeworks
from plumeworks.session import settle

#: A settled side of at most this many narrow rows (a hash as text and a long at the widest, some 64 bytes in memory) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000
#: Rows of whole texts in an Arrow batch, where operators ask for small ones; Spark's own 10,000 texts are some 30 MB.
BATCH_ROWS = 1000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> None:
    """Lets Python workers started from now on import this package where the driver found it.

    On a cluster without that path, install the package on the executors or pass it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(plumeworks.__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows from now on, for operators whose result is run by the caller; a value that the session was started with stays."""
    if not spark.sparkContext.getConf().contains(_BATCH_KEY):
        now = int(spark.conf.get(_BATCH_KEY))
        spark.conf.set(_BATCH_KEY, min(now if now > 0 else BATCH_ROWS, BATCH_ROWS))


@contextmanager
def conf(spark: SparkSession, values: dict):
    """Settings of the session for what is run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of at most ``BATCH_ROWS`` rows for what is run inside: a task holds a batch in the JVM and in Python, several times over."""
    before = spark.conf.get(_BATCH_KEY)
    spark.conf.set(_BATCH_KEY, min(int(before) if int(before) > 0 else BATCH_ROWS, BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_KEY, before)


def free_names(columns, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def bound(value, use):
    """``use`` of a value that is evaluated once, however often or deep in lambdas ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def small_side(settled: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The settled table with a broadcast hint if its counted rows are within the limit, else as it is."""
    return F.broadcast(settled) if settled.count() <= limit else settled


def connected(edges: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """``(node, component)`` of every node in an edge list of longs; the component is its smallest node.

    Alternates large-star and small-star steps: each replaces edges by edges to the smallest known neighbour,
    so a round is two aggregations and two joins on the node, without gathering a node's neighbours. Every round
    is written to the shared folder. Null ends and self edges are left out; no edges give no rows.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    pairs = settle(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = settle(large, label)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        pairs = settle(small, label)
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return settle(members.unionByName(roots), label)
