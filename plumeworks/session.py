"""Session settings and the shared work folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app="plumeworks", master=None, **extra):
    """A session with adaptive execution on and tz-naive semantics pinned to UTC.

    Shuffle partition counts are left to adaptive coalescing: start high enough
    for the cluster through ``spark.sql.shuffle.partitions`` and let AQE merge.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: What one task takes of files and of shuffles. Small enough that a task folds and sorts its share in memory, however large the table
#: is: rows of the stores take ten times the room in memory that they take in files or shuffles.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.files.openCostInBytes": "512k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}

#: Adaptive execution merges small shuffle partitions but splits none of a fold, so their number before merging follows the input.
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_PARTITION = 1 << 20


#: Files of a shuffle go when the step that made it is done, not when the driver happens to collect its garbage. Steps share nothing but
#: what they store, so the disk holds that and the shuffles of one step. A DataFrame that is run again makes its shuffles again.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def bound_tasks(spark, input_bytes=0):
    """Bounds the share of a task and the life of shuffle files, unless the session was started with values of its own.

    A shuffle has a partition for every MB of input files, and never fewer than ``spark.sql.shuffle.partitions``.
    """
    given = spark.sparkContext.getConf()
    for key, size in {**TASK_BYTES, **SHUFFLES_GO}.items():
        if not given.contains(key):
            spark.conf.set(key, size)
    if not given.contains(FIRST_PARTITIONS):
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(FIRST_PARTITIONS, str(max(least, -(-input_bytes // BYTES_PER_PARTITION))))


def shuffle_partitions(spark):
    """Partitions of a shuffle before adaptive execution merges small ones."""
    return int(spark.conf.get(FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def stored_bytes(spark, paths):
    """Size of files and folders."""
    found = [spark._jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    return sum(path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength() for path in found)


def work_folder(spark, label):
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/plumeworks/{label}-{uuid.uuid4().hex}"


def settle(df, label):
    """Write an intermediate table to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the table's real size,
    by which it decides between broadcasting and shuffling.
    """
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def settled(df, label):
    """:func:`settle` for what is run inside; the table is deleted afterwards."""
    spark, path = df.sparkSession, work_folder(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
