"""Writers: partition overwrite, exports, incremental appends, publishing, reconciliation."""

from functools import reduce
from uuid import uuid4

from pyspark.sql import functions as F

from plumeworks import constants as C
from plumeworks.functions.expressions import inline_table, join_same
from plumeworks.operators.clean import derive_time
from plumeworks.session import settled
from plumeworks.sources import keys
from plumeworks.sources.readers import parquet_dataset


def write_partitioned(df, path, partition_cols, sort_cols=(), placed=False):
    """Replace only the partitions present in ``df``; running it twice changes nothing.

    The rebalance hint gathers each partition's rows so files stay few, while adaptive
    execution splits a partition value that holds far more rows than the others. The writer
    sorts by partition anyway; ``sort_cols`` extend that sort so row-group statistics let
    later scans skip to a site or day. Rows that are ``placed`` already are written where they are.
    """
    rows = df if placed else df.hint("rebalance", *[F.col(c) for c in partition_cols])
    if sort_cols:
        rows = rows.sortWithinPartitions(*partition_cols, *sort_cols)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    return path


def write_table(df, path):
    """Result table to parquet, replaced as a whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return path


def write_csv(df, path, compressed=False):
    """CSV export with a header row in every part file; compressed ones are gzip at its fastest level, which readers open as they are."""
    writer = df.write.mode("overwrite").option("header", True)
    if compressed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.csv(path)
    return path


def new_rows(delta, existing, key_cols):
    """Rows of ``delta`` whose key is not in ``existing``; one row per key, nulls equal.

    Duplicates inside the delta keep the smallest row by value, so a rerun after a
    lost executor picks the same one.
    """
    rest = [c for c in delta.columns if c not in key_cols]
    absent = join_same(delta, existing.select(*key_cols), key_cols, "left_anti")  # known keys go before anything is folded
    return (
        absent.groupBy(*key_cols)
        .agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_rest"))
        .select(*key_cols, "_rest.*")
        .select(*delta.columns)
    )


def touched_partitions(existing, delta, cols):
    """Existing rows in the folders the delta reaches; all other folders are never opened."""
    return existing.where(keys.partitions_of(delta, cols))


def append_delta(spark, delta, path, key_cols=C.APPEND_KEY, partition_cols=("pollutant_group", "year")):
    """Append rows of known groups with new keys and report what each group gained.

    One partitioned write routes the rows to their group folders; groups outside the
    store are left out. Existing rows always win. The delta is computed once, and the report
    counts the rows that were written. Only files that may hold one of its keys are opened, by
    the key hashes of :mod:`plumeworks.sources.keys`. A repeated batch adds nothing, also when it was cut off before.
    """
    cols = list(partition_cols)
    existing = parquet_dataset(spark, path)
    before = group_counts(spark, path)
    delta = delta.where(F.col("pollutant_group").isin(*C.REFRESH_GROUPS)).select(*existing.columns)
    # Every group is a store of its own, so the key holds within the group.
    key = list(dict.fromkeys(["pollutant_group", *key_cols]))
    with settled(delta, "append-delta") as delta, settled(new_rows(delta, keys.rows_with_keys(delta, path, key, cols, key), key), "append-new") as fresh:
        _append(fresh, path, cols)
        added = counts_of(fresh)
    rows = [(g, before.get(g, 0), added.get(g, 0)) for g in C.REFRESH_GROUPS]
    report = inline_table(spark, ["pollutant_group", "rows_before", "rows_added"], rows)
    return report.select("pollutant_group", *[F.col(c).cast("long") for c in report.columns[1:]])


def group_counts(spark, path):
    """Rows per known group of a store."""
    return counts_of(parquet_dataset(spark, path))


def counts_of(df):
    """Rows per known group; at most one entry per group reaches the driver."""
    rows = df.where(F.col("pollutant_group").isin(*C.REFRESH_GROUPS))
    return {r["pollutant_group"]: r["n"] for r in rows.groupBy("pollutant_group").agg(F.count("*").alias("n")).collect()}


def insert_absent(spark, delta, path, partition_cols=("pollutant_group", "year")):
    """Insert-if-absent into the hourly store, deriving the time columns first."""
    cols = list(partition_cols)
    store = parquet_dataset(spark, path)
    with settled(derive_time(delta).select(*store.columns), "insert-delta") as rows:
        known = keys.rows_with_keys(rows, path, C.INSERT_KEY, cols, C.INSERT_KEY)
        with settled(new_rows(rows, known, C.INSERT_KEY), "insert-new") as fresh:
            _append(fresh, path, cols)


def _append(df, path, cols):
    df.hint("rebalance", *[F.col(c) for c in cols]).write.mode("append").partitionBy(*cols).parquet(path)


def publish(tables, root, mode="replace"):
    """Write named tables under ``root`` and expose each one to ``spark.sql``.

    A replaced table is written as a new version beside the one in use. Readers take the newest version whose
    write has finished (:func:`published`), so they see the old rows or the new ones, never a half.
    Appended rows join the version in use, in one commit.
    """
    for name, df in tables.items():
        spark, found = df.sparkSession, versions(df.sparkSession, root, name)
        if mode == "append" and found:
            df.write.mode("append").parquet(f"{root}/{name}/{found[-1]}")
        else:
            number = int(found[-1].split("-")[1]) + 1 if found else 1
            df.write.parquet(f"{root}/{name}/version-{number:06d}-{uuid4().hex}")
        published(spark, root, name).createOrReplaceTempView(name)


def versions(spark, root, name):
    """Finished versions of a published table, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path(folder, "version-*/_SUCCESS")
    return sorted(status.getPath().getParent().getName() for status in fs.globStatus(done))


def published(spark, root, name):
    """The newest finished version of a published table, or None."""
    found = versions(spark, root, name)
    return spark.read.parquet(f"{root}/{name}/{found[-1]}") if found else None


def reconcile(tables, root):
    """One row per published table: rows in the source, rows written, and whether they agree."""
    counts = []
    for name, df in tables.items():
        written = published(df.sparkSession, root, name)
        for side, rows in (("source", df), ("written", written)):
            n = rows.agg(F.count("*").alias("n"))
            counts.append(n.select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"))
    return (
        reduce(lambda a, b: a.unionByName(b), counts)
        .groupBy("table_name")
        .agg(
            F.max(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows"),
            F.max(F.when(F.col("side") == "written", F.col("n"))).alias("written_rows"),
        )
        .withColumn("matches", F.col("source_rows") == F.col("written_rows"))
    )


def manifest(spark, root, names=C.EXPORT_NAMES):
    """Expected outputs under ``root``: whether each exists and how many rows it holds."""
    rows = []
    for name in names:
        found = published(spark, root, name)
        if found is not None:
            counted = found.agg(F.count("*").alias("n_rows"))
        else:
            counted = spark.range(1).select(F.lit(0).cast("long").alias("n_rows"))
        rows.append(counted.select(F.lit(name).alias("table_name"), (F.col("n_rows") > 0).alias("present"), "n_rows"))
    return reduce(lambda a, b: a.unionByName(b), rows)
