"""Best-fit-decreasing packing of documents into token sequences."""

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from plumeworks.llm import tokens
from plumeworks.llm.common import settle, small_batches

CAPACITY = 1024
#: Piece rows of one Arrow batch.
OUT_ROWS = 8192


def pieces(docs: DataFrame, id_col="doc_id", text_col="text", capacity=CAPACITY, path=None) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, task, nth)``: documents cut into pieces of at most ``capacity`` tokens.

    The first piece takes what is over a multiple of the capacity. ``nth`` numbers the pieces of one length in a task.
    """
    path = path or tokens.default_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        task, seen, out = TaskContext.get().partitionId(), {}, []
        id_type = None

        def made():
            columns = list(zip(*out))
            types = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["id", "piece", "start", "length", "ids_crc32", "task", "nth"])

        def with_type():
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        for (doc,), ids in tokens.encode_batches(with_type(), path):
            n, start = len(ids) // 4, 0
            for piece in range(-(-n // capacity)):
                length = (n - 1) % capacity + 1 if piece == 0 else capacity
                out.append((doc, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), task, seen.get(length, 0)))
                seen[length] = seen.get(length, 0) + 1
                start += length
            if len(out) >= OUT_ROWS:
                yield made()
                out.clear()
        if out:
            yield made()

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


class OpenBins:
    """Ranges of open sequences by remaining capacity, with a segment tree over the capacities to find the tightest."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.ranges: dict[int, list[tuple[int, int]]] = {}

    def _add(self, left: int, n: int):
        at = left + self.leaves
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, left: int, first: int, n: int):
        if left and n:
            self.ranges.setdefault(left, []).append((first, n))
            self._add(left, n)

    def take(self, left: int) -> tuple[int, int]:
        first, n = self.ranges[left].pop()
        self._add(left, -n)
        return first, n

    def tightest(self, size: int) -> int | None:
        """The smallest remaining capacity of at least ``size`` that an open sequence has."""
        at = size + self.leaves
        if self.count[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over how many pieces there are of each length.

    Pieces of one length go to the tightest open sequence one after another; while it still fits, that sequence stays the
    tightest. So a whole range of equally filled sequences is treated in one step, each step finding it in logarithmic time,
    and the work is bounded by the lengths, not the documents. The number of sequences is that of one piece at a time.

    Returns rows ``(length, from, to, per_sequence, first_sequence, offset)``: pieces ``from`` to ``to`` of a length fill
    sequences from the first on, ``per_sequence`` in each, from the offset on.
    """
    bins, opened, rows = OpenBins(capacity), 0, []
    for size in sorted(counts, reverse=True):
        at, left_over = 0, counts[size]
        while left_over:
            room = bins.tightest(size)
            if room is None:
                room = capacity
                first, n = opened, -(-left_over // (capacity // size))
                opened += n
            else:
                first, n = bins.take(room)
            each = room // size
            full = min(n, left_over // each)
            if full:
                rows.append((size, at, at + full * each, each, first, capacity - room))
                bins.put(room - each * size, first, full)
                at += full * each
                left_over -= full * each
            if full < n and left_over and left_over < each:
                rows.append((size, at, at + left_over, left_over, first + full, capacity - room))
                bins.put(room - left_over * size, first + full, 1)
                left_over, full = 0, full + 1
            if full < n:
                bins.put(room, first + full, n - full)
    return rows


def pack(docs: DataFrame, id_col="doc_id", text_col="text", capacity=CAPACITY, path=None) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` of all pieces in as few sequences as best fit finds.

    The pieces are written once; the driver receives one count per length (at most ``capacity`` rows) and returns the
    filling rules, which are broadcast: their number depends on the lengths only. A piece finds its sequence by its rank among
    those of its length. A null text is empty: one piece with the end id. Rows that share an id are packed one by one.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        cut = settle(pieces(docs, id_col, text_col, capacity, path), "pack-pieces")
    held = settle(cut.groupBy("length", "task").agg(F.count("*").alias("c")), "pack-counts")
    counts = {r["length"]: r["c"] for r in held.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    rules = spark.createDataFrame(best_fit(counts, capacity), "length long, lo long, hi long, per long, first long, at long")
    before = F.sum("c").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    ranks = held.select("length", "task", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cut.join(ranks, ["length", "task"]).withColumn("nth", F.col("before") + F.col("nth"))
    placed = ranked.alias("p").join(F.broadcast(rules).alias("r"), (F.col("p.length") == F.col("r.length")) & (F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi")))
    inside = F.col("nth") - F.col("lo")
    return placed.select(
        F.col("id").alias(id_col), "piece", "start", F.col("p.length").alias("length"), "ids_crc32",
        F.expr("first + (nth - lo) div per").alias("sequence_id"),
        (F.col("at") + inside % F.col("per") * F.col("p.length")).cast("long").alias("offset"),
    )
