"""Token-id files: all documents in id order, as adaptively coded blocks.

A token file is a folder of Parquet files, so that any store Spark reaches can hold it. A row is a segment: consecutive whole
documents with about ``SEGMENT_IDS`` ids (a longer document is a segment of its own), with columns ``part`` (range of the
document ids), ``segment`` (in the part), ``docs`` (document ids in order), ``lengths`` (ids of each, the end id included),
``n_ids`` and ``payload``, the container of independently reset, checksummed blocks of :mod:`plumeworks.llm.coder`. Any segment,
and any block of it, decodes without the others.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plumeworks.llm import coder, tokens

SEGMENT_IDS = coder.BLOCK * coder.LANES


def write_token_files(docs: DataFrame, folder: str, id_col="doc_id", text_col="text", path=None, end_id=tokens.END_ID, segment_ids=SEGMENT_IDS) -> None:
    """Encodes every whole text and writes the folder.

    Null texts are empty documents, with the end id alone. Rows of one id follow each other in text order; null ids come first.
    An empty table writes an empty folder.
    """
    path = path or tokens.default_path()
    ordered = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).repartitionByRange("id").sortWithinPartitions("id", "text")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        part, number, held, ids, id_type = TaskContext.get().partitionId(), 0, 0, [], None
        docs_of, lengths = [], []

        def typed():
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        def made():
            stream = np.frombuffer(b"".join(ids), "<u4")
            columns = [[part], [number], [docs_of], [lengths], [len(stream)], [coder.encode(stream)]]
            types = [pa.int32(), pa.int32(), pa.list_(id_type), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "segment", "docs", "lengths", "n_ids", "payload"])

        for (doc,), own in tokens.encode_batches(typed(), path, end_id):
            n = len(own) // 4
            if held and held + n > segment_ids:
                yield made()
                number, held = number + 1, 0
                docs_of, lengths, ids = [], [], []
            docs_of.append(doc)
            lengths.append(n)
            ids.append(own)
            held += n
        if held:
            yield made()

    schema = f"part int, segment int, docs array<{kind}>, lengths array<bigint>, n_ids bigint, payload binary"
    ordered.mapInArrow(run, schema).write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str, id_name="doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids)`` of every document: ``start`` counts the ids of all before it, ``ids`` are little-endian 32-bit.

    The starts of the segments, three numbers for each of some four million ids, are broadcast; the payloads are not shuffled.
    """
    files = spark.read.parquet(folder)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    starts = files.select("part", "segment", F.coalesce(inside, F.lit(0)).alias("inside")).join(parts.select("part", "before"), "part")
    starts = starts.select("part", "segment", (F.col("inside") + F.col("before")).alias("start"))
    placed = files.join(F.broadcast(starts), ["part", "segment"])
    kind = files.schema["docs"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                start, docs, lengths, payload = (batch.column(c)[k] for c in range(4))
                ids, lengths = coder.decode(payload.as_py()), np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                data = [ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [docs.values, pa.array(starts + start.as_py()), pa.array(lengths), pa.array(data, pa.binary())], ["id", "start", "n_tokens", "ids"])

    rows = placed.select("start", "docs", "lengths", "payload").mapInArrow(run, f"id {kind}, start long, n_tokens long, ids binary")
    return rows.withColumnRenamed("id", id_name)


def digest(rows: DataFrame) -> DataFrame:
    """The ids replaced by their unsigned crc32."""
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc32_of(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
