"""Importance resampling towards a target corpus, with weights by bit-sliced aggregation.

A document's counts of hashed words are kept as planes: plane ``j`` is a bitmap over the buckets that holds bit ``j`` of each count.
The gains of the buckets are planes as well, in two's complement. The weight of a document is the sum, over all pairs of a count
plane and a gain plane, of the set bits of their conjunction times a power of two (negative for the sign plane): exact integers.
"""

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plumeworks.session import settle

BUCKETS = 10_000
#: Documents whose planes are made at once, and bytes of a text that are cut into words at once; both bound memory only.
DOCS, PIECE = 128, 1 << 20
SEED, LEAST_WORDS, PERCENT = 2024, 20, 10
#: Lower case of A-Z; bytes that end a word become spaces. Bytes above 127 belong to code points that are word characters.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())


def features(data: bytes, longest: int = 1):
    """Arrays of crc32 hashes of the runs of 1 to ``longest`` words of a text, and the number of its words in each."""
    data, at, tail = data.translate(_FOLD), 0, []
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        words = data[at:end].split()
        runs = [words]
        for n in range(2, longest + 1):
            line = tail[-(n - 1) :] + words
            runs.append([b" ".join(line[k : k + n]) for k in range(len(line) - n + 1)])
        tail = (tail + words)[-longest:]
        hashes = [h for run in runs for h in map(zlib.crc32, run)]
        yield np.array(hashes, np.int64), len(words)
        at = end


def _counts(texts, buckets, longest):
    """``(counts, words)`` of some texts: a row of bucket counts and the number of words of each."""
    counts, words = np.zeros((len(texts), buckets), np.int64), np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        for hashes, n in features(text or b"", longest):
            counts[k] += np.bincount(hashes % buckets, minlength=buckets)
            words[k] += n
    return counts, words


def _texts(batch):
    return batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()


def _bucket_sums(batches, buckets, longest):
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for text in _texts(batch):
            for hashes, _ in features(text or b"", longest):
                total += np.bincount(hashes % buckets, minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text_col="text", buckets=BUCKETS, longest=1) -> np.ndarray:
    """Counts of all features per bucket. A task sends its sums, so at most ``buckets`` rows reach the driver."""
    sums = texts.select(text_col).mapInArrow(partial(_bucket_sums, buckets=buckets, longest=longest), "bucket int, n long")
    found = np.zeros(buckets, np.int64)
    for bucket, n in sums.groupBy("bucket").agg(F.sum("n")).collect():
        found[bucket] = n
    return found


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln(...))`` of the smoothed ratio of target to raw share, per bucket."""
    ratio = (target + 1.0) * (raw.sum() + float(len(raw))) / ((raw + 1.0) * (target.sum() + float(len(raw))))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    wide = np.zeros((*packed.shape[:-1], -(-packed.shape[-1] // 8) * 8), np.uint8)
    wide[..., : packed.shape[-1]] = packed
    return wide.view(np.uint64)


def gain_planes(gains: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """``(factor, plane)`` of every bit of the gains in two's complement; the factor of the sign plane is negative."""
    width = int(max(gains.max(initial=0), -gains.min(initial=0) - 1)).bit_length()
    planes = [(1 << i, _packed((gains >> i & 1).astype(bool))) for i in range(width)]
    return [*planes, (-(1 << width), _packed(gains < 0))]


def plane_sums(counts: np.ndarray, planes) -> np.ndarray:
    """The sum of count times gain over the buckets of each row, from bit planes."""
    sums, most = np.zeros(len(counts), np.int64), counts.max(axis=1, initial=0)
    for j in range(int(most.max(initial=0)).bit_length()):
        rows = np.flatnonzero(most >> j)
        plane = _packed((counts[rows] >> j & 1).astype(bool))
        for factor, gain in planes:
            sums[rows] += (factor << j) * np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
    return sums


def _weigh(batches, planes, buckets, longest):
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS):
            part = batch.slice(at, DOCS)
            counts, words = _counts(_texts(part), buckets, longest)
            n = counts.sum(axis=1)
            weight = np.where(n > 0, plane_sums(counts, planes) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words), pa.array(n), pa.array(weight)], ["id", "words", "n_features", "weight"])


def resample(docs: DataFrame, target: DataFrame, id_col="doc_id", text_col="text", target_text_col="text", buckets=BUCKETS, longest=1,
             least_words=LEAST_WORDS, percent=PERCENT, seed=SEED) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` of every document; the drawn ones have a rank, from 1.

    A feature is a run of 1 to ``longest`` words; a bucket's gain is the log ratio of its share in the target to that in the
    documents, smoothed, in thousandths. A document's weight is the floored mean gain of its features, its score adds Gumbel noise
    from a hash of its id, so the highest scores are a draw without replacement. Of the documents with ``least_words`` words or
    more, ``percent`` percent are drawn, ties to the smaller id.

    Null and blank texts have no feature and weight 0. A row with a null id has a null score and is never drawn. Rows of one id
    have the same noise; those of one id and score follow each other in any order. Empty tables of either side are no error.

    All features are counted by one pass, weighed by a second one; no text is shuffled. Ranks come from counts per score (fewer than
    some hundred thousand values whatever the rows: a gain and the noise are logarithms) and an order inside a score only.
    """
    gains = gains_of(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_text_col, buckets, longest))
    kind = docs.schema[id_col].dataType.simpleString()
    run = partial(_weigh, planes=gain_planes(gains), buckets=buckets, longest=longest)
    weighed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, words long, n_features long, weight long")
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    rows = settle(weighed.withColumn("score", score.cast("long")), "resample-scores")
    live = F.col("words").__ge__(least_words) & F.col("id").isNotNull()
    per_score = rows.where(live).groupBy("score").agg(F.count("*").alias("n"))
    above = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_score = settle(per_score.withColumn("above", above), "resample-counts")
    wanted = (per_score.agg(F.sum("n")).first()[0] or 0) * percent // 100
    reached = per_score.where(F.col("above") < wanted)
    placed = rows.where(live).join(reached.select("score", "above"), "score")
    place = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy("id"))
    placed = placed.withColumn("rank", F.when(place <= wanted, place))
    last = reached.agg(F.min("score")).first()[0]
    rest = rows if last is None else rows.where(~live | (F.col("score") < last))
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    return placed.select(*columns, F.col("rank").cast("long").alias("rank")).unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))
