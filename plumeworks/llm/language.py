"""Language identification: multinomial naive Bayes over hashed character n-grams."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumeworks.llm import tokens
from plumeworks.llm.common import bound_batches

#: n-gram lengths, hash buckets, smoothing, and the bound on learned documents per language.
ORDERS = (2, 3)
BUCKETS = 1 << 15
ALPHA = 0.5
TRAIN_DOCS_PER_LANG = 3000
#: Characters handled at once; longer texts are scored piece by piece.
PIECE = 1 << 18
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _grams(codes: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """The bucket of each n-gram; the one of position i starts there."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    h = np.full(size, n, np.uint32)
    for k in range(n):
        h = (h ^ codes[k : k + size]) * _MULTIPLIERS[k % 3]
        h ^= h >> np.uint32(15)
    return (h % np.uint32(buckets)).astype(np.int64)


def _pieces(codes: np.ndarray, reach: int):
    """Overlapping windows, so that each n-gram of length up to ``reach`` lies in exactly one as a start."""
    for at in range(0, max(len(codes), 1), PIECE):
        yield codes[at : at + PIECE + reach - 1], min(PIECE, len(codes) - at)


def _text_counts(text: str, orders, buckets: int) -> np.ndarray:
    total = np.zeros(buckets, np.int64)
    codes = _codes(text)
    for n in orders:
        for piece, starts in _pieces(codes, n):
            total += np.bincount(_grams(piece, n, buckets)[:starts], minlength=buckets)
    return total


def train(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", orders=ORDERS, buckets=BUCKETS, per_lang=TRAIN_DOCS_PER_LANG):
    """``(languages, log-probability matrix, log priors)`` from rows with a language and a text.

    At most about ``per_lang`` documents of each language are learned, chosen by a hash of the id; the priors
    count all labelled rows. Counting is distributed; the driver receives languages x buckets sums.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where("l IS NOT NULL AND t IS NOT NULL")
    sizes = {r["l"]: r["count"] for r in rows.groupBy("l").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((buckets, 0), np.float32), np.zeros(0)
    share = F.broadcast(spark.createDataFrame([(l, per_lang / sizes[l]) for l in langs], "l string, share double"))
    chosen = rows.join(share, "l").where(F.pmod(F.xxhash64("i"), F.lit(1_000_000)) < F.col("share") * 1_000_000).select("l", "t")
    index = {l: k for k, l in enumerate(langs)}

    def count(batches):
        tokens.forget()
        total = np.zeros((len(index), buckets), np.int64)
        for batch in batches:
            for l, t in zip(batch.column(0), batch.column(1)):
                total[index[l.as_py()]] += _text_counts(t.as_py(), orders, buckets)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[lang, bucket], pa.int64())], ["l", "b", "c"])

    sums = chosen.mapInArrow(count, "l int, b int, c long").groupBy("l", "b").agg(F.sum("c").alias("c")).toPandas()
    counts = np.zeros((buckets, len(langs)))
    counts[sums["b"], sums["l"]] = sums["c"]
    logs = np.log((counts + ALPHA) / (counts.sum(0) + ALPHA * buckets))
    prior = np.log(np.array([sizes[l] for l in langs]) / sum(sizes.values()))
    return langs, logs.astype(np.float32), prior


def predict(docs: DataFrame, model, text_col="text", lang_name="lang_pred", score_name="score", orders=ORDERS) -> DataFrame:
    """All columns of ``docs`` with the predicted language and the posterior of that language.

    A null text, or one without any letter, is ``und`` with score 0; so is everything if nothing was learned.
    Ties go to the first language by code point. Columns of ``docs`` that have the new names are replaced.
    """
    langs, logs, prior = model
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((langs, logs, prior))
    kept = docs.drop(lang_name, score_name)

    def score(batches):
        tokens.forget()
        langs, logs, prior = shared.value
        buckets = len(logs)
        for batch in batches:
            preds, scores = [], []
            for cell in batch.column(text_col):
                text = cell.as_py()
                if not langs or text is None or not _LETTER.search(text):
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                codes, total = _codes(text), prior.copy()
                for n in orders:
                    for piece, starts in _pieces(codes, n):
                        total += logs[_grams(piece, n, buckets)[:starts]].sum(axis=0, dtype=np.float64)
                best = int(np.argmax(total))
                preds.append(langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            names = [*batch.schema.names, lang_name, score_name]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names)

    schema = T.StructType([*kept.schema.fields]).add(lang_name, "string").add(score_name, "double")
    return kept.mapInArrow(score, schema)


def held_out(id_col):
    """True for the fifth of the documents, by crc32 of the id as text, that is never learned; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` of every row; learned from the rows that are not held out."""
    learned = docs.where(~held_out(id_col) & F.col(id_col).isNotNull())
    model = train(learned, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).alias("_text"))
    return predict(rows, model, "_text").select(id_col, "held_out", "lang_pred", "score")
