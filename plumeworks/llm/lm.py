"""Scores of texts by a language model of mixed bit predictors, next to a unigram baseline.

The model of :mod:`plumeworks.llm.mixer` is gathered from all training documents: tasks count the bits in their hashed contexts and
send packed ranges of the tables, which are added up per range as they stream by. The tables have a fixed number of slots, so what is
broadcast has a bound (``INPUTS * SLOTS`` bytes for each table set) whatever the input. Every training document teaches the weights:
the documents are dealt to ``FOLDS`` folds, and those of a fold are held against the tables of the others, which they had no part in. The
tables for scoring hold all.

Word counts grow with the text. Words that make up more than one in ``COMMON`` of all words are at most ``COMMON``, these are broadcast;
the counts of the others are joined, and none of those is frequent enough to crowd a task. Words used once are not joined: most words
are, and the text that holds one tells whether it was learned.
"""

from functools import partial
from itertools import repeat
from math import log2, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from plumeworks.llm import mixer
from plumeworks.session import settle

COMMON = 1 << 18
#: Bytes of text whose contexts, and whose words, a task counts at once.
COUNT_BYTES, WORD_BYTES = 1 << 25, 1 << 23
#: Folds of the training documents; each teaches the weights against the tables of the others.
FOLDS = 2
#: The end of a text as a token; white space is in no word.
_END = b"\n"
_PAIRS = 256 * (mixer.END + 1)
_SPACES = bytes.maketrans(b"\t\n\v\f\r", b" " * 5)


def fold_of(id_col, parts: int, over: int = 1) -> Column:
    """What the crc32 of the id as text, divided by ``over``, leaves of ``parts``; null for null ids."""
    return (F.floor(F.crc32(F.col(id_col).cast("string").cast("binary")) / over) % parts).cast("int")


def in_fold(id_col, parts: int, fold: int, over: int = 1) -> Column:
    """Whether the id is in the fold; false for null ids."""
    return F.coalesce(fold_of(id_col, parts, over) == fold, F.lit(False))


def _texts(batch) -> list[bytes]:
    return [(x or b"").lower() for x in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]


def _word_counts(texts: list[bytes]):
    """Distinct words of some texts, with their ends, and how often each comes."""
    data = pa.array([b" ".join(texts).translate(_SPACES)], pa.large_binary())
    found = pc.value_counts(pc.split_pattern(data, " ").flatten())
    found = found.filter(pc.greater(pc.binary_length(found.field("values")), 0))
    words, times = found.field("values").cast(pa.binary()), found.field("counts")
    return pa.concat_arrays([words, pa.array([_END])]), pa.concat_arrays([times, pa.array([len(texts)])])


def _count_words(batches):
    """``(kind, token, c, n)``: uses of words (kind 0) in training texts and in all texts, and of pairs of bytes (kind 1)."""
    held, size, sizes = ([], []), 0, np.zeros(_PAIRS, np.int64)

    def made():
        for train, texts in zip((False, True), held):
            if texts:
                words, n = _word_counts(texts)
                c = n if train else pa.array(np.zeros(len(n), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), words, c, n], ["kind", "token", "c", "n"])
            texts.clear()

    for rows, texts in _groups(batches):
        sizes += mixer.pair_counts([text for (train,), text in zip(rows, texts) if train])
        for (train,), text in zip(rows, texts):
            held[train].append(text)
            size += len(text)
        if size > WORD_BYTES:
            yield from made()
            size = 0
    yield from made()
    pairs = np.flatnonzero(sizes)
    names = [int(s).to_bytes(4, "big") for s in pairs]
    yield pa.RecordBatch.from_arrays([pa.array([1] * len(pairs), pa.int32()), pa.array(names, pa.binary()), pa.array(sizes[pairs]), pa.array(sizes[pairs])], ["kind", "token", "c", "n"])


def _count_contexts(batches, code, folds):
    """``(fold, k, r, packed)``: counts of training texts, by the fold they teach in."""
    held, size = [[] for _ in range(folds)], 0

    def made():
        for fold, texts in enumerate(held):
            for k, r, packed in mixer.count(texts, code.value) if texts else ():
                yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.int32()) for x in (fold, k, r)], pa.array([packed])], ["fold", "k", "r", "packed"])
            texts.clear()

    for batch in batches:
        for fold, text in zip(batch.column(0).to_pylist(), _texts(batch)):
            held[fold].append(text)
            size += len(text)
            if size > COUNT_BYTES:
                yield from made()
                size = 0
    yield from made()


def _add_counts(batches, folds):
    """``(k, r, rest, every)`` table entries of each range, from its packed counts, which follow each other; ``rest`` leaves out a fold each."""
    at, sums = None, None

    def made():
        every = sum(sums)
        rest = pa.array([[mixer.odds(every - own) for own in sums]], pa.list_(pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), rest, pa.array([mixer.odds(every)])], ["k", "r", "rest", "every"])

    for batch in batches:
        for fold, k, r, packed in zip(*[c.to_pylist() for c in batch.columns]):
            if (k, r) != at:
                if at:
                    yield made()
                at, sums = (k, r), [np.zeros((mixer.RANGE, 2), np.int64) for _ in range(folds)]
            mixer.add_packed(packed, sums[fold])
    if at:
        yield made()


def _groups(batches, size=mixer.BATCH):
    """Rows of Arrow batches, some texts at a time: ``(other columns, texts)``."""
    rows, texts, held = [], [], 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns[:-1]], _texts(batch)):
            rows.append(row[:-1])
            texts.append(row[-1])
            held += len(row[-1]) + 1
            if held >= size:
                yield rows, texts
                rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


def _learn(batches, code, tables):
    """Weights that a task's texts teach, and how many symbols they have; a text is held against the tables without its fold."""
    weights, n = mixer.first_weights(code.value), 0
    held, sizes = [[] for _ in tables], [0] * len(tables)

    def teach(fold):
        if held[fold]:
            mixer.mix(held[fold], code.value, tables[fold].value, weights, learn=True)
        size, sizes[fold], held[fold] = sizes[fold], 0, []
        return size

    for batch in batches:
        for fold, text in zip(batch.column(0).to_pylist(), _texts(batch)):
            held[fold].append(text)
            sizes[fold] += len(text) + 1
            if sizes[fold] >= mixer.BATCH:
                n += teach(fold)
    n += sum(map(teach, range(len(tables))))
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype(float).ravel().tolist()]), pa.array([n])], ["weights", "n"])


_SCORED = "n_tokens long, n_common long, n_taught long, common_score double, rare array<binary>, n_bytes long, score double"


def _score(batches, code, tables, weights, common, key_type):
    known, unseen = common.value
    for rows, texts in _groups(batches):
        scores = mixer.mix(texts, code.value, tables.value, weights) / np.log(10)
        found, rare = [], []
        for text in texts:
            own = text.split()
            own.append(_END)
            logs = np.fromiter(map(known.get, own, repeat(np.nan)), float, len(own))
            lost = np.flatnonzero(np.isnan(logs)).tolist()
            rare += map(own.__getitem__, lost)
            found.append((len(own), len(own) - len(lost), len(own) - len(lost) - int(np.count_nonzero(logs == unseen)), float(np.nansum(logs)), len(lost), len(text)))
        n_tokens, n_common, n_taught, total, n_rare, n_bytes = map(np.array, zip(*found))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_rare)), pa.int32()), pa.array(rare, pa.binary()))
        keys = pa.array([key for key, in rows], key_type(batches))
        columns = [keys, *map(pa.array, (n_tokens, n_common, n_taught, total)), lists, pa.array(n_bytes), pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "n_tokens", "n_common", "n_taught", "common_score", "rare", "n_bytes", "score"])


class _Typed:
    """Passes batches on and remembers the type of their first column."""

    def __init__(self, batches):
        self.batches, self.type = batches, None

    def __iter__(self):
        for batch in self.batches:
            self.type = batch.schema.field(0).type
            yield batch


def _score_typed(batches, **more):
    return _score(_Typed(batches), key_type=lambda b: b.type, **more)


def _tables(ranges: DataFrame, column: str | Column) -> np.ndarray:
    """The tables from their ranges: a bounded number of rows and bytes."""
    tables = np.zeros((mixer.INPUTS, mixer.SLOTS), np.int8)
    for k, r, data in ranges.select("k", "r", column).toLocalIterator():
        tables[k, r * mixer.RANGE : (r + 1) * mixer.RANGE] = np.frombuffer(data, np.int8)
    return tables


def score(docs: DataFrame, id_col="doc_id", text_col="text", held_out: Column | None = None, folds=FOLDS) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)`` of every row, learned from those not held out.

    A-Z are lower-cased. The baseline sums, over words and an end, log10 of the word's smoothed share of all training words. ``score`` is
    log10 of the model's probability of the bytes and an end. ``held_out`` defaults to one document in five by the hash of its id.

    Null texts are empty: an end alone. A row with a null id takes part in training. Rows may repeat; each is scored. If nothing is
    left to learn from, counts are zero and the model is uniform over its code. An empty table gives no rows. All documents that are not
    held out teach the weights, dealt to ``folds`` by the hash of the id (null ids to the first). Weights are averaged over
    the tasks that learn them, so other file splits may move ``score`` a little; all counts are exact.
    """
    spark = docs.sparkSession
    out = in_fold(id_col, 5, 1) if held_out is None else F.coalesce(held_out, F.lit(False))
    text = F.col(text_col).alias("text")
    fold = F.coalesce(fold_of(id_col, folds, over=5), F.lit(0)).alias("fold")
    counted = docs.select((~out).alias("train"), text).mapInArrow(_count_words, "kind int, token binary, c long, n long")
    counted = settle(counted.groupBy("kind", "token").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "lm-words")
    symbols = np.zeros(_PAIRS, np.int64)
    for token, c in counted.where("kind = 1").select("token", "c").collect():
        symbols[int.from_bytes(token, "big")] = c
    code = spark.sparkContext.broadcast(mixer.Code(symbols.reshape(256, -1)))
    words = counted.where("kind = 0")
    total, seen, every = words.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum("n")).first()
    total, seen, every = total or 0, seen or 0, every or 0
    floor = total + 0.5 * (seen + 1)
    is_common = F.col("n") * COMMON >= every
    unseen = log10(0.5 / floor)
    common = {bytes(w): log10((c + 0.5) / floor) if c else unseen for w, c in words.where(is_common).select("token", "c").collect()}

    taught = docs.where(~out).select(fold, text)
    ranges = taught.mapInArrow(partial(_count_contexts, code=code, folds=folds), "fold int, k int, r int, packed binary")
    ranges = ranges.repartition("k", "r").sortWithinPartitions("k", "r").mapInArrow(partial(_add_counts, folds=folds), "k int, r int, rest array<binary>, every binary")
    ranges = settle(ranges, "lm-contexts")
    shared = [spark.sparkContext.broadcast(_tables(ranges, F.col("rest")[x])) for x in range(folds)]
    learned = taught.mapInArrow(partial(_learn, code=code, tables=shared), "weights array<double>, n long")
    learned = learned.select("n", F.posexplode("weights").alias("place", "w")).groupBy("place").agg(F.sum(F.col("w") * F.col("n")) / F.sum("n"))
    weights = mixer.first_weights(code.value)
    for place, w in learned.collect():
        weights.flat[place] = w
    for tables in shared:
        tables.unpersist()

    run = partial(_score_typed, code=code, tables=spark.sparkContext.broadcast(_tables(ranges, "every")), weights=weights, common=spark.sparkContext.broadcast((common, unseen)))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.struct(F.col(id_col).alias("id"), out.alias("held_out")).alias("key"), text).mapInArrow(run, f"key struct<id:{kind},held_out:boolean>, {_SCORED}").withColumn("row", F.monotonically_increasing_id())
    rows = settle(rows, "lm-scores")
    rare = rows.select("row", F.explode("rare").alias("token"))
    rare = rare.join(words.where(~is_common & (F.col("n") > 1)).select("token", "c"), "token")
    known = F.col("c") > 0
    rare = rare.groupBy("row").agg(F.count("*").alias("n_met"), F.count_if(known).alias("n_rare"), F.sum(F.when(known, F.log10((F.col("c") + 0.5) / floor))).alias("rare_score"))
    found = rows.drop("rare").join(rare, "row", "left")
    n_met, n_rare, rare_score = (F.coalesce(name, F.lit(zero)) for name, zero in (("n_met", 0), ("n_rare", 0), ("rare_score", 0.0)))
    # a word that no join meets is used once in all texts, here: a training text has taught it
    n_rare += F.when(F.col("key.held_out"), 0).otherwise(F.col("n_tokens") - F.col("n_common") - n_met)
    rare_score += F.when(F.col("key.held_out"), 0.0).otherwise((F.col("n_tokens") - F.col("n_common") - n_met) * log10(1.5 / floor))
    missed = (F.col("n_tokens") - F.col("n_common") - n_rare) * unseen
    return found.select(
        F.col("key.id").alias(id_col), "key.held_out", "n_tokens", (F.col("n_taught") + n_rare).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("common_score") + rare_score + missed).alias("base_score"), "score",
        (F.col("score") * -log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
