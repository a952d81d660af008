"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification."""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from plumeworks.llm import tokens as encoder
from plumeworks.llm.common import bound_batches, connected, free_names, settle, small_side

#: Words of a shingle, least weighted Jaccard similarity, coordinates of a signature and rows of a band.
WORDS = 5
SIMILARITY = 0.8
COORDINATES = 128
BAND_ROWS = 4
WORDS_KEPT = 200_000
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Running chances of a Poisson count with mean one.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
_known: dict[str, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def shingles(text: str | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the runs of ``words`` lower-cased words, and how often each occurs.

    A text of fewer words is one run of them all; a null text or one without words has none.
    """
    parts = text.lower().split() if text else []
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(_known) > WORDS_KEPT:
        _known.clear()
    for w in set(parts).difference(_known):
        _known[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(_known.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(parts))
    run = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        run = _mix(run * _K1 + h[k : len(h) - n + 1 + k])
    return np.unique(run, return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """The DartMinHash signature of a weighted set: equal in a coordinate with the chance of the weighted Jaccard similarity.

    The plane over an element, weight by rank, is cut into cells of area one: weights [0, 1), [1, 2), [2, 4) and so on,
    ranks in steps of one over the cell's width. Each cell holds a Poisson number of darts whose places and coordinate follow
    from hashes of element and cell alone, so every set throws the same darts. A dart counts if it lies below the
    element's weight; the earliest by rank in each coordinate stays. Ranks are searched up to where about k ln k + 2k darts
    are expected, and twice as far again while a coordinate is empty.
    """
    total = float(weights.sum())
    reach = (k * math.log(k) + 2 * k) / total
    while True:
        darts, ranks, spots = [], [], []
        low, wide = 0.0, 1.0
        while True:
            own = np.flatnonzero(weights > low)
            if not len(own):
                break
            cells = max(1, math.ceil(reach * wide))
            region = np.uint64(int(low) << 32)
            cell = _mix(elements[own][:, None] + (region + np.arange(cells, dtype=np.uint64)[None, :]) * _K1).ravel()
            count = np.searchsorted(_POISSON, _unit(_mix(cell ^ _K1)))
            who = np.repeat(np.arange(len(cell)), count)
            nth = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
            dart = _mix(cell[who] + (nth + 1).astype(np.uint64) * _K3)
            rank = (who % cells + _unit(_mix(dart ^ _K2))) / wide
            keep = (low + wide * _unit(dart) < weights[own[who // cells]]) & (rank < reach)
            darts.append(dart[keep])
            ranks.append(rank[keep])
            spots.append((_mix(dart[keep] + _K2) % np.uint64(k)).astype(np.int64))
            low, wide = low + wide, max(1.0, low + wide)
        darts, ranks, spots = map(np.concatenate, (darts, ranks, spots))
        order = np.lexsort((ranks, spots))
        at, first = np.unique(spots[order], return_index=True)
        if len(at) == k:
            return darts[order[first]]
        reach *= 2


def bands(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One hash per band of ``rows`` coordinates, as signed integers."""
    grid = sig.reshape(-1, rows)
    h = np.arange(len(grid), dtype=np.uint64) + np.uint64(1)
    for k in range(rows):
        h = _mix(h * _K1 + grid[:, k])
    return h.view(np.int64)


def similarity(a, b) -> float:
    """Weighted Jaccard similarity of two shingle sets."""
    (x, m), (y, n) = a, b
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    both = x[at] == y
    shared = np.minimum(m[at][both], n[both]).sum()
    return float(shared / (m.sum() + n.sum() - shared))


def _verified(pairs: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """The pairs ``(a, b)`` whose texts are similar enough."""
    both = pairs.join(texts.select(F.col("u").alias("a"), F.col("t").alias("ta")), "a").join(texts.select(F.col("u").alias("b"), F.col("t").alias("tb")), "b")

    def check(batches):
        encoder.forget()
        last: dict[int, tuple] = {}
        for batch in batches:
            keep = []
            for a, ta, b, tb in zip(*batch.columns):
                sets = []
                for key, text in ((a.as_py(), ta), (b.as_py(), tb)):
                    if key not in last:
                        if len(last) >= 64:
                            last.clear()
                        last[key] = shingles(text.as_py(), words)
                    sets.append(last[key])
                keep.append(similarity(*sets) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "ta", "b", "tb").mapInArrow(check, "a long, b long")


def _prefixes(texts: DataFrame, words: int, least: float) -> DataFrame:
    """``(token, u, pos, n, lone)``: the rarest shingles of each text, at least one of which any similar text shares.

    A shingle's k-th occurrence is a token of its own, so weighted similarity is that of token sets. Tokens are ordered by
    rarity; two sets of similarity ``least`` share one among the first ``n - ceil(least n) + 1`` of each. Tokens found in one
    text come first and are only counted, as ``lone``; they are not shuffled again.
    """

    def explode(batches):
        encoder.forget()
        for batch in batches:
            for u, cell in zip(batch.column(0), batch.column(1)):
                elements, weights = shingles(cell.as_py(), words)
                nth = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
                tokens = _mix(np.repeat(elements, weights) + nth.astype(np.uint64) * _K1).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), u.as_py())), pa.array(tokens)], ["u", "token"])

    tokens = settle(texts.select("u", "t").mapInArrow(explode, "u long, token long"), "dart-tokens")
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("u")
    counted = tokens.join(shared, "token").withColumns({"nth": F.row_number().over(own.orderBy("df", "token")), "common": F.count("*").over(own)})
    placed = counted.join(tokens.groupBy("u").agg(F.count("*").alias("n")), "u")
    placed = placed.withColumn("lone", F.col("n") - F.col("common")).withColumn("pos", F.col("lone") + F.col("nth") - 1)
    return placed.where(F.col("pos") < F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).select("token", "u", "pos", "n", "lone")


def _central_pairs(entries: DataFrame, least: float) -> DataFrame:
    """Each text with the text of fewest lone tokens among those that share a rare token, where some are in other components."""
    groups = entries.groupBy("token").agg(F.min_by("u", F.struct("lone", "u")).alias("pivot"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    return entries.join(groups, "token").where("u <> pivot").select(F.least("u", "pivot").alias("a"), F.greatest("u", "pivot").alias("b")).distinct()


def _crossing_pairs(entries: DataFrame, least: float) -> DataFrame:
    """All pairs in different components that can still be similar.

    At the first token two sets share, what lies behind it in either must reach the overlap that the similarity asks for.
    """
    other = entries.select("token", F.col("u").alias("v"), F.col("pos").alias("q"), F.col("n").alias("m"), F.col("c").alias("d"))
    enough = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("q")) >= (F.col("n") + F.col("m")) * (least / (1 + least)) - 1e-6
    near = (F.col("c") < F.col("d")) & enough & (F.least("n", "m") >= F.greatest("n", "m") * least - 1e-6)
    both = entries.join(other, (entries["token"] == other["token"]) & near)
    return both.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", words=WORDS, least=SIMILARITY, k=COORDINATES, rows=BAND_ROWS) -> DataFrame:
    """``(id, class_id, kept)`` of every row: documents linked directly or in turn share the smallest id of their class.

    Two texts are linked if a band of their signatures agrees and the weighted Jaccard similarity of their shingles, with
    repeats as weights, is at least ``least`` (a pair at 0.8 shares one of 32 bands of 4 but for 5 chances in 10^8). Exact copies
    are one text. In a bucket every text is compared with its smallest member, which ties most groups together without their
    pairs. Texts of a bucket that are then still in different components go on to an exact search among themselves: by their
    rarest shingles, first with the most central text that shares one, then with every text of another component that the
    overlap bounds allow.

    Rows without words (null, empty, blank) link with nothing. Rows with a null id get a null class and are kept; rows that
    share an id share a class. An empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    bound_batches(docs.sparkSession)

    def sign(batches):
        encoder.forget()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for cell in part.column(2):
                    elements, weights = shingles(cell.as_py(), words)
                    out.append(bands(signature(elements, weights, k), rows) if len(elements) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.list_(pa.int64()))], ["id", "copy", "bands"])

    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.md5(F.col(text_col).cast("binary")).alias("copy"), F.col(text_col).alias("t"))
    signed = settle(named.mapInArrow(sign, "id long, copy string, bands array<long>"), "dart-bands")
    live = signed.where("bands IS NOT NULL")
    texts_of = live.groupBy("copy").agg(F.min("id").alias("u"))
    members = settle(live.join(texts_of, "copy").select("id", "u", F.when(F.col("id") == F.col("u"), F.col("bands")).alias("bands")), "dart-members")
    entries = members.where("bands IS NOT NULL").select("u", F.explode("bands").alias("bucket"))
    buckets = settle(entries.groupBy("bucket").agg(F.min("u").alias("pivot"), F.max("u").alias("top")).where("pivot < top").select("bucket", "pivot"), "dart-buckets")
    crowded = settle(entries.join(small_side(buckets), "bucket").distinct(), "dart-crowded")
    stars = settle(crowded.where("u <> pivot").select(F.col("pivot").alias("a"), F.col("u").alias("b")).distinct(), "dart-stars")
    wanted = stars.select(F.col("a").alias("u")).union(stars.select(F.col("b").alias("u"))).distinct()
    keys = settle(texts_of.join(wanted, "u"), "dart-keys")
    texts = settle(named.select(F.col("id").alias("u"), "copy", "t").join(small_side(keys), ["copy", "u"]).dropDuplicates(["u", "copy"]).select("u", "t"), "dart-texts")
    links = settle(_verified(stars, texts, words, least), "dart-links")
    same = members.where("id <> u").select(F.col("u").alias("a"), F.col("id").alias("b"))
    found = connected(links.unionByName(same))
    rest = crowded.join(found, F.col("u") == F.col("node"), "left").select("bucket", "u", F.coalesce("component", "u").alias("c"))
    split = rest.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("bucket")
    unsettled = settle(rest.join(split, "bucket").select("u").distinct(), "dart-open")
    if not unsettled.isEmpty():
        entries = settle(_prefixes(texts.join(unsettled, "u"), words, least), "dart-prefixes")
        for pairs_of in (_central_pairs, _crossing_pairs):
            placed = entries.join(found, F.col("u") == F.col("node"), "left").withColumn("c", F.coalesce("component", "u")).drop("node", "component")
            pairs = pairs_of(placed, least).join(stars, ["a", "b"], "left_anti")
            more = settle(_verified(pairs, texts, words, least), "dart-late")
            if not more.isEmpty():
                links = links.unionByName(more)
                found = connected(links.unionByName(same))
    rows_of = docs.select(F.col(id_col)).join(found, F.col(id_col).cast("long") == F.col("node"), "left")
    class_id = F.coalesce("component", F.col(id_col).cast("long"))
    return rows_of.select(F.col(id_col), class_id.alias("class_id"), F.coalesce(class_id == F.col(id_col).cast("long"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The documents that stay, one of each class, with all their columns; of rows with one id, all equal ones but the first go."""
    found = near_duplicates(docs, id_col, text_col, **options)
    lost, more, nth = free_names(docs.columns, "_gone", "_again", "_nth")
    gone = settle(found.where("NOT kept").select(F.col(id_col).alias(lost)).distinct(), "dart-gone")
    left = docs.join(gone, F.col(id_col) == F.col(lost), "left_anti")
    again = found.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("_n")).where("_n > 1").select(F.col(id_col).alias(more))
    again = settle(again, "dart-again")
    if again.isEmpty():
        return left
    once = left.join(again, F.col(id_col) == F.col(more), "left_anti")
    first = left.join(again, F.col(id_col) == F.col(more), "left_semi")
    first = first.withColumn(nth, F.row_number().over(Window.partitionBy(id_col).orderBy(text_col))).where(F.col(nth) == 1).drop(nth)
    return once.unionByName(first)
