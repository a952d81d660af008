"""Exact top-k search over binary codes by incremental multi-index hashing."""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plumeworks.llm.common import settle

#: Nearest rows returned; rows and queries of a block.
K = 10
ROW_BLOCK = 16_384
QUERY_BLOCK = 1024
#: Bits of a segment: a code is as many segments as its vector needs.
_WIDTH = 16


def codes(vectors: DataFrame, id_col="vec_id", vec_col="embedding") -> DataFrame:
    """``(id, code)``: bit i of the code is set if component i is above zero; the code is an array of 16-bit segments.

    Null vectors, and those with a null or non-finite component, have no code and are left out, as are null ids.
    """
    v = F.col(vec_col)
    valid = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    one = F.lit(1)

    def segment(s):
        bits = F.transform(F.slice(v, s * _WIDTH + 1, F.lit(_WIDTH)), lambda x, i: F.when(x > 0, F.call_function("shiftleft", one, i)).otherwise(F.lit(0)))
        return F.aggregate(bits, F.lit(0), lambda a, b: a + b)

    last = F.greatest(F.ceil(F.size(v) / _WIDTH).cast("int") - 1, F.lit(0))
    return vectors.where(valid & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.transform(F.sequence(F.lit(0), last), segment).alias("code"))


def _masks(radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(_WIDTH), radius)], np.int64)


def search_block(ids, code, q_ids, q_code, k):
    """The ``k`` nearest rows of one block for each query, as (query row, id, distance); ties by smaller id; not itself.

    Codes are rows of segments. Rows are indexed by each segment's value. Radii grow one segment at a time: once segments 0 to s
    have been searched to radius r and the others to r - 1, every row within Hamming distance ``segments * r + s`` of the query
    has been seen, since a farther row alone exceeds all the radii. A query ends when its k-th verified distance is within that.
    """
    order_ids = np.argsort(ids, kind="stable")
    ids, code = ids[order_ids], code[order_ids]
    segments = code.shape[1]
    index = []
    for part in code.T.astype(np.int64):
        order = np.argsort(part, kind="stable")
        index.append((order, np.searchsorted(part[order], np.arange((1 << _WIDTH) + 1))))
    masks = [_masks(r) for r in range(_WIDTH + 1)]
    out = []
    for q, (own, c) in enumerate(zip(q_ids, q_code)):
        parts = c.astype(np.int64).tolist()
        seen = np.zeros(len(ids), bool)
        best_row, best_far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for step in range((_WIDTH + 1) * segments):
            r, s = divmod(step, segments)
            order, at = index[s]
            keys = parts[s] ^ masks[r]
            lo, n = at[keys], at[keys + 1] - at[keys]
            hit = np.flatnonzero(n)
            if len(hit):
                lo, n = lo[hit], n[hit]
                flat = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                rows = order[flat]
                rows = rows[~seen[rows]]
                seen[rows] = True
                rows = rows[ids[rows] != own]
                far = np.bitwise_count(code[rows] ^ c).sum(axis=1, dtype=np.int64)
                row, far = np.concatenate([best_row, rows]), np.concatenate([best_far, far])
                if len(row) > k:
                    keep = np.lexsort((row, far))[:k] if len(row) < 4 * k else _nearest(row, far, k)
                    row, far = row[keep], far[keep]
                best_row, best_far = row, far
            if len(best_far) >= k and best_far.max() <= step or len(best_far) >= len(ids):
                break
        out.append((np.full(len(best_row), q), ids[best_row], best_far))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _nearest(row, far, k):
    limit = np.partition(far, k - 1)[k - 1]
    near = np.flatnonzero(far <= limit)
    return near[np.lexsort((row[near], far[near]))[:k]]


def top_k(rows: DataFrame, queries: DataFrame, k=K, row_block=ROW_BLOCK, query_block=QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, id, distance)``: the ``k`` rows nearest to each query, exact, from ``(id, code)`` tables.

    Both sides are dealt by hash into blocks of bounded size, one row each; every query block meets every row block and the
    best of each are merged per query (``k`` per row block). Ties go to the smaller id; a row with the query's own id is not
    returned; fewer than ``k + 1`` rows return all. Empty sides return nothing. Ids are longs and unique. Shorter codes are
    filled up with unset bits.
    """
    n_rows, n_queries = rows.count(), queries.count()
    segments = max((df.agg(F.max(F.size("code"))).first()[0] or 1) for df in (rows, queries))
    filled = F.transform(F.sequence(F.lit(0), F.lit(segments - 1)), lambda s: F.coalesce(F.get("code", s), F.lit(0)))
    rows, queries = rows.withColumn("code", filled), queries.withColumn("code", filled)
    blocks, q_blocks = max(1, -(-n_rows // row_block)), max(1, -(-n_queries // query_block))

    def blocked(df, n, tag):
        key = F.pmod(F.xxhash64("id", F.lit(tag)), F.lit(n))
        return df.groupBy(key.alias(f"{tag}_block")).agg(F.collect_list("id").alias(f"{tag}_ids"), F.collect_list("code").alias(f"{tag}_codes"))

    left = blocked(queries, q_blocks, "q").withColumn("r_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    pairs = left.join(blocked(rows, blocks, "r"), "r_block").select("q_ids", "q_codes", "r_ids", "r_codes")
    pairs = pairs.repartition(min(blocks * q_blocks, 10_000))

    def run(batches):
        for batch in batches:
            for j in range(batch.num_rows):
                q_ids, ids = (batch.column(c)[j].values.to_numpy(zero_copy_only=False) for c in (0, 2))
                q_codes, own = (batch.column(c)[j].values.flatten().to_numpy(zero_copy_only=False).astype(np.uint16).reshape(-1, segments) for c in (1, 3))
                q, near, far = search_block(ids, own, q_ids, q_codes, k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[q]), pa.array(near), pa.array(far.astype(np.int32))], ["query_id", "id", "distance"])

    found = pairs.mapInArrow(run, "query_id long, id long, distance int")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def search(vectors: DataFrame, is_query, id_col="vec_id", vec_col="embedding", k=K, **blocks) -> DataFrame:
    """The ``k`` nearest rows by sign codes for every row that ``is_query`` (a condition on ``id``) holds for."""
    coded = settle(codes(vectors, id_col, vec_col).withColumn("id", F.col("id").cast("long")), "codes")
    return top_k(coded, coded.where(is_query), k, **blocks)
