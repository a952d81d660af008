"""Mixing sources to target weights by the cube method of balanced sampling."""

from itertools import product
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from plumeworks.llm.common import free_names, settle

WORD = r"[^\x20\x09-\x0D]+"
#: Weights by the rank of a source (code point order, null last), total share of all sizes, largest repeat of a document.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Documents moved through the null space together; leftovers of so many groups meet in the next level.
CHUNK = 4096
FAN_IN = 512
_EPS = 1e-9


def source_targets(sized: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """``(source, n, source_size, rank, target)``; targets stop at ``most`` times the size, the excess is reshared by weight.

    Sources are ranked over range partitions and counts of these, and the common level of the targets is found by repeated
    sums over the source table, so no task holds all sources.
    """
    sums = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").cast("long").alias("source_size"))
    ranged = settle(sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()), "mix-sources")
    before = ranged.groupBy("_part").agg(F.count("*").alias("c")).withColumn(
        "_before", F.sum("c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last()))
    ranked = ranged.withColumn("_in", inside).join(F.broadcast(before.select("_part", "_before")), "_part")
    ranked = ranked.withColumn("rank", (F.coalesce("_before", F.lit(0)) + F.col("_in") - 1).cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = settle(ranked.select("source", "n", "source_size", "rank", weight.alias("weight")), "mix-ranks")
    cap = F.col("source_size") * float(most)
    level, held = 0.0, None
    while True:
        full = cap < F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("source_size"))).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("free"),
        ).first()
        if not row["all"] or not row["free"] or row["held"] == held and level:
            break
        held = row["held"]
        level = (share * row["all"] - most * (held or 0)) / row["free"]
    return ranked.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _uniform(rng):
    while True:
        yield from rng.random(4096).tolist()


def flight(size, pi, seed, land=False):
    """Final or still fractional probabilities after moving ``pi`` with the sums of (size, 1) held.

    Three fractional documents have one direction that changes neither the total size nor the total count: the cross
    product of their sizes with ones. A step goes along it, one way or the other with the chances that keep every
    expectation, until one of the three is 0 or 1; the next document takes its place. At most two documents, or one
    size value, stay fractional. ``land`` decides these: the outcome whose total size is nearest, then whose count is.
    """
    p, size = [float(x) for x in pi], [float(x) for x in size]
    draw = _uniform(np.random.default_rng(seed))

    def move(units, direction):
        up = min(((1 - p[k]) / d if d > 0 else p[k] / -d) for k, d in zip(units, direction) if d)
        down = min((p[k] / d if d > 0 else (1 - p[k]) / -d) for k, d in zip(units, direction) if d)
        step = up if next(draw) * (up + down) < down else -down
        for k, d in zip(units, direction):
            value = p[k] + step * d
            p[k] = 0.0 if value < _EPS else 1.0 if value > 1 - _EPS else value

    live = []
    for k in range(len(p)):
        if not _EPS < p[k] < 1 - _EPS:
            p[k] = float(round(p[k]))
            continue
        live.append(k)
        if len(live) == 3:
            a, b, c = (size[x] for x in live)
            scale = max(a, b, c)
            direction = (1.0, -1.0, 0.0) if a == b == c else ((b - c) / scale, (c - a) / scale, (a - b) / scale)
            move(live, direction)
            live = [x for x in live if 0 < p[x] < 1]
    if len(live) == 2 and size[live[0]] == size[live[1]]:
        move(live, (1.0, -1.0))
        live = [x for x in live if 0 < p[x] < 1]
    if land and live:
        outcomes = [dict(zip(live, x)) for x in product((0.0, 1.0), repeat=len(live))]
        off = lambda x: (abs(sum(size[k] * (v - p[k]) for k, v in x.items())), abs(sum(v - p[k] for k, v in x.items())))
        for k, v in min(outcomes, key=off).items():
            p[k] = v
    return p


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, most=MOST, seed=7) -> DataFrame:
    """``(id, row_hash, source, size, source_size, target, copies, taken)`` for every row.

    A source that takes ``rate`` times its size gives every document ``floor(rate)`` whole copies and one more by cube
    sampling with probability ``rate - floor(rate)``. Documents of a source are dealt by hash to groups of about ``CHUNK``;
    each group keeps at most two fractional documents, and these meet in the next level, until one group per source is left
    and lands. So a source of any size is balanced without ever being gathered.

    Null or blank texts have size 0. A null source is a source. Equal rows are told apart by nothing and may be swapped.
    An empty table gives no rows.
    """
    sized = settle(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col), F.col(source_col)).alias("row_hash"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ), "mix-sizes")
    targets = settle(source_targets(sized, weights, share, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets.withColumn("base", F.floor(rate + _EPS).cast("int")).withColumn("pi", F.greatest(rate - F.floor(rate + _EPS), F.lit(0.0)))
    plan = plan.withColumn("groups", F.ceil(F.col("n") / CHUNK).cast("long"))
    rows = sized.alias("d").join(plan.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select("d.*", "rank", "base", "pi", "groups")
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("row_hash", F.lit(seed)), F.col("groups")))
    schema = "id {}, row_hash long, size long, rank long, base int, chunk long, pi double".format(sized.schema["id"].dataType.simpleString())
    most_groups = plan.agg(F.max("groups")).first()[0] or 0

    def level_of(number, last):
        def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
            # the last documents are those that stay fractional, so the smallest come last
            pdf = pdf.sort_values(["size", "row_hash"], ascending=[False, True], kind="stable")
            return pdf.assign(pi=flight(pdf["size"], pdf["pi"], [seed, number, int(key[0]), int(key[1])], last))
        return run

    done, number, state = None, 0, rows.select("id", "row_hash", "size", "rank", "base", "chunk", "pi")
    while True:
        last = most_groups <= 1
        state = settle(state.groupBy("rank", "chunk").applyInPandas(level_of(number, last), schema), "mix-level")
        decided = state if last else state.where("pi <= 0 OR pi >= 1")
        done = decided if done is None else done.unionByName(decided)
        if last:
            break
        state = state.where("pi > 0 AND pi < 1").withColumn("chunk", F.floor(F.col("chunk") / FAN_IN).cast("long"))
        most_groups = -(-most_groups // FAN_IN)
        number += 1
    copies = F.col("base") + F.col("pi").cast("int")
    return done.alias("r").join(targets.alias("t"), "rank").select(
        F.col("id").alias(id_col), "row_hash", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def apply_mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **options) -> DataFrame:
    """The documents with their copies: none, one or several rows each, all columns kept."""
    taken = mix(docs, id_col, text_col, source_col, **options)
    key, copies, n, at = free_names(docs.columns, "_mix_key", "_mix_copies", "_mix_rows", "_mix_at")
    held = taken.groupBy(F.col("row_hash").alias(key)).agg(F.sum("copies").alias(copies), F.count("*").alias(n))
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col), F.col(source_col))).join(settle(held, "mix-held"), key)
    alone = keyed.where(F.col(n) == 1).drop(n)
    same = keyed.where(F.col(n) > 1).withColumn(at, F.row_number().over(Window.partitionBy(key).orderBy(copies)))
    split = F.floor(F.col(copies) / F.col(n)) + (F.col(at) <= F.col(copies) % F.col(n)).cast("int")
    same = same.withColumn(copies, split.cast("long")).drop(n, at)
    rows = alone.unionByName(same).where(F.col(copies) > 0)
    return rows.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
