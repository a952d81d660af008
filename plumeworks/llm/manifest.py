"""Merkle manifest of a table: leaves, group roots, a table root and a proof for every row.

Rows get their rank within their group; the rank is a number whose digits to base ``ARITY`` are the path from the root. Blocks of
``ARITY ** DIGITS`` consecutive rows are grouped ``DIGITS`` times, once for each digit from the last, each time nesting what was
grouped before as structs with their hash; all of these share the one shuffle by block. A nested transform then hands every row the
siblings on its path. Block roots form the next, smaller table, and so on; what it says of a block is joined per block, not per row.
"""

from pyspark.sql import DataFrame, Window, functions as F

from plumeworks.session import settle

ARITY, DIGITS = 3, 5
BLOCK = ARITY**DIGITS
_STEPS = "array<struct<left:string,right:string>>"


def hashed(text):
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(columns):
    """Hash of values in order: ``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    return hashed(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def ranked(rows: DataFrame, order, label: str) -> DataFrame:
    """``rows`` with ``r``, the place within ``g`` by ``order``, and ``n``, the rows of ``g``. Ranges of all rows are sorted apart and
    counted per range and group, so a group of any size is ranked without being gathered."""
    placed = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order).withColumn("at", F.monotonically_increasing_id())
    placed = settle(placed.withColumn("part", F.shiftright("at", 33)), label)
    runs = placed.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    own = Window.partitionBy("g")
    before = F.coalesce(F.sum("c").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = settle(runs.select("g", "part", "first", before.alias("before"), F.sum("c").over(own).alias("n")), f"{label}-runs")
    return placed.join(runs, ["g", "part"]).withColumn("r", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def _live(level):
    """Whether nodes of the level below are still several, so that this level exists."""
    return F.col("n") > ARITY ** (level - 1)


def blocks_of(nodes: DataFrame) -> DataFrame:
    """``(g, block, n, h, kids)`` from nodes ``(g, r, n, h, item)``: every block as one nested struct with its root hash."""
    nodes = nodes.select("g", "n", "h", "item", "r", F.floor(F.col("r") / BLOCK).alias("block")).repartition("g", "block")
    inner = "item"
    for level in range(1, DIGITS + 1):
        kid = F.struct((F.col("r") % ARITY).alias("digit"), "h", inner)
        nodes = nodes.groupBy("g", "block", "n", F.floor(F.col("r") / ARITY).alias("r")).agg(F.array_sort(F.collect_list(kid)).alias("kids"))
        joined = hashed(F.array_join(F.transform("kids", lambda k: k["h"]), ""))
        nodes = nodes.withColumn("h", F.when(_live(level), joined).otherwise(F.col("kids")[0]["h"]))
        inner = "kids"
    return nodes.select("g", "block", "n", "h", "kids")


def _paths(kids, level):
    """An array of ``(item, steps)`` for all rows below ``kids``; a step holds the siblings left and right of the path."""
    hashes = F.transform(kids, lambda k: k["h"])

    def below(kid, i):
        step = F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"), F.array_join(F.slice(hashes, i + 2, F.lit(ARITY)), "").alias("right"))
        own = F.when(_live(level), F.array(step)).otherwise(F.array().cast(_STEPS))
        if level == 1:
            return F.array(F.struct(kid["item"].alias("item"), own.alias("steps")))
        return F.transform(_paths(kid["kids"], level - 1), lambda p: F.struct(p["item"].alias("item"), F.concat(p["steps"], own).alias("steps")))

    return F.flatten(F.transform(kids, below))


def tree(nodes: DataFrame, label: str) -> DataFrame:
    """``(g, block, n, kids, above, root)``: every block with the steps from its root to that of its group."""
    blocks = settle(blocks_of(nodes), label)
    if (blocks.agg(F.max("n")).first()[0] or 0) <= BLOCK:
        return blocks.select("g", "block", "n", "kids", F.array().cast(_STEPS).alias("above"), F.col("h").alias("root"))
    upper = blocks.select("g", F.col("block").alias("r"), F.ceil(F.col("n") / BLOCK).alias("n"), "h", F.struct(F.col("block").alias("block")).alias("item"))
    upper = settle(proofs(tree(upper, label)).select("g", F.col("item.block").alias("block"), F.col("steps").alias("above"), "root"), f"{label}-tops")
    return blocks.join(upper, ["g", "block"]).select("g", "block", "n", "kids", "above", "root")


def proofs(blocks: DataFrame, *others) -> DataFrame:
    """``(g, item, steps, root)`` of every row of the blocks, and ``others`` of their columns."""
    paths = blocks.select("g", "root", "above", *others, F.explode(_paths(F.col("kids"), DIGITS)).alias("p"))
    return paths.select("g", "root", *others, "p.item", F.concat("p.steps", "above").alias("steps"))


def fold(leaf, steps):
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(steps, leaf, lambda h, s: hashed(F.concat(s["left"], h, s["right"])))


def manifest(rows: DataFrame, columns, group_col="source", order_col="doc_id", tampered: dict | None = None) -> DataFrame:
    """``(order_col, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every row.

    A leaf is the hash of the listed columns. Within a group leaves ascend by ``order_col`` (null first); rows of one value follow by
    leaf, so equal rows may be swapped. While several nodes remain, every ``ARITY`` in a row become their hash, fewer at the end
    too. Group roots, by group (null first, bytewise), likewise give ``root``. ``tampered`` maps columns to expressions: ``folded_root``
    is recomputed from the leaf of these and the untampered siblings, and is ``verified`` if it is the root.

    Nulls are told from empty texts by the leaf. An empty table gives no rows. Other columns, whatever their names, are not read.
    """
    def leaf(change):
        return leaf_hash([change.get(c, F.col(c)) for c in columns])

    group = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    own, other = leaf({}), leaf(tampered or {})
    leaves = rows.select(group.alias("g"), F.col(order_col).alias("key"), own.alias("h"), F.when(own != other, other).alias("t"))
    placed = ranked(settle(leaves, "manifest-leaves"), ["key", "h"], "manifest-ranks")
    blocks = tree(placed.select("g", "r", "n", "h", F.struct("key", F.col("h").alias("leaf"), "t").alias("item")), "manifest-blocks")
    groups = blocks.where("block = 0").select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("root").alias("h"))
    groups = ranked(groups, ["name"], "manifest-groups").select("g", "r", "n", "h", F.struct("name").alias("item"))
    tops = proofs(tree(groups, "manifest-top")).select(F.col("item.name").alias("g"), F.col("steps").alias("high"), F.col("root").alias("top"))
    found = proofs(blocks.join(settle(tops, "manifest-roots"), "g"), "high", "top")
    steps = F.concat("steps", "high")
    found = found.select("item.*", F.col("root").alias("subroot"), F.col("top").alias("root"), steps.alias("steps"))
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    found = found.withColumn("folded_root", fold(F.coalesce("t", "leaf"), F.col("steps")))
    return found.select(
        F.col("key").alias(order_col), "leaf", "subroot", "root", hashed(siblings).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
