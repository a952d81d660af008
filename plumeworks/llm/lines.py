"""Near-duplicate line removal by a deletion-neighbourhood join."""

from pyspark.sql import DataFrame, Window, functions as F

from plumeworks.llm.common import bound, free_names, settle, small_side

#: Lines of at least so many characters (code points, without outer white space) that are up to one edit apart are duplicates.
#: Shorter ones are duplicates only if they are equal: one edit turns ``1.`` into ``2.`` and one name into another.
MIN_CHARS = 16
_SPACE = " \t\r\f\u000b"


def line_rows(docs: DataFrame, id_col="doc_id", text_col="text", least_chars=1) -> DataFrame:
    """``(doc, pos, line, h, g)``: the trimmed lines that take part, with two hashes that together name the line."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "raw"))
    rows = rows.select("doc", "pos", F.btrim("raw", F.lit(_SPACE)).alias("line")).where(F.length("line") >= least_chars)
    return rows.withColumns({"h": F.xxhash64("line"), "g": F.crc32(F.col("line").cast("binary")) * F.lit(1 << 20) + F.length("line") % F.lit(1 << 20)})


def _halves(line):
    """Hashes of the first and last half of a line, once as one of its own length and once as the longer of a pair.

    One edit leaves the first or the last half of the shorter line as it was, so lines one edit apart share one of these.
    """
    n = F.length(line)
    return F.array(*[F.xxhash64(F.lit(side), size, part(line, F.floor(size / 2).cast("int"))) for size in (n, n - 1) for side, part in ((0, F.left), (1, F.right))])


def near_lines(rows: DataFrame) -> DataFrame:
    """``(h, g)`` of the lines that are one edit from a line first seen earlier, from :func:`line_rows`.

    Lines that share no half with another line cannot have a partner and emit nothing. The others emit the line without each of
    its characters, and the whole line, as hashed keys. Two lines that are equal without the character at the same place differ by
    one replacement, so only the earliest of such a group matters; a line equal to a longer one without a character is paired
    with it. Pairs are verified by edit distance. The hash of a deletion is the exclusive or of the hashes of the characters
    at their places, those behind it moved by one, so all deletions of a line take one pass over it, however long it is.
    """
    halves = rows.select("h", F.explode(_halves(F.col("line"))).alias("half"))
    shared = settle(halves.groupBy("half").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("half"), "line-halves")
    marked = rows.select("doc", "pos", "h", "g", "line", F.explode(_halves(F.col("line"))).alias("half"))
    held = marked.join(small_side(shared), "half", "left_semi")
    lines = settle(held.groupBy("h", "g").agg(F.min(F.struct("doc", "pos")).alias("first"), F.first("line").alias("line")), "line-candidates")
    chars = lines.select("h", "g", "first", F.posexplode(F.regexp_extract_all("line", F.lit("(?s)(.)"), F.lit(1))).alias("at", "c"))
    kept, moved = F.xxhash64("c", "at"), F.xxhash64("c", F.col("at") - 1)
    own = Window.partitionBy("h", "g")
    upto = own.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = chars.withColumns({"kept": kept, "moved": moved}).withColumns({
        "before": F.bit_xor("kept").over(upto).bitwiseXOR(F.col("kept")),
        "behind": F.bit_xor("moved").over(own).bitwiseXOR(F.bit_xor("moved").over(upto)),
    })
    variants = settle(run.select("h", "g", "first", "at", F.col("before").bitwiseXOR(F.col("behind")).alias("variant")), "line-variants")
    whole = lines.select("h", "g", "first", F.expr("aggregate(transform(regexp_extract_all(line, '(?s)(.)', 1), (c, i) -> xxhash64(c, i)), 0L, (a, x) -> a ^ x)").alias("variant"))
    groups = variants.groupBy("variant", "at").agg(F.min("first").alias("partner"), F.max("first").alias("top")).where("partner < top").drop("top")
    replaced = variants.join(groups, ["variant", "at"]).where("partner < first").select("first", "partner")
    grown = variants.select("variant", F.col("first").alias("long")).join(whole.select("variant", F.col("first").alias("short")), "variant")
    grown = grown.select(F.greatest("long", "short").alias("first"), F.least("long", "short").alias("partner")).where("partner < first")
    pairs = replaced.unionByName(grown).distinct()
    both = pairs.join(lines.select("first", "h", "g", "line"), "first").join(lines.select(F.col("first").alias("partner"), F.col("line").alias("other")), "partner")
    return both.where(F.levenshtein("line", "other", 1).between(0, 1)).select("h", "g").distinct()


def removed_lines(docs: DataFrame, id_col="doc_id", text_col="text", min_chars=MIN_CHARS, least_chars=1) -> DataFrame:
    """``(doc, gone)``: the positions of the lines that an equal line or one within an edit comes before, by (id, position).

    Rows that share an id count as one document: a line's place is its id and position.
    """
    rows = line_rows(docs, id_col, text_col, least_chars)
    firsts = rows.groupBy("h", "g").agg(F.min(F.struct("doc", "pos")).alias("first"), F.max(F.struct("doc", "pos")).alias("last"))
    near = settle(near_lines(rows.where(F.length("line") >= min_chars)), "line-near").withColumn("near", F.lit(True))
    again = firsts.join(near, ["h", "g"], "left").where("near OR first < last").select("h", "g", "first", F.coalesce("near", F.lit(False)).alias("near"))
    again = settle(again, "line-again")
    places = rows.select("doc", "pos", "h", "g").join(small_side(again), ["h", "g"]).where("near OR doc <> first.doc OR pos <> first.pos")
    return places.groupBy("doc").agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def _without(text, gone):
    """The text without the lines at the positions ``gone``, in order: the stretches between them, each copied once."""
    def cut(lines):
        starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda g: g + 1))
        ends = F.concat(gone, F.array(F.size(lines)))
        return F.array_join(F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a))), "\n")

    return bound(F.split(text, "\n", -1), cut)


def dedup_lines(docs: DataFrame, id_col="doc_id", text_col="text", min_chars=MIN_CHARS, count_col="lines_removed", least_chars=1) -> DataFrame:
    """All columns of ``docs``, the text without its duplicate lines, and how many lines went.

    A line goes if an equal line, or one that a single inserted, deleted or replaced character makes equal, occurs earlier in
    the order of id and position; outer white space does not count. Lines of fewer than ``min_chars`` characters go only if they
    are equal to an earlier one; blank lines and those of fewer than ``least_chars`` stay.
    What stays is unchanged. Rows with a null id or text are unchanged; an empty table gives no rows. A column that has the name
    of the count is replaced. A text takes time in proportion to its length, however many lines it has or loses.
    """
    doc, lost = free_names([*docs.columns, count_col], "_line_doc", "_line_gone")
    gone = removed_lines(docs, id_col, text_col, min_chars, least_chars).select(F.col("doc").alias(doc), F.col("gone").alias(lost))
    joined = docs.drop(count_col).join(gone, F.col(f"`{id_col}`") == F.col(doc), "left")
    text = F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(_without(F.col(text_col), F.col(lost)))
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != count_col]
    return joined.select(*columns, F.coalesce(F.size(lost), F.lit(0)).cast("long").alias(count_col))
