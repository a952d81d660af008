"""Secret scans with a ledger of the blobs and rule versions already scanned."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumeworks.llm.common import bound, settle
from plumeworks.session import work_folder

#: Rules by kind, in the order in which spans at one place are listed: version, pattern, group measured and its least length.
#: The first three are the base; "private" and "bearer" are added.
RULES = {
    "assign": (1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (1, r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (1, r"[0-9a-f]{16,}", 0, 16),
    "private": (1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    "bearer": (1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
}
BASE = ("assign", "access", "hex")
#: Matches whose spans are collected at once.
CHUNK = 256


def spans_of(text, pattern: str, group: int, least: int):
    """Start and end (exclusive, in code points) of the matches whose group is long enough, in order.

    The text is split at the matches; a match starts after the gaps and matches before it. Built-in functions only. Spans are
    collected in chunks, as growing one array by each of many thousands of matches would copy it as often.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("hit"), measured.alias("part")), lambda x: F.struct(
        F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["part"]).alias("part")))
    none = F.array().cast("array<struct<s:int,e:int>>")

    def add(acc, x):
        s = acc["at"] + x["gap"]
        span = F.array(F.struct(s.alias("s"), (s + x["hit"]).alias("e")))
        return F.struct((s + x["hit"]).alias("at"), F.when(x["part"] >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def in_chunks(steps):
        def add_chunk(acc, c):
            own = F.aggregate(F.slice(steps, c * CHUNK + 1, F.lit(CHUNK)), F.struct(acc["at"].alias("at"), none.alias("out")), add)
            return bound(own, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], r["out"]).alias("out")))

        chunks = F.sequence(F.lit(0), F.floor(F.size(steps) / CHUNK).cast("int"))
        return F.aggregate(chunks, F.struct(F.lit(0).alias("at"), none.alias("out")), add_chunk, lambda acc: acc["out"])

    return bound(steps, in_chunks)


def content_address(versions: DataFrame, path_cols, text_col="text") -> DataFrame:
    """The path columns of every version, as ``_path_0`` and so on, with the ``blob`` (sha256) its text has; a null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return versions.select(*[F.col(f"`{c}`").alias(f"_path_{i}") for i, c in enumerate(path_cols)], F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("_text"))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """``(blob, kind, version, spans)`` of every pair scanned so far; nothing if the ledger is new."""
    try:
        return spark.read.schema("blob string, kind string, version int, spans array<struct<s:int,e:int>>").parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "blob string, kind string, version int, spans array<struct<s:int,e:int>>")


def update_ledger(versions: DataFrame, folder: str, text_col="text", rules=RULES) -> int:
    """Scans what the ledger lacks and appends it; returns the number of (blob, rule) pairs scanned.

    Versions are content-addressed and each distinct blob is kept once. Pairs of a blob and a rule version found in the
    ledger are not scanned; a raised version scans that rule anew over all blobs. Pairs without findings are recorded too.
    """
    spark = versions.sparkSession
    known = read_ledger(spark, folder).where(
        F.concat_ws(":", "kind", "version").isin([f"{k}:{r[0]}" for k, r in rules.items()])
    ).groupBy("blob").agg(F.collect_set("kind").alias("known"))
    addressed = content_address(versions, [], text_col)
    blobs = addressed.groupBy("blob").agg(F.first("_text").alias("text"))
    rows = blobs.join(known, "blob", "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
    scans = F.array(*[
        F.when(~F.array_contains("known", kind), F.struct(
            F.lit(kind).alias("kind"), F.lit(version).alias("version"),
            F.when(F.col("text").rlike(pattern), spans_of(F.col("text"), pattern, group, least)).otherwise(F.array().cast("array<struct<s:int,e:int>>")).alias("spans")))
        for kind, (version, pattern, group, least) in rules.items()
    ])
    fresh = rows.select("blob", F.explode(F.array_compact(scans)).alias("f")).select("blob", "f.kind", "f.version", "f.spans")
    staged = settle(fresh, "ledger-new")
    staged.write.mode("append").parquet(folder)
    return staged.count()


def findings(spark: SparkSession, folder: str, rules=RULES) -> DataFrame:
    """``(blob, spans)`` with the findings of the current rule versions: ``(s, k, e)`` ordered by start, then rule order.

    A pair that the ledger holds more than once, from two runs at a time or a repeated append, counts once.
    """
    kinds = list(rules)
    order = F.element_at(F.create_map(*[x for k, kind in enumerate(kinds) for x in (F.lit(kind), F.lit(k))]), F.col("kind"))
    rows = read_ledger(spark, folder).where(F.concat_ws(":", "kind", "version").isin([f"{k}:{r[0]}" for k, r in rules.items()]) & (F.size("spans") > 0))
    rows = rows.dropDuplicates(["blob", "kind", "version"])
    spans = F.transform("spans", lambda x: F.struct(x["s"].alias("s"), order.alias("k"), x["e"].alias("e")))
    return rows.select("blob", spans.alias("spans")).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def scan(versions: DataFrame, path_cols=("doc_id",), text_col="text", ledger: str | None = None, rules=RULES) -> DataFrame:
    """The path columns of every version with ``spans``: an ordered array of ``(s, k, e)``, ``k`` being the rule's place in ``rules``.

    ``ledger`` is a folder that lasts between runs; without one a fresh ledger is kept in the shared work folder. Null texts
    are empty; repeated rows are returned each; an empty table gives no rows. A path column named ``spans`` is left out.
    """
    spark = versions.sparkSession
    ledger = ledger or work_folder(spark, "ledger")
    update_ledger(versions, ledger, text_col, rules)
    paths = content_address(versions, path_cols, text_col).drop("_text")
    found = settle(findings(spark, ledger, rules), "findings")
    empty = F.array().cast("array<struct<s:int,k:int,e:int>>")
    named = [F.col(f"_path_{i}").alias(c) for i, c in enumerate(path_cols) if c != "spans"]
    return paths.join(found, "blob", "left").select(*named, F.coalesce("spans", empty).alias("spans"))


def listed(spans, rules=RULES):
    """Spans as ``kind:start:end``, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in rules])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"], x["e"])), ",")


def digest(found: DataFrame, rules=RULES, base=BASE) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text."""
    place = {kind: k for k, kind in enumerate(rules)}
    own = F.filter("spans", lambda x: x["k"].isin([place[k] for k in base]))


    def count_of(kind):
        return F.size(F.filter("spans", lambda x: x["k"] == place[kind])).cast("long").alias(f"n_{kind}")

    counts = [count_of(kind) for kind in base]
    paths = [F.col(c) for c in found.columns if c != "spans"]
    return found.select(*paths, *counts, F.sha2(listed(own, rules).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans"), rules).alias("spans"))
