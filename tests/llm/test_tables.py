"""The operators on small tables with nulls, empty texts, repeated rows, ties and no rows at all."""

import math
import random
import time

import corpus_pipeline
import pytest
from pyspark.sql import GroupedData, functions as F

from plumeworks.llm import cover_tree, hamming, language, lines, minhash, mixing, packing, pages, secret_scan, token_files
from plumeworks.llm.common import importable
from plumeworks.session import work_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos long, u long"
BASE = " ".join(f"word{k}" for k in range(60))
ROWS = [
    (1, BASE + "\nA line that is repeated here", "en", "a", 1, 0, 0),
    (2, BASE + "\nA line that is repeated herE", "en", "a", 1, 0, 0),
    (3, BASE.replace("word30", "other") + "\nAnother line, token = abcdefghijkl12", "en", None, 1, 0, 0),
    (4, None, None, "b", None, 0, 0),
    (5, "", "en", "b", 0, 0, 0),
    (6, "12 34", "de", "b", 5, 0, 0),
    (7, "ein ganz anderer kurzer Text", "de", "b", 5, 0, 0),
    (7, "ein ganz anderer kurzer Text", "de", "b", 5, 0, 0),
]


@pytest.fixture
def docs(spark):
    importable(spark)
    return spark.createDataFrame(ROWS, SCHEMA)


def test_line_dedup(docs):
    rows = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    assert rows[1]["lines_removed"] == 0 and rows[2]["text"] == "" and rows[2]["lines_removed"] == 2
    assert rows[4]["text"] is None and rows[3]["lines_removed"] == 0 and rows[7]["lines_removed"] == 0


def test_near_duplicates(docs):
    rows = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert rows[1] == rows[2] == 1 and rows[4] == 4 and rows[5] == 5 and rows[7] == 7
    assert sorted(r["doc_id"] for r in minhash.drop_near_duplicates(docs).collect()) == sorted({r[0] for r in ROWS} - {d for d, c in rows.items() if d != c})


def test_secret_ledger_scans_only_what_is_new(docs):
    folder = work_folder(docs.sparkSession, "ledger-test")
    assert secret_scan.update_ledger(docs, folder) == 6 * len(secret_scan.RULES)
    assert secret_scan.update_ledger(docs, folder) == 0
    version, *rest = secret_scan.RULES["hex"]
    assert secret_scan.update_ledger(docs, folder, rules=secret_scan.RULES | {"hex": (version + 1, *rest)}) == 6
    rows = {r["doc_id"]: r for r in secret_scan.digest(secret_scan.scan(docs, ledger=folder)).collect()}
    at = ROWS[2][1].index("token")
    assert rows[3]["spans"] == f"assign:{at}:{at + 22}" and rows[3]["n_assign"] == 1 and rows[4]["spans"] == ""


def test_packing_and_token_files(docs):
    pieces = packing.pack(docs).collect()
    assert len(pieces) == len(ROWS) and {r["doc_id"] for r in pieces} == {r[0] for r in ROWS}
    folder = work_folder(docs.sparkSession, "tokens-test")
    token_files.write_token_files(docs, folder)
    rows = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in token_files.read_token_files(docs.sparkSession, folder).collect())
    assert [d for _, d, _ in rows] == [r[0] for r in ROWS]
    assert [s for s, _, _ in rows] == [sum(n for _, _, n in rows[:k]) for k in range(len(rows))]


def test_mix_and_language(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(r["taken"] <= 2 * r["size"] for r in rows)
    assert mixing.apply_mix(docs).columns == docs.columns
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()}
    assert found[4] == found[5] == found[6] == "und" and found[7] != "und"


def test_columns_with_the_names_that_are_used_inside(docs):
    """Any further column comes back as it was."""
    named = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(("_gone", "_again", "_nth", "_line_gone", "_line_doc", "_mix_key", "_mix_copies", "_mix_rows", "_lines_removed", "blob", "spans"))])
    for made in (minhash.drop_near_duplicates(named), mixing.apply_mix(named), lines.dedup_lines(named, count_col="n_gone").drop("n_gone"), corpus_pipeline.drop_repeated_lines(docs.sparkSession, named, "")):
        assert made.columns == named.columns and made.select(named.columns[-11:]).distinct().collect() == [tuple(range(11))]
    found = secret_scan.scan(named, path_cols=("doc_id", "blob", "spans"))
    assert found.columns == ["doc_id", "blob", "spans"] and {r["blob"] for r in found.collect()} == {9}


def test_a_ledger_with_repeated_rows_counts_once(docs):
    """Two runs at a time, or one repeated after a lost driver, append the same pairs."""
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "ledger-twice")
    secret_scan.update_ledger(docs, folder)
    spark.read.parquet(folder).write.parquet(copy := work_folder(spark, "ledger-copy"))
    spark.read.parquet(copy).write.mode("append").parquet(folder)
    rows = {r["doc_id"]: r for r in secret_scan.digest(secret_scan.scan(docs, ledger=folder)).collect()}
    at = ROWS[2][1].index("token")
    assert rows[3]["n_assign"] == 1 and rows[3]["spans"] == f"assign:{at}:{at + 22}"


def test_many_lines_and_findings_in_one_text(spark):
    """Time grows with the length of a text: 50,000 lines, of which half go, and 50,000 findings."""
    importable(spark)
    body = "\n".join(f"line number {k // 2}" for k in range(50_000))
    hexes = " ".join(f"{k:016x}" for k in range(50_000))
    docs = spark.createDataFrame([(1, body), (2, hexes)], "doc_id long, text string")
    start = time.time()
    cut = {r["doc_id"]: r for r in lines.dedup_lines(docs.where("doc_id = 1"), min_chars=100).collect()}
    assert cut[1]["lines_removed"] == 25_000 and cut[1]["text"] == "\n".join(f"line number {k}" for k in range(25_000))
    found = secret_scan.digest(secret_scan.scan(docs)).where("doc_id = 2").first()
    assert found["n_hex"] == 50_000 and found["spans"].startswith("hex:0:16,hex:17:33,") and found["spans"].endswith(f"hex:{17 * 49_999}:{17 * 50_000 - 1}")
    assert time.time() - start < 90


def test_hamming_search_of_long_and_broken_vectors(spark):
    """128 components, shorter ones, ties and vectors without a code against a scan."""
    importable(spark)
    rng = random.Random(6)
    vectors = [[rng.choice([-1.0, 1.0, 0.0]) for _ in range(128)] for _ in range(60)] + [[1.0] * 5, [-1.0] * 70, []]
    vectors += [v[:100] + [-x for x in v[100:]] for v in vectors[:20]] + [vectors[0]]
    rows = [(k, v) for k, v in enumerate(vectors)] + [(900, None), (901, [None, 1.0]), (902, [float("nan")]), (None, [1.0])]
    got = {}
    for r in hamming.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0, k=4, row_block=16, query_block=2).collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["id"]))
    bits = {k: {i for i, x in enumerate(v) if x > 0} for k, v in enumerate(vectors)}
    assert {k: sorted(v) for k, v in got.items()} == {q: sorted((len(bits[q] ^ bits[k]), k) for k in bits if k != q)[:4] for q in bits if q % 20 == 0}


def test_embeddings(spark):
    importable(spark)
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.99, 0.1]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [None, 1.0]), (8, [float("nan"), 1.0]), (9, [1.0])]
    found = cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert all(got[k] == (0, k, True) for k in (4, 5, 6, 7, 8, 9))


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [0.0])]])
def test_tables_without_a_vector_to_compare(spark, rows):
    importable(spark)
    found = cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, found.collect())) == [(k, 0, k, True) for k, _ in rows]


def test_vectors_are_dealt_once_however_many_blocks_and_waves(spark, monkeypatch):
    """25 blocks, four of which are sent at a time, against all pairs; several cells, equal vectors, and one of another dimension."""
    importable(spark)
    rng = random.Random(3)
    heads = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(30)]
    vectors = [[x + rng.gauss(0, 0.15) for x in rng.choice(heads)] for _ in range(398)]
    vectors += [vectors[0], [1.0, 2.0]]
    dealt, real = [], GroupedData.applyInPandas
    monkeypatch.setattr(GroupedData, "applyInPandas", lambda self, *a: dealt.append(self._df.count()) or real(self, *a))
    monkeypatch.setattr(cover_tree, "WAVE_BYTES", 4 * 16 * 8 * 8, raising=False)
    found = cover_tree.near_duplicates(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"), block=16)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()}
    unit = [[x / math.sqrt(sum(y * y for y in v)) for x in v] for v in vectors]
    near = {k: [m for m, b in enumerate(unit) if m != k and len(a) == len(b) and sum(x * y for x, y in zip(a, b)) >= cover_tree.THRESHOLD] for k, a in enumerate(unit)}
    least = {}
    for k in near:
        reached = [k] if k not in least else []
        while reached:
            m = reached.pop()
            if m not in least:
                least[m] = k
                reached += near[m]
    assert got == {k: (len(near[k]), least[k], least[k] == k) for k in near}
    assert 40 < len(set(least.values())) or max(map(len, near.values())) > 5
    assert dealt == [399]


def test_empty_tables(docs):
    none = docs.where(F.lit(False))
    for made in (lines.dedup_lines(none), minhash.near_duplicates(none), mixing.mix(none), packing.pack(none), language.identify(none), secret_scan.scan(none)):
        assert made.count() == 0
    assert pages.extract(none.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html"))).count() == 0


def test_short_lines_that_repeat_go(spark):
    """Equal lines of any length go, in the stage too; one edit makes only longer ones equal."""
    importable(spark)
    texts = [(1, "And ornd.\n1.\n\nStteen Erachtz.\nStteen Erachtz."), (2, " And ornd.\n2.\n\nStteen Erachtx."), (3, "1.\n And ornd."), (4, "fresh")]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    want = {1: ("And ornd.\n1.\n\nStteen Erachtz.", 1), 2: ("2.\n\nStteen Erachtx.", 1), 3: ("", 2), 4: ("fresh", 0)}
    assert {r["doc_id"]: (r["text"], r["lines_removed"]) for r in lines.dedup_lines(docs).collect()} == want
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}
    assert kept == {k: (t, len(t)) for k, (t, _) in want.items() if t}
