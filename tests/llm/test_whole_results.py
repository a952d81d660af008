"""Results of whole operators on small tables against plain versions: token files, packing, mixing, near copies."""

import random
import zlib
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from plumeworks.llm import language, minhash, mixing, packing, token_files, tokens
from plumeworks.llm.common import importable
from plumeworks.session import work_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, start long, piece int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["alpha", "Beta,", "gamma-ray", "Straße", "x1", "\n", "the", "of", " ", "tokens!", "été"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 300))) for _ in range(60)]
    texts += ["word " * 1500, "a\n\n b  c " * 700, None, "", " ", "<|endoftext|> x", texts[3], "x" * 9000]
    return [(5 * k - 40, t, "en", rng.choice(["a", "b", None]), len(t or "")) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def encoded(rows):
    """Ids of every whole text and the end id, by the tokenizer alone."""
    t = tokens.tokenizer(tokens.default_path())
    return {k: [*t.encode(text or "", add_special_tokens=False).ids, tokens.END_ID] for k, text, *_ in rows}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("segment", [token_files.SEGMENT_IDS, 700])
def test_token_files_hold_the_ids_of_whole_texts(docs, rows, segment):
    """Also with segments shorter than a text, of 1,025 tokens and more."""
    folder = work_folder(docs.sparkSession, "tokens-whole")
    token_files.write_token_files(docs, folder, segment_ids=segment)
    got = sorted(map(tuple, token_files.digest(token_files.read_token_files(docs.sparkSession, folder)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    want, start = [], 0
    for k, ids in sorted(encoded(rows).items()):
        want.append((k, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want and max(n for _, _, n, _ in want) > 1024
    token_files.write_token_files(docs.where("false"), empty := work_folder(docs.sparkSession, "tokens-none"))
    assert token_files.read_token_files(docs.sparkSession, empty).count() == 0


def test_reading_token_files_shuffles_no_payload(docs, capsys):
    """The large tables' plan: nothing is broadcast for its size."""
    spark, key = docs.sparkSession, "spark.sql.autoBroadcastJoinThreshold"
    token_files.write_token_files(docs, folder := work_folder(spark, "tokens-plan"))
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        token_files.read_token_files(spark, folder).explain()
    finally:
        spark.conf.set(key, before)
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and "SortMergeJoin [part" not in plan.split("MapInArrow")[1].split("BroadcastExchange")[0]


def test_packing_places_every_piece_without_gaps(docs, rows):
    ids = encoded(rows)
    pieces = {}
    found = packing.pack(docs).collect()
    for r in found:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == ids.keys()
    for k, own in pieces.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and [r["length"] for r in own[1:]] == [1024] * (len(own) - 1)
        at = 0
        for r in own:
            part = ids[k][at : at + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == crc(part) and len(part) == r["length"] <= 1024
            at += r["length"]
        assert at == len(ids[k]) and (len(own) == 1) == (len(ids[k]) <= 1024)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [at for at, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024
    total = sum(map(len, ids.values()))
    assert len(sequences) <= 1.1 * -(-total // 1024) + 1
    assert packing.pack(docs.where("false")).columns == packing.pack(docs).columns


def test_packing_asks_for_small_arrow_batches(docs, monkeypatch):
    """Ten thousand whole texts of a batch are held by a task several times; the setting is put back."""
    conf, seen = docs.sparkSession.conf, {}
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    monkeypatch.setattr(packing, "settle", lambda df, label, own=packing.settle: (seen.update({label: int(conf.get(key))}), own(df, label))[1])
    packing.pack(docs)
    assert seen["pack-pieces"] <= 1000 and conf.get(key) == before


def test_language_and_near_copies_ask_for_small_arrow_batches(docs):
    """Their results are run by the caller, so the setting holds on; smaller values stay."""
    conf = docs.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    try:
        for size, most in ((10_000, 1000), (0, 1000), (50, 50)):
            for work in (lambda: corpus_pipeline.identify_language(docs.sparkSession, docs, ""), lambda: minhash.drop_near_duplicates(docs.limit(3))):
                conf.set(key, size)
                work()
                assert int(conf.get(key)) == most
    finally:
        conf.set(key, before)


def test_mix_meets_its_targets_and_repeats_itself(spark):
    """Targets by hand: weights 3, 1, 2 in order of the sources, at most twice a source, the excess reshared."""
    importable(spark)
    rng = random.Random(9)
    sources = {"a": 40, "b": 400, "c": 120, None: 60, "d": 1}
    rows = [(k, "w " * rng.randint(1, 60), s) for k, s in enumerate(s for s, n in sources.items() for _ in range(n))] + [(900, None, "b"), (901, "", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    size = {s: sum(len((t or "").split()) for _, t, own in rows if own == s) for s in sources}
    weight = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    full, total = set(), 1.5 * sum(size.values())
    while True:
        level = (total - sum(2 * size[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in weight if s not in full and weight[s] * level > 2 * size[s]}
        if not more:
            break
        full |= more
    for s in sources:
        own = [r for r in got if r["source"] == s]
        target = 2 * size[s] if s in full else weight[s] * level
        assert {round(r["target"], 6) for r in own} == {round(target, 6)} and {r["source_size"] for r in own} == {size[s]}
        assert abs(sum(r["taken"] for r in own) - target) <= 60
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=str)


def test_near_copies_equal_all_pairs(spark):
    """Documents of one base with more and more words changed, exact copies and short texts: classes of all pairs at 0.8."""
    importable(spark)
    rng = random.Random(10)
    texts = []
    for base in range(12):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([30, 120, 400]))]
        for changes in (0, 0, 1, 2, 3, 6, 12):
            own = list(words)
            for _ in range(changes):
                own[rng.randrange(len(own))] = f"new{rng.randint(0, 10**6)}"
            texts.append(" ".join(own))
    texts += ["one two", "one two", "", None, "one two three four five", "one two three four five six"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    component = list(range(len(texts)))

    def top(k):
        while component[k] != k:
            k = component[k]
        return k

    sets = [minhash.shingles(t) for t in texts]
    for i, j in combinations(range(len(texts)), 2):
        same = texts[i] and texts[i] == texts[j]
        if same or len(sets[i][0]) and len(sets[j][0]) and minhash.similarity(sets[i], sets[j]) >= minhash.SIMILARITY:
            a, b = sorted((top(i), top(j)))
            component[b] = a
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == {k: top(k) for k in range(len(texts))}
    assert len(set(got.values())) < len(texts) - 30


def test_held_out_languages_are_told(spark):
    """Two made-up languages of their own syllables, ties and repeated rows; the held-out fifth is never learned."""
    importable(spark)
    rng = random.Random(11)
    kinds = {"aa": ["ka", "mo", "ti", "ru"], "bb": ["sch", "ein", "ung", "wer"]}
    rows = [(k, " ".join("".join(rng.choices(kinds[lang], k=3)) for _ in range(20)), lang) for k in range(200) for lang in [rng.choice(["aa", "bb"])]]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("zz"))
    got = language.identify(docs).collect()
    want = {k: lang for k, _, lang in rows}
    assert len(got) == 201 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(r["lang_pred"] == want[r["doc_id"]] and 0 <= r["score"] <= 1 for r in got)
