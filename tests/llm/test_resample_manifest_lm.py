"""Importance resampling, the Merkle manifest and the language model against plain Python versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumeworks.llm import lm, manifest, mixer, resample
from plumeworks.llm.common import importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank string, score long, leaf string, h int, g string"


def docs_of(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    importable(spark)
    return spark.createDataFrame([(k, text, "en" if text else None, source, len(text or ""), "x", 0, "y", 1, "z") for k, text, source in rows], SCHEMA)


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gamma-ray", "Straße", "x1", "été", "data", "42", "the", "of"]
    return [" ".join(rng.choices(words, k=rng.randint(0, 60))) + rng.choice(["", "\n", ".\nend\n", "\t"]) for _ in range(n)]


# ------------------------------------------------------------------ resampling
def test_plane_sums_are_dot_products():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 3, (40, 700)) * rng.integers(0, 900, (40, 700)) ** 2
    counts[3] = 0
    for gains in (rng.integers(-9000, 7000, 700), np.zeros(700, np.int64), np.full(700, -1), np.arange(700)):
        assert (resample.plane_sums(counts, resample.gain_planes(gains)) == counts @ gains).all()


def test_features_of_pieces_equal_those_of_the_whole_text(monkeypatch):
    text = " ".join(texts(40)).encode()
    words = re.findall(rb"[0-9a-z\x80-\xff]+", text.lower())
    for longest in (1, 3):
        want = Counter(zlib.crc32(b" ".join(words[k : k + n])) for n in range(1, longest + 1) for k in range(len(words) - n + 1))
        for piece in (1 << 20, 50):
            monkeypatch.setattr(resample, "PIECE", piece)
            got = Counter(h for hashes, _ in resample.features(text, longest) for h in hashes.tolist())
            assert got == want and sum(n for _, n in resample.features(text, longest)) == len(words)


def plain_resample(docs, target, buckets, least, percent):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    def bucket(word):
        return zlib.crc32(word.encode()) % buckets

    raw, aim = Counter(bucket(w) for _, t in docs for w in words(t)), Counter(bucket(w) for t in target for w in words(t))
    total, aimed = float(sum(raw.values())), float(sum(aim.values()))
    out = []
    for k, text in docs:
        own = words(text)
        gains = [math.floor(1000 * math.log((aim[b] + 1.0) * (total + buckets) / ((raw[b] + 1.0) * (aimed + buckets)))) for b in map(bucket, own)]
        weight = sum(gains) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    live = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0]))
    for place, r in enumerate(live[: percent * len(live) // 100], 1):
        r[4] = place
    return sorted(map(tuple, out))


@pytest.mark.parametrize("percent", [0, 10, 100])
def test_resample_equals_plain_version(spark, percent):
    rows = [(k, t, "a") for k, t in enumerate(texts(300))] + [(1000, None, None), (1001, "", "b"), (1002, "... !\n", "b"), (1003, "word " * 5000, "b")]
    target = spark.createDataFrame([("alpha beta the x1 " * 9,), (None,), ("",)], "text string")
    got = resample.resample(docs_of(spark, rows), target, buckets=50, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == plain_resample([(k, t) for k, t, _ in rows], ["alpha beta the x1 " * 9], 50, 20, percent)


def test_resample_of_nulls_repeats_and_nothing(spark):
    text = "one two three " * 10
    docs = docs_of(spark, [(1, text, "a"), (1, text, "a"), (None, text, "a"), (2, text, None)])
    got = resample.resample(docs, docs.where("false"), percent=100).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3] and [r["score"] for r in got if r["doc_id"] is None] == [None]
    assert len({(r["weight"], r["score"]) for r in got if r["doc_id"] == 1}) == 1
    assert resample.resample(docs.where("false"), docs).count() == 0


# ------------------------------------------------------------------ manifest
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """Root, and for every leaf its (left, right) siblings level by level."""
    paths, nodes = [[] for _ in leaves], [(x, [i]) for i, x in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for k in range(0, len(nodes), 3):
            run = nodes[k : k + 3]
            for j, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append(("".join(x for x, _ in run[:j]), "".join(x for x, _ in run[j + 1 :])))
            above.append((h(*(x for x, _ in run)), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], paths


def plain_manifest(rows):
    """``{doc_id: (leaf, subroot, root, proof, folded root, verified)}``; rows are (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0])):
        groups.setdefault(row[1], []).append(row)
    trees = {source: plain_tree([plain_leaf(r) for r in own]) for source, own in groups.items()}
    root, tops = plain_tree([subroot for subroot, _ in trees.values()])
    out = {}
    for (source, own), top in zip(groups.items(), tops):
        subroot, paths = trees[source]
        for row, path in zip(own, paths):
            bad = row[-1] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            folded = plain_leaf((*row[:-1], row[-1].replace("\n", ""))) if bad else plain_leaf(row)
            for left, right in [*path, *top]:
                folded = h(left, folded, right)
            proof = h(*(left + right for left, right in [*path, *top]))
            out[row[0]] = (plain_leaf(row), subroot, root, proof, folded, folded == root)
    return out


def digest(docs):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = manifest.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered={"text": changed})
    return {r["doc_id"]: tuple(r)[1:] for r in rows.collect()}


def test_manifest_equals_plain_version(spark):
    """A group of three blocks, groups of 1 to 28, a null source beside one named like its key, null and empty texts."""
    sizes = {"hot": 600, None: 2, "0": 1, "": 3, "10": 4, "b": 9, "z": 10, "é": 27, "ü": 28}
    body = texts(sum(sizes.values()))
    body[3], body[5] = None, ""
    places = [source for source, n in sizes.items() for _ in range(n)]
    random.Random(2).shuffle(places)
    rows = [(7 * k - 900, t, places[k]) for k, t in enumerate(body)]
    got = digest(docs_of(spark, rows))
    assert got == plain_manifest([(k, s, "en" if t else None, len(t or ""), t) for k, t, s in rows])
    assert 0 < sum(not r[-1] for r in got.values()) < len(got)


def test_manifest_of_few_rows(spark):
    assert digest(docs_of(spark, [])) == {}
    one = digest(docs_of(spark, [(4, "a\nb", None)]))
    assert one[4][0] == one[4][1] == one[4][2] and one[4][3] == h("")
    twice = manifest.manifest(docs_of(spark, [(1, "a", "s"), (1, "a", "s"), (None, "b", "s")]), ["doc_id", "text"])
    assert twice.count() == 3 and twice.where("verified").count() == 3 and twice.select("root").distinct().count() == 1


# ------------------------------------------------------------------ language model
def test_scores_equal_plain_baseline_and_the_model_comes_near_the_source(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 9))) for _ in range(300)]
    body = [" ".join(rng.choices(words, weights=range(1, 301), k=rng.randint(1, 80))).title() for _ in range(400)] + [None, "", " \n", "NEW unseen\x00words " * 3]
    docs = docs_of(spark, [(k, t, "a") for k, t in enumerate(body)])
    got = {r["doc_id"]: r for r in lm.score(docs).collect()}
    tokens = {k: [*re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), None] for k, t in enumerate(body)}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in tokens}
    counts = Counter(w for k, own in tokens.items() if not held[k] for w in own)
    total, kinds = sum(counts.values()), len(counts)
    assert len(got) == len(body)
    for k, own in tokens.items():
        r = got[k]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[k], len(own), sum(counts[w] > 0 for w in own), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own), rel=1e-12)
        assert r["score"] < 0 and r["bits_per_byte"] == pytest.approx(-r["score"] * math.log2(10) / max(len((body[k] or "").encode()), 1))
    # the texts are independent draws of words, so no model can do better on average than counts of words
    score, base = (sum(r[name] for k, r in got.items() if held[k] and k < 400) for name in ("score", "base_score"))
    assert 1.2 * base < score


def test_rare_words_are_joined_alike(spark, monkeypatch):
    """With fewer words broadcast, the counts of the others come by a join: same scores."""
    docs = docs_of(spark, [(k, t, "a") for k, t in enumerate(texts(80))])
    want = {r["doc_id"]: tuple(r) for r in lm.score(docs).collect()}
    monkeypatch.setattr(lm, "COMMON", 8)
    got = {r["doc_id"]: tuple(r) for r in lm.score(docs).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_words_are_counted_alike_in_any_portions(monkeypatch):
    """Also words that bytes of other alphabets or several white spaces part."""
    body = [*texts(60), "", " \t\n", "a\x0bb\x0cc\rd\x00 \u00a0\u3000x é", "once"]
    batch = pa.RecordBatch.from_arrays([pa.array([k % 3 > 0 for k in range(len(body))]), pa.array(body)], ["train", "text"])
    want, taught = Counter(), Counter()
    for k, text in enumerate(body):
        own = [*text.lower().encode().split(), b"\n"]
        want.update(own)
        taught.update(own if k % 3 else ())
    for size in (lm.WORD_BYTES, 500):
        monkeypatch.setattr(lm, "WORD_BYTES", size)
        c, n = Counter(), Counter()
        for part in lm._count_words(iter([batch.slice(0, 9), batch.slice(9)])):
            for kind, token, x, y in zip(*[v.to_pylist() for v in part.columns]):
                if kind == 0:
                    c[token] += x
                    n[token] += y
        assert n == want and +c == taught


def test_words_used_once_are_not_joined_but_known(spark, monkeypatch):
    """With no word broadcast but the end, a word used once is known in a training text and unknown in a held-out one."""
    monkeypatch.setattr(lm, "COMMON", 1)
    docs = docs_of(spark, [(k, "both both" + f" only{k}" * (k < 4), "a") for k in range(8)])
    got = {r["doc_id"]: (r["n_tokens"], r["n_known"], r["base_score"]) for r in lm.score(docs, held_out=F.col("doc_id") % 2 == 1).collect()}
    total, kinds = 14, 4
    p = [math.log10((c + 0.5) / (total + 0.5 * (kinds + 1))) for c in (0, 1, 4, 8)]
    for k in range(8):
        more = (k < 4) * (p[0] if k % 2 else p[1])
        assert got[k][:2] == (3 + (k < 4), 3 + (k < 4 and k % 2 == 0)) and got[k][2] == pytest.approx(2 * p[3] + p[2] + more, rel=1e-12)


def test_every_training_text_teaches_the_weights(spark):
    """Also those that a sixteenth by the hash would pass over: each against the counts of the other fold, as a plain version does it."""
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) // 5 % 16][:120]
    body = [(t + " ") * 9 for t in texts(len(ids))]
    docs = docs_of(spark, [(k, t, "a") for k, t in zip(ids, body)])
    got = {r["doc_id"]: r["score"] for r in lm.score(docs.coalesce(1)).collect()}
    crc = [zlib.crc32(str(k).encode()) for k in ids]
    taught = [[t.lower().encode() for t, c in zip(body, crc) if c % 5 != 1 and c // 5 % lm.FOLDS == f] for f in range(lm.FOLDS)]
    code = mixer.Code(mixer.pair_counts(sum(taught, [])).reshape(256, -1))

    def tables_of(own):
        total = np.zeros((mixer.INPUTS, mixer.SLOTS, 2), np.int64)
        for k, r, packed in mixer.count(own, code):
            mixer.add_packed(packed, total[k, r * mixer.RANGE : (r + 1) * mixer.RANGE])
        return np.stack([np.frombuffer(mixer.odds(pairs), np.int8) for pairs in total])

    weights = mixer.first_weights(code)
    for f, own in enumerate(taught):
        mixer.mix(own, code, tables_of(sum((t for g, t in enumerate(taught) if g != f), [])), weights, learn=True)
    assert np.abs(weights - mixer.first_weights(code)).max() > 0.01
    want = mixer.mix([t.lower().encode() for t in body], code, tables_of(sum(taught, [])), weights) / math.log(10)
    assert [got[k] for k in ids] == pytest.approx(want.tolist(), rel=1e-4)
    untaught = mixer.mix([t.lower().encode() for t in body], code, tables_of(sum(taught, [])), mixer.first_weights(code)) / math.log(10)
    assert abs(want.sum() / untaught.sum() - 1) > 1e-3


def test_model_without_training_or_rows(spark):
    docs = docs_of(spark, [(1, "ab", "a"), (None, "ab", "a"), (1, "ab", "a")])
    rows = lm.score(docs, held_out=F.lit(True)).collect()
    assert len(rows) == 3 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in rows)
    assert len({r["score"] for r in rows}) == 1
    assert lm.score(docs.where("false")).count() == 0


def test_codes_are_complete_and_counts_add_up():
    body = [t.lower().encode() for t in texts(200)]
    code = mixer.Code(mixer.pair_counts(body).reshape(256, -1))
    assert np.allclose((0.5 ** code.length.astype(float)).reshape(256, -1).sum(axis=1), 1)
    total = np.zeros((mixer.INPUTS, mixer.SLOTS, 2), np.int64)
    for part in (body[:70], body[70:]):
        for k, r, packed in mixer.count(part, code):
            mixer.add_packed(packed, total[k, r * mixer.RANGE : (r + 1) * mixer.RANGE])
    bits = int((mixer.pair_counts(body) * code.length).sum())
    assert total.sum(axis=(1, 2)).tolist() == [bits] * mixer.INPUTS
    big = np.zeros((mixer.RANGE, 2), np.int64)
    big[[0, 5, 4095]] = [[1, 0], [254, 255], [2**31 - 1, 70000]]
    back = np.zeros_like(big)
    mixer.add_packed(mixer.pack(big), back)
    assert (back == big).all()


def test_texts_are_scored_apart_and_only_from_what_precedes(monkeypatch):
    """A text scores the same alone and in any company; a piece cut from a long text still knows what came before."""
    body = [t.lower().encode() for t in texts(60)]
    code = mixer.Code(mixer.pair_counts(body).reshape(256, -1))
    tables = np.random.default_rng(1).integers(-60, 60, (mixer.INPUTS, mixer.SLOTS)).astype(np.int8)
    weights = mixer.first_weights(code)
    together = mixer.mix(body, code, tables, weights)
    assert np.allclose([mixer.mix([t], code, tables, weights)[0] for t in body], together, rtol=1e-5)
    long = b" ".join(body * 3)
    whole = mixer.mix([long], code, tables, weights)[0]
    monkeypatch.setattr(mixer, "PIECE", 1 << 12)
    assert mixer.mix([long], code, tables, weights)[0] == pytest.approx(whole, rel=1e-3)
