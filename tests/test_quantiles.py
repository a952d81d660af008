import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumeworks.operators.quantiles import exact_quantiles, moments, quantiles_of, value_counts

PROBS = {"lo": 0.0, "p5": 0.05, "mid": 0.5, "p95": 0.95, "hi": 1.0}


def check(spark, data, **how):
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", PROBS, **how).collect()}
    pdf = pd.DataFrame(data, columns=["k", "v"]).dropna(subset=["v"])
    groups = {k if isinstance(k, str) else None: g["v"] for k, g in pdf.groupby("k", dropna=False)}
    assert set(got) == set(groups)
    for k, series in groups.items():
        for name, p in PROBS.items():
            assert got[k][name] == pytest.approx(series.quantile(p), rel=1e-12), (k, name)


def test_equals_pandas(spark):
    rng = random.Random(5)
    data = [("hot", rng.gauss(0, 1)) for _ in range(4000)] + [("cold", rng.random()) for _ in range(7)]
    data += [("ties", float(rng.randint(0, 3))) for _ in range(500)] + [("one", 3.5), (None, 1.0), (None, 2.0)]
    data += [("hot", None), ("gone", None)]
    check(spark, data)


def test_poor_cut_points_change_only_the_work(spark):
    rng = random.Random(6)
    check(spark, [("a", rng.expovariate(1) ** 5) for _ in range(3000)], accuracy=4, bound=16)


def test_without_keys(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    assert tuple(exact_quantiles(df, [], "v", {"m": 0.5, "p": 0.98}).first()) == (50.5, 98.02)


def test_bands_are_narrowed_until_they_are_small(spark):
    """Values over 600 powers of two, with ties, a null and both signs: several rounds of splitting."""
    data = [("wide", sign * 2.0**k) for k in range(-300, 300) for sign in (1, -1, -1)] + [("wide", None)]
    data += [("flat", 1.0 + k / 7) for k in range(900)] + [("same", 2.0)] * 50
    check(spark, data, bound=8, parts=4, accuracy=50)


def test_moments_and_quantiles_share_one_scan(spark, folder):
    rng = random.Random(7)
    data = [(rng.choice("abc"), rng.choice([None, 100.0 + rng.randint(0, 9) / 8])) for _ in range(500)] + [("one", 4.0), ("none", None)]
    spark.createDataFrame(data, "k string, v double").write.parquet(f"{folder}/t")
    counted = value_counts(spark.read.parquet(f"{folder}/t"), ["k"], "v")
    pdf = pd.DataFrame(data, columns=["k", "v"])
    for row in moments(counted, ["k"]).collect():
        series = pdf[pdf["k"] == row["k"]]["v"]
        want = (len(series), series.count(), series.mean(), series.std(), series.max())
        for got, value in zip(row[1:], want):
            assert got is None and pd.isna(value) or got == pytest.approx(value, rel=1e-12)
    plan = quantiles_of(counted, ["k"], PROBS)._jdf.queryExecution().toString()
    assert f"{folder}/t" not in plan
