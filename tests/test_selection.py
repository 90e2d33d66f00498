"""Quantiles by rank selection against ``percentile``; forests by joins against the walk down each tree."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.operators import forest, forest_levels, quantiles

AT = [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize(("bins", "most"), [(16, 20), (1024, 10_000)])
def test_quantiles_equal_percentile(spark, bins, most):
    rng = random.Random(bins)
    rows = [(k, 1, rng.choice([rng.gauss(0, 1), rng.expovariate(1) ** 9, 5.0, -1e300, 1e-300])) for k in ("a", "b", None) for _ in range(700)]
    rows += [("flat", 1, 7.0)] * 50 + [("two", 1, 1.0), ("two", 1, 2.0), ("one", None, -0.0), ("none", 1, None), ("none", 2, float("nan"))]
    df = spark.createDataFrame(rows, "k string, m int, v double").repartition(5)
    got = {(r.k, r.m, r.q): (r.value, r.n) for r in quantiles.quantiles(df, ["k", "m"], "v", AT, bins, most).collect()}
    fine = df.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("k", "m")
    want = {}
    for r in fine.agg(F.percentile("v", F.array(*map(F.lit, AT))).alias("p"), F.count("*").alias("n")).collect():
        want |= {(r.k, r.m, q): (v, r.n) for q, v in zip(AT, r.p, strict=True)}
    assert got.keys() == want.keys() and len(want) == 6 * 6
    assert all(got[k] == pytest.approx(want[k], rel=1e-12, abs=0) for k in want)
    assert quantiles.quantiles(df.limit(0), ["k"], "v", AT).collect() == []


def test_passes_are_few_for_a_hot_group(spark, monkeypatch):
    """A group of 200,000 values next to small ones: three passes, and the last picks among a few."""
    df = spark.range(200_000).select(F.lit("hot").alias("k"), F.sin(F.col("id").cast("double")).alias("v")).unionByName(spark.createDataFrame([("cold", float(i)) for i in range(9)], "k string, v double"))
    seen = []
    met = quantiles._met
    monkeypatch.setattr(quantiles, "_met", lambda *a: seen.append(1) or met(*a))
    got = {(r.k, r.q): r.value for r in quantiles.quantiles(df, ["k"], "v", [0.1, 0.5], 256, 200).collect()}
    v = np.sin(np.arange(200_000))
    assert got["hot", 0.1] == pytest.approx(np.quantile(v, 0.1)) and got["hot", 0.5] == pytest.approx(np.quantile(v, 0.5)) and got["cold", 0.5] == 4.0
    assert len(seen) <= 4


def matrix(spark, seed, n=900):
    rng = np.random.default_rng(seed)
    rows = []
    for model in ("m1", "m2"):
        x = rng.normal(size=(n, 3))
        x[:, 2] = np.round(x[:, 2])
        x[0] = [9, -9, 9]
        rows += [(model, dt.datetime(2024, 1, 1) + dt.timedelta(hours=k), [float(v) for v in r]) for k, r in enumerate(x)]
    return spark.createDataFrame(rows, "model string, bucket timestamp, x array<double>")


def test_joined_scores_equal_the_walk_on_given_trees(spark):
    rows = matrix(spark, 1)
    trees = forest.fit(rows.withColumnRenamed("x", "z"), trees=15, subsample=64).cache()
    walked = {(r.model, r.bucket): r.score for r in forest.score(rows.withColumnRenamed("x", "z"), trees).collect()}
    joined = {(r.model, r.bucket): r.score for r in forest_levels.score(rows, trees).collect()}
    assert joined.keys() == walked.keys() and len(joined) == 1800
    assert all(joined[k] == pytest.approx(walked[k], rel=1e-9) for k in walked)
    other = forest_levels.score(rows.withColumn("model", F.lit("unknown")), trees)
    assert other.collect() == [] and forest_levels.score(rows, trees.limit(0)).collect() == []


def test_forest_by_levels(spark, monkeypatch):
    rows = matrix(spark, 2)
    nodes = forest_levels.fit(rows, 3, trees=30, subsample=64).cache()
    again = forest_levels.fit(rows.repartition(7), 3, trees=30, subsample=64)
    assert sorted(map(str, nodes.collect())) == sorted(map(str, again.collect()))
    for tree in nodes.where("model = 'm1'").toPandas().groupby("tree"):
        t = tree[1].set_index("node")
        assert t.loc[0, "size"] == 64 and t["depth"].max() <= 6
        for k, r in t.iterrows():
            if r.feature >= 0:  # children split the rows of their parent and none is empty
                assert t.loc[2 * k + 1, "size"] + t.loc[2 * k + 2, "size"] == r["size"] and t.loc[2 * k + 1, "size"] > 0
    scores = forest_levels.score(rows, nodes).orderBy("score").limit(2).collect()
    assert {r.bucket for r in scores} == {dt.datetime(2024, 1, 1)}  # the planted outliers
    wide = {(r.model, r.bucket): r.score for r in forest_levels.score(rows, nodes).collect()}
    monkeypatch.setattr(forest_levels, "SENT_NODES", 10)  # too many to send: shuffled joins
    assert {(r.model, r.bucket): r.score for r in forest_levels.score(rows, nodes).collect()} == pytest.approx(wide)
    twice = rows.unionByName(rows.where("model = 'm1'"))
    assert forest_levels.score(twice, nodes).count() == 2700
    assert forest_levels.fit(rows.limit(0), 3).collect() == []
