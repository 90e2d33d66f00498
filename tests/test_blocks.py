"""Blockwise runs, streaks and integrals against the one-window forms; time-weighted states against the whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattloom.operators import blocks, series, timeweight

T0 = dt.datetime(2024, 2, 27)
SCHEMA = "channel string, id long, ts timestamp, value double"


def readings(spark, seed, n=1500, days=6):
    """Channels with long runs across days, gaps of days, equal times, NULL keys and values."""
    rng, rows = random.Random(seed), []
    for c in ("a", "b", None, "still", "one"):
        at, level = T0, 50.0
        for k in range({"one": 1, "still": 300}.get(c, n // 3)):
            at += dt.timedelta(seconds=rng.choice([0, 0, 30, 600, 3600]) if rng.random() < 0.97 else rng.randrange(days * 10_000))
            level = level if c == "still" or rng.random() < 0.9 else rng.choice([10.0, 50.0, None])
            rows.append((c, k, at, level))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def table(df):
    return sorted(map(str, df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect()))


@pytest.mark.parametrize("spans", ["day", "year"])
def test_runs_and_integrals_equal_one_window(spark, spans):
    rows = readings(spark, 1).persist()
    on = F.col("value") >= 40
    assert table(blocks.runs(rows, ["channel"], on, tie=["id"], spans=spans)) == table(series.runs(rows, ["channel"], on, tie=["id"]))
    assert table(blocks.integral(rows, ["channel"], tie=["id"], spans=spans)) == table(series.integral(rows, ["channel"], tie=["id"]))
    assert blocks.runs(rows.limit(0), ["channel"], on).collect() == []
    rows.unpersist()


@pytest.mark.parametrize("spans", ["day", "year"])
def test_streaks_equal_one_window(spark, spans):
    rng, rows = random.Random(2), []
    for c in ("a", None, "long"):
        at = T0
        for _ in range(400):
            at += dt.timedelta(hours=1 if c == "long" or rng.random() < 0.97 else rng.choice([0, 2, 50]))
            rows.append((c, at, True if c == "long" else rng.choice([True] * 12 + [False, None])))
    df = spark.createDataFrame(rows, "channel string, bucket timestamp, active boolean").dropDuplicates(["channel", "bucket"])
    on = F.col("active")
    got, want = blocks.trailing_streak(df, ["channel"], on, spans=spans), series.trailing_streak(df, ["channel"], on)
    assert table(got) == table(want) and got.agg(F.max("streak")).first()[0] == 400


def test_no_window_over_a_whole_channel(spark):
    """Windows by channel alone read what an aggregation per block has left."""
    plan = blocks.runs(readings(spark, 3), ["channel"], F.col("value") >= 40, tie=["id"])._jdf.queryExecution().optimizedPlan().toString().split("\n")
    by_key = [i for i, line in enumerate(plan) if line.strip(" :+-").startswith("Window") and "], [_block" in line.replace("#", " ").replace("channel", "channel") and "_block" not in line.split("], [")[-2]]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    assert by_key
    for i in by_key:
        below = [line for line in plan[i + 1 :] if depth(line) > depth(plan[i])]
        assert any("Aggregate" in line for line in below[:4])


def test_states_merge_over_any_cut(spark):
    rows = readings(spark, 4).persist()
    whole = series.integral(rows, ["channel"], tie=["id"])
    hours = timeweight.states(rows, ["channel"], tie=["id"]).persist()
    days = timeweight.merge(hours, ["channel"], "day")
    for parts in (hours, days, timeweight.merge(days, ["channel"], "month"), timeweight.states(rows, ["channel"], spans="week", tie=["id"])):
        all_ = timeweight.merge(parts, ["channel"])
        assert table(all_.select("channel", "area")) == table(whole)
        assert all_.agg(F.sum("n")).first()[0] == rows.count()
    # cut at any rows, not at the calendar
    cut = timeweight.merge(hours.withColumn("part", F.hour("span") > 13), ["channel", "part"])
    assert cut.count() >= 5
    rows.unpersist()


def test_counters_with_resets(spark):
    values = [5, 9, 12, 3, 4, None, 10, 2, 2, 30]
    rows = spark.createDataFrame([("m", k, T0 + dt.timedelta(hours=7 * k), None if v is None else float(v)) for k, v in enumerate(values)], SCHEMA)
    rise = resets = 0
    for a, b in zip(values, values[1:], strict=False):
        if a is not None and b is not None:
            rise += b if b < a else b - a
            resets += b < a
    got = timeweight.merge(timeweight.merge(timeweight.states(rows, ["channel"]), ["channel"], "day"), ["channel"]).first()
    assert (got.rise, got.resets, got.n) == (rise, resets, 10) and got.first.v == 5 and got.last.v == 30
    mean = timeweight.average(timeweight.states(rows.where("id = 0"), ["channel"])).first()
    assert mean["mean"] == 5.0 and mean.area == 0.0
    assert timeweight.merge(timeweight.states(rows.limit(0), ["channel"]), ["channel"]).collect() == []
