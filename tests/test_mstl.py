"""The fitted seasonal model: what was planted comes back, errors shrink, SQL agrees where orders differ."""

import datetime as dt

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.compare import rows
from wattloom.operators import mstl, seasonal
from wattloom.plans import seasonal_queries
from wattloom.plans.base import plain

START = dt.datetime(2024, 1, 1)


def planted(seed, n, phi=0.7, grow=3.0, drift=0.0, noise=1.0):
    """Level, a daily season whose swing grows, a weekly one, and an autoregression."""
    rng, t = np.random.default_rng(seed), np.arange(n)
    e = np.zeros(n)
    for k in range(1, n):
        e[k] = phi * e[k - 1] + rng.normal(0, noise)
    daily = (3 + grow * t / n) * np.sin(2 * np.pi * t / 24)
    weekly = 2 * np.cos(2 * np.pi * t / 168)
    walk = np.cumsum(rng.normal(0, drift, n)) if drift else 0
    return 20 + daily + weekly + e + walk, daily, weekly


def frame(spark, series):
    data = pd.concat([pd.DataFrame({"uc": k, "bucket": pd.date_range(START, periods=len(y), freq="h"), "y": y}) for k, y in series.items()])
    return spark.createDataFrame(data.sample(frac=1, random_state=1))


def test_autoregression_is_recovered():
    for phi in (0.5, 0.8, -0.4):
        y, *_ = planted(3, 24 * 90, phi)
        model = mstl.fit(y)
        assert model.differences == 0 and abs(model.phi[0] - phi) < 0.1 and abs(model.sigma - 1) < 0.2
    z = np.zeros(4000)
    rng = np.random.default_rng(4)
    for k in range(2, 4000):
        z[k] = 0.5 * z[k - 1] + 0.3 * z[k - 2] + rng.normal()
    found = mstl.autoregression(z - z.mean())
    assert len(found) >= 2 and np.allclose(found[:2], [0.5, 0.3], atol=0.06)


def test_changing_seasons_are_recovered():
    y, daily, weekly = planted(5, 24 * 84, phi=0.0, grow=6.0, noise=0.3)
    seasons, trend = mstl.decompose(y)
    assert np.sqrt(np.mean((seasons[0] - daily) ** 2)) < 0.25 and np.sqrt(np.mean((seasons[1] - weekly) ** 2)) < 0.35
    assert abs(trend - 20).max() < 0.5
    early, late = np.ptp(seasons[0][:168]), np.ptp(seasons[0][-168:])
    assert late > 2 * early  # means by hour would be equal


def test_a_walk_is_differenced_and_bounds_widen():
    y, *_ = planted(6, 24 * 60, phi=0.0, drift=1.0, noise=0.2)
    model = mstl.fit(y)
    assert model.differences == 1
    _, errors = model.ahead(mstl.PERIODS, 24)
    assert errors[0] == pytest.approx(model.sigma) and errors[23] > 2 * errors[0]


def test_many_series_in_one_plan_beat_the_line(spark):
    """Held-out day of 12 series: the fitted model's error is below that of moving average, hourly means and a line."""
    whole = {f"s{k}": planted(k, 24 * 70, phi=0.8, grow=9.0)[0] for k in range(12)}
    train = frame(spark, {k: y[:-24] for k, y in whole.items()})
    truth = frame(spark, whole).withColumnRenamed("bucket", "forecast_for")
    error = F.sqrt(F.avg((F.col("y") - F.col("forecast_value")) ** 2)).alias("e")
    new, old = (f.join(truth, ["uc", "forecast_for"]).agg(error, F.count("*").alias("n")).first() for f in (mstl.forecast(train, ["uc"]), seasonal.forecast(train, ["uc"])))
    assert new.n == old.n == 12 * 24
    assert new.e < 0.85 * old.e
    plan = mstl.forecast(train, ["uc"])._jdf.queryExecution().toString()
    assert plan.count("FlatMapGroupsInPandas") >= 1


def test_bounds_hold_most_held_out_values(spark):
    whole = {f"s{k}": planted(40 + k, 24 * 50, phi=0.6)[0] for k in range(10)}
    got = mstl.forecast(frame(spark, {k: y[:-24] for k, y in whole.items()}), ["uc"], widening=True)
    met = got.join(frame(spark, whole).withColumnRenamed("bucket", "forecast_for"), ["uc", "forecast_for"])
    assert met.where(F.col("y").between(F.col("forecast_lower"), F.col("forecast_upper"))).count() / met.count() > 0.95


def test_hard_series(spark):
    y = planted(7, 400)[0]
    holes = y.copy()
    holes[5], holes[6] = np.nan, np.nan
    series = frame(spark, {"short": y[:335], "flat": np.ones(400), "good": y, "holes": holes})
    nulls = spark.createDataFrame([("none", START, None), (None, START, 1.0)], "uc string, bucket timestamp, y double")
    got = mstl.forecast(series.unionByName(nulls), ["uc"]).groupBy("uc").count().collect()
    assert {r.uc: r["count"] for r in got} == {"good": 24, "holes": 24}
    assert mstl.parts(series.unionByName(nulls), ["uc"]).where("uc = 'holes'").count() == 398
    assert mstl.forecast(series.limit(0), ["uc"]).collect() == []
    twice = mstl.forecast(series.withColumn("site", F.lit(3)), ["site", "uc"]).select("site", "uc").distinct().collect()
    assert {tuple(r) for r in twice} == {(3, "good"), (3, "holes")}


def test_sql_agrees_on_lags_and_differences(spark):
    """The queries' SQL on planted counts, where orders of one and more lags and a differenced series come up."""
    counts = {}
    for k, (phi, drift) in enumerate([(0.7, 0), (-0.5, 0), (0.0, 1.0), (0.9, 0)]):
        y = planted(70 + k, 24 * 29 + 23, phi, drift=drift)[0]
        counts[f"t{k}"] = np.maximum(np.round(3 * y + 60), 1).astype(int)
    data = pd.DataFrame([(k, START + dt.timedelta(hours=h, minutes=5)) for k, c in counts.items() for h, m in enumerate(c) for _ in range(m)], columns=["event_type", "ts"])
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.register("events", data)
    want = con.execute(seasonal_queries.SQL["d7_mstl_forecast"]).fetchdf()
    series = {k: c[: 24 * 29 + 23].astype(float) for k, c in counts.items()}
    got = plain(mstl.forecast(frame(spark, series).withColumnRenamed("uc", "event_type"), ["event_type"])).toPandas()
    assert set(want.lags) - {0} and set(want.differences) == {0, 1}
    assert rows(got) == rows(want)
