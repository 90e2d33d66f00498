"""Stored rollups that follow late readings: only touched days are written, all equals a full computation, a dead refresh goes on."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattloom.operators import rollup
from wattloom.sources import versions
from wattloom.sources.maintained import Rollups

SCHEMA = "channel string, ts timestamp, value double"
T0 = dt.datetime(2024, 5, 1)


def made(seed, days, n):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), T0 + dt.timedelta(days=rng.choice(days), seconds=rng.randrange(86_400)), rng.choice([None, rng.uniform(0, 60)])) for _ in range(n)]


@pytest.fixture
def stored(spark, tmp_path):
    return Rollups(spark, str(tmp_path / "power"), spark.createDataFrame([], SCHEMA).schema, ["channel"], on_at=40.0)


def table(df):
    return sorted(map(str, df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect()))


def check(spark, stored, rows):
    full = rollup.hourly(spark.createDataFrame(rows, SCHEMA), ["channel"], on_at=40.0)
    assert table(stored.rollup()) == table(full)
    states = rollup.baseline(full, ["channel"]).withColumnRenamed("day", "on_day")
    assert table(stored.baseline()) == table(states.select(stored.baseline().columns))


def test_late_readings_change_their_days_only(spark, stored, tmp_path):
    first = made(1, range(10), 900)
    assert stored.append(spark.createDataFrame(first, SCHEMA), 1)
    one = stored.refresh()
    assert len(one.days) == 10 and one.batches == [1]
    check(spark, stored, first)
    late = made(2, [3], 4) + made(3, [10], 30)
    stored.append(spark.createDataFrame(late, SCHEMA), 2)
    two = stored.refresh()
    days = {T0.date() + dt.timedelta(days=d) for d in (3, 10)}
    assert set(two.days) == days and two.hours == len({r[1].replace(minute=0, second=0) for r in late})
    assert set(versions.children(spark, f"{tmp_path}/power/rollup/version=2", "day=")) == {str(d) for d in days}
    assert set(versions.children(spark, f"{tmp_path}/power/baseline/version=2", "day=")) == {str(d) for d in days}
    check(spark, stored, first + late)
    # only those days' folders are scanned for the refresh, and only wanted days for a reader
    assert len(stored._readings([1, 2], two.days).inputFiles()) < len(stored._readings([1, 2]).inputFiles()) / 2
    assert {f.split("day=")[1][:10] for f in stored.rollup("2024-05-04", "2024-05-05").inputFiles()} == {"2024-05-04", "2024-05-05"}
    assert stored.vacuum() == 2  # the day that was written twice, in both tables
    check(spark, stored, first + late)


def test_repeated_and_unordered_batches(spark, stored):
    rows = {k: made(10 + k, range(k, k + 3), 60) for k in (1, 2, 5)}
    for k in (5, 1):
        stored.append(spark.createDataFrame(rows[k], SCHEMA), k)
    assert stored.refresh().batches == [1, 5]
    assert not stored.append(spark.createDataFrame(made(99, range(5), 50), SCHEMA), 5)  # sent again, with other rows even
    assert stored.refresh().days == []
    stored.append(spark.createDataFrame(rows[2] + [("a", None, 1.0)], SCHEMA), 2)
    stored.append(spark.createDataFrame([], SCHEMA), 3)
    assert stored.refresh().batches == [2, 3]
    check(spark, stored, rows[1] + rows[2] + rows[5])


@pytest.mark.parametrize("dies", ["rollup", "baseline"])
def test_a_refresh_that_dies_goes_on_and_readers_see_one_state(spark, stored, monkeypatch, dies):
    first, late = made(20, range(4), 200), made(21, [1, 6], 20)
    stored.append(spark.createDataFrame(first, SCHEMA), 1)
    stored.refresh()
    before = table(stored.rollup()), table(stored.baseline())
    stored.append(spark.createDataFrame(late, SCHEMA), 2)
    write = versions.write_days

    def broken(df, path, *rest):
        if path.endswith(dies):
            raise OSError("lost")
        return write(df, path, *rest)

    monkeypatch.setattr(versions, "write_days", broken)
    with pytest.raises(OSError):
        stored.refresh()
    assert (table(stored.rollup()), table(stored.baseline())) == before
    stored.append(spark.createDataFrame(made(22, [2], 9), SCHEMA), 3)  # arrives before the retry: not in its plan
    monkeypatch.setattr(versions, "write_days", write)
    assert stored.refresh().batches == [2]
    check(spark, stored, first + late)
    assert stored.refresh().batches == [3]


def test_nothing_stored(spark, stored):
    assert stored.rollup().count() == 0 and stored.baseline().count() == 0
    assert stored.refresh().days == []
