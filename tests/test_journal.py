"""The journal against a dictionary that is upserted, its readers during writes, and a scoring stream that dies at each step."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattloom.sources import store, versions
from wattloom.sources.journal import Journal
from wattloom.sources.maintained import Rollups
from wattloom.streaming import scoring

T0 = dt.datetime(2024, 6, 1)
SCHEMA = "time timestamp, metric string, severity string, score double"
KEY = ["time", "metric"]


def made(rng, n, days=5):
    return list({(t, m): (t, m, rng.choice(["info", "warning", None]), rng.choice([None, rng.random()])) for _ in range(n) for t, m in [(T0 + dt.timedelta(days=rng.randrange(days), hours=rng.randrange(3)), rng.choice("ab"))]}.values())


def merge(state, rows, update):
    for t, m, severity, score in rows:
        old = state.get((t, m))
        new = (severity, score)
        state[t, m] = new if old is None else tuple(v if c in update else o for c, v, o in zip(("severity", "score"), new, old, strict=True))


def found(df):
    return {(r.time, r.metric): (r.severity, r.score) for r in df.collect()}


def test_changes_of_all_some_and_no_columns(spark, tmp_path):
    rng, state, before = random.Random(1), {}, {}
    table = Journal(spark, f"{tmp_path}/t", SCHEMA, KEY)
    assert found(table.view()) == {}
    for batch, update in enumerate([None, ["severity"], [], ["severity", "score"], None, []]):
        rows = made(rng, 25)
        before[batch] = dict(state)
        assert table.append(spark.createDataFrame(rows, SCHEMA), batch, update)
        merge(state, rows, ["severity", "score"] if update is None else update)
        assert found(table.view()) == state
        if batch == 2:
            assert len(table.compact()) == 5 and found(table.view()) == state
            assert table.compact() == []
    assert not table.append(spark.createDataFrame(made(rng, 5), SCHEMA), 3)  # sent again
    assert found(table.view()) == state and found(table.view(before=4)) == before[4]
    one = str((T0 + dt.timedelta(days=2)).date())
    part = table.view(one, one)
    assert found(part) == {k: v for k, v in state.items() if str(k[0].date()) == one}
    assert {f.split("day=")[1][:10] for f in part.inputFiles()} == {one}
    table.compact()
    assert table.vacuum() > 0 and found(table.view()) == state
    with pytest.raises(ValueError):
        table.append(spark.createDataFrame(made(rng, 5), SCHEMA), -5)


def test_readers_do_not_see_unfinished_writes(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    table, rows = Journal(spark, f"{tmp_path}/t", SCHEMA, KEY), made(rng, 20)
    table.append(spark.createDataFrame(rows, SCHEMA), 1)
    state = found(table.view())
    boom = F.raise_error(F.lit("lost")).cast("string")
    broken = spark.createDataFrame(made(rng, 20), SCHEMA).repartition(4).withColumn("severity", F.when(F.col("metric") == "b", boom).otherwise(F.col("severity")))
    with pytest.raises(Exception, match="lost"):
        table.append(broken, 2)
    assert found(table.view()) == state and not table.has(2)
    new = made(rng, 20)
    assert table.append(spark.createDataFrame(new, SCHEMA), 2)
    merge(state, new, ["severity", "score"])
    assert found(table.view()) == state
    # a compaction that dies halfway leaves a folder without its end mark
    table.view().limit(1).write.parquet(f"{tmp_path}/t/days/version=2/day={T0.date()}")
    assert found(table.view()) == state
    table.compact()
    assert found(table.view()) == state


READINGS = "channel string, ts timestamp, value double"


def levels(seed, days=70):
    """Two readings an hour of two channels; some hours of the last days are far off."""
    rng, rows = random.Random(seed), []
    for day in range(days):
        for hour in range(0, 24, 4):
            for c in "ab":
                off = 60 if day >= days - 3 and rng.random() < 0.3 else 0
                rows += [(c, T0 + dt.timedelta(days=day, hours=hour, minutes=m), 20 + rng.gauss(0, 1) + off) for m in (5, 35)]
    return rows


@pytest.mark.parametrize("dies", ["before the journal", "before the outbox", "while publishing"])
def test_a_crash_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, dies):
    rows = levels(3)
    stored = Rollups(spark, f"{tmp_path}/r", spark.createDataFrame([], READINGS).schema, ["channel"])
    stored.append(spark.createDataFrame(rows, READINGS), 1)
    stored.refresh()
    hours = stored.rollup()
    table, sent = Journal(spark, f"{tmp_path}/t", scoring.ANOMALIES, store.ANOMALY_KEY), []
    run = scoring.scorer(table, f"{tmp_path}/out", lambda b: scoring.profile_scores(b, stored, "power"), lambda m, n: sent.append((n, m.count())), compact_every=2)
    want = {(r.time, r.metric) for r in scoring.profile_scores(hours, stored, "power").collect()}
    first = hours.where(F.col("bucket") < F.lit(T0 + dt.timedelta(days=69)))
    run(first, 0)
    last = hours.where(F.col("bucket") >= F.lit(T0 + dt.timedelta(days=68)))  # a day of the first comes again
    with monkeypatch.context() as m:
        if dies == "before the journal":
            m.setattr(Journal, "append", lambda *a: 1 / 0)
        elif dies == "before the outbox":
            m.setattr(store, "to_publish", lambda *a: 1 / 0)
        else:
            m.setattr(versions, "mark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(last, 1)
    stored.append(spark.createDataFrame([("a", T0, 1000.0)], READINGS), 2)  # the baseline moves between crash and retry
    if dies != "before the journal":
        stored.refresh()
    run(last, 1)
    run(last, 1)
    got = {(r.time, r.metric) for r in table.view().collect()}
    assert got == want and len(want) > 5
    messages = [(r.time, r.subject) for r in scoring.messages(spark, f"{tmp_path}/out").collect()]
    assert len(messages) == len(set(messages)) == len(want)
    assert dict(sent).keys() == {0, 1} and len(sent) == (3 if dies == "while publishing" else 2)
