"""Clears found by the stream's state against a run-by-run walk over tables, with restarts, expiry and disorder."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests.compare import connect, same
from wattloom.plans import stream_queries
from wattloom.sources import store
from wattloom.streaming import clearing

T0 = dt.datetime(2024, 3, 1)
HIT = "uc string, entity string, time timestamp, source string, metric string, detector string, severity string"


def walk(hits, runs, days=7):
    """Run by run, as the tables would be read and written: the latest row of each entity, cleared if it did not fire."""
    out, latest = [], {}
    for at in sorted({t for _, t in runs} | {h[2] for h in hits}):
        for uc, entity, _, source, metric, detector, severity in sorted((h for h in hits if h[2] == at), key=lambda h: h[3:6], reverse=True):
            latest[uc, entity] = (at, source, metric, detector, severity)
        for uc in {u for u, t in runs if t == at}:
            for (u, entity), row in list(latest.items()):
                if u == uc and row and at - dt.timedelta(days=days) < row[0] < at:
                    out.append((uc, entity, at, *row[1:]))
                    latest[u, entity] = None
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    hits, runs = [], []
    for uc in ("a", "b", "seldom"):
        hours = sorted(rng.sample(range(24 * 30), 40 if uc != "seldom" else 4))
        for h in hours:
            runs.append((uc, T0 + dt.timedelta(hours=h)))
            for entity in ("e1", "e2", None, "", "e5"):
                if rng.random() < 0.35:
                    hits += [(uc, entity, T0 + dt.timedelta(hours=h), "s", m, "d", rng.choice(["info", "critical"])) for m in rng.sample(["m1", "m2"], rng.choice([1, 1, 2]))]
    hits.append(("a", "stray", T0 + dt.timedelta(hours=5, minutes=30), "s", "m1", "d", "info"))  # fired between runs
    return hits, runs


def cut(rows, time, n):
    rows = sorted(rows, key=lambda r: r[time])
    times = sorted({r[time] for r in rows})
    bounds = [times[len(times) * k // n] for k in range(n)] + [times[-1] + dt.timedelta(days=1)]
    return [[r for r in rows if bounds[k] <= r[time] < bounds[k + 1]] for k in range(n)]


def stream_of(spark, place, late):
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/{name}")
    return clearing.clears(read("hits", HIT), read("runs", "uc string, time timestamp"), late=late, buckets=3)


def test_restarted_stream_equals_the_walk(spark, tmp_path):
    hits, runs = made(1)
    runs.append(("seldom", T0 + dt.timedelta(days=45)))  # far beyond the look-back: nothing is left to clear
    runs.append(("a", T0 + dt.timedelta(days=45)))
    bounds = cut(runs, 1, 3)
    rng = random.Random(2)
    for part in bounds:
        low, high = min(r[1] for r in part), max(r[1] for r in part)
        mine = [h for h in hits if low <= h[2] <= high] * 2  # every hit twice
        rng.shuffle(mine)
        clearing.replay(spark, [spark.createDataFrame(mine, HIT)], f"{tmp_path}/hits")
        clearing.replay(spark, [spark.createDataFrame(part + part[:3], "uc string, time timestamp")], f"{tmp_path}/runs")
        clearing.start_clears(stream_of(spark, tmp_path, "0 seconds"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    kept = [h for h in hits if any(min(r[1] for r in p) <= h[2] <= max(r[1] for r in p) for p in bounds)]
    got = spark.read.parquet(f"{tmp_path}/out").select("uc", "entity", "time", "source", "metric", "detector", "severity").collect()
    want = walk(kept, runs)
    assert len(want) > 20 and any(r[1] is None for r in want) and any(r[1] == "" for r in want)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert spark.conf.get(clearing._PROVIDER) != clearing._ROCKS  # the session's setting is back


def test_disorder_within_the_watermark(spark, tmp_path):
    """Hits that come after the run of their hour, in a later file, still count for it."""
    at = lambda h: T0 + dt.timedelta(hours=h)
    hit = lambda e, h: ("a", e, at(h), "s", "m", "d", "warning")
    clearing.replay(spark, [spark.createDataFrame([hit("x", 1), hit("y", 1)], HIT), spark.createDataFrame([hit("x", 2)], HIT), spark.createDataFrame([hit("z", 30)], HIT)], f"{tmp_path}/hits")
    clearing.replay(spark, [spark.createDataFrame([("a", at(h)) for h in hs], "uc string, time timestamp") for hs in ([1, 2], [3], [30])], f"{tmp_path}/runs")
    clearing.start_clears(stream_of(spark, tmp_path, "6 hours"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert {(r.entity, r.time) for r in got.collect()} == {("y", at(2)), ("x", at(3))}
    marks = store.clear_markers(got.withColumnRenamed("time", "at"), F.col("at"))
    assert {(r.score, r.severity) for r in marks.collect()} == {(0.0, "warning")}


def test_signs_of_time_let_the_last_runs_be_judged(spark, tmp_path):
    """Nothing fires after the first hour: the runs are judged once both streams say how far they have come, and not before."""
    at = lambda h: T0 + dt.timedelta(hours=h)
    fired = spark.createDataFrame([("a", "x", at(1), "s", "m", "d", "warning")], HIT)
    ran = spark.createDataFrame([("a", at(h)) for h in (1, 2, 3)], "uc string, time timestamp")

    def run():
        clearing.start_clears(stream_of(spark, tmp_path, "0 seconds"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
        return [(r.uc, r.entity, r.time) for r in spark.read.schema(HIT).parquet(f"{tmp_path}/out").collect()]

    clearing.replay(spark, [fired], f"{tmp_path}/hits")
    clearing.replay(spark, [ran], f"{tmp_path}/runs")
    assert run() == []
    clearing.replay(spark, [clearing.reached(ran, F.lit(at(4)))], f"{tmp_path}/runs")
    assert run() == []
    clearing.replay(spark, [clearing.reached(fired, F.lit(at(4)))], f"{tmp_path}/hits")
    clearing.replay(spark, [clearing.reached(ran, F.lit(at(4)))], f"{tmp_path}/runs")
    assert run() == [("a", "x", at(2))]


def test_query_clears_at_the_very_last_run(spark, tmp_path):
    """A channel that fires an hour before the end is cleared by the last run, as in the SQL."""
    rows = [(dt.datetime(2024, 1, day, hour, 5), kind, 10.0 + day % 3) for day in (2, 9, 16, 23, 30) for hour in (21, 22, 23) for kind in ("view", "click")]
    rows = [(t, kind, 99.0 if (t.day, t.hour, kind) == (30, 22, "view") else v) for t, kind, v in rows]
    rows.append((dt.datetime(2024, 1, 31, 0, 5), "view", 10.0))  # after the end
    spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/made")
    (file,) = (tmp_path / "made").glob("*.parquet")
    file.rename(tmp_path / "events.parquet")
    got = stream_queries.r3_streamed_clears(spark, str(tmp_path))
    assert ("view", dt.datetime(2024, 1, 30, 23)) in [(r.entity, r.time) for r in got.collect()]
    same(got, connect(str(tmp_path)), stream_queries.SQL["r3_streamed_clears"])
