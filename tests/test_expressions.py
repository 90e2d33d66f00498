"""Literal cases for expressions, detectors, stores and forecasts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattloom.functions import expressions as x
from wattloom.functions import usecases
from wattloom.operators import detectors, digest, energy, forecasts, forest, rollup, seasonal
from wattloom.operators import series as s
from wattloom.sources import readings, store

UTC = dt.UTC


def ts(text):
    return dt.datetime.fromisoformat(text)


def one(spark, *cols):
    return list(spark.range(1).select(*cols).first())


def test_z_tiers_and_floor(spark):
    got = one(spark, *(x.tier(F.lit(v), 3.0, 4.0, 6.0) for v in (2.9, 3.0, 4.0, 6.0, float("nan"))), x.tier(F.lit(None).cast("double"), 3.0, 4.0, 6.0))
    assert got == [None, "info", "warning", "critical", None, None]
    assert one(spark, x.at_least(F.lit("info"), "warning"), x.at_least(F.lit("critical"), "warning")) == [None, "critical"]


@pytest.mark.parametrize(
    ("values", "knobs", "want"),
    [
        ((10.0, 4.0, 2.0), {}, 3.0),
        ((10.0, 4.0, 0.0), {}, None),
        ((0.14, 0.10, 1e-17), {"rel": 0.15, "deadband_rel": 0.25}, 0.04 / 0.015),
        ((300.0, 43.0, 0.5), {"rel": 0.10, "absolute": 5.0, "deadband_abs": 20.0}, 51.4),
        ((50.0, 43.0, 0.5), {"rel": 0.10, "absolute": 5.0, "deadband_abs": 20.0}, None),
        ((float("nan"), 43.0, 0.5), {}, None),
    ],
)
def test_zscore_knobs(spark, values, knobs, want):
    got = one(spark, x.zscore(*map(F.lit, values), **knobs))[0]
    assert got is want if want is None else abs(got - want) < 1e-9


def test_rule_tiers(spark):
    valve = [x.tier(F.lit(v), 0, 25, 50, strict_info=True) for v in (0.0, 0.1, 25.0, 50.0)]
    ratio = [x.tier(F.lit(v), 0.65, 0.5, 0.35, below=True) for v in (0.65, 0.64, 0.49, 0.34)]
    assert one(spark, *valve, *ratio) == [None, "info", "warning", "critical"] * 2


def test_severity_steps(spark):
    lit = lambda v: F.lit(v).cast("string")
    pairs = [(None, "critical"), ("info", "warning"), ("critical", "warning"), ("info", "info")]
    assert one(spark, *(x.escalated(lit(a), lit(b)) for a, b in pairs)) == [False, True, False, False]
    assert one(spark, *(x.severity_rank(lit(v)) for v in (None, "info", "warning", "critical"))) == [0, 1, 2, 3]


def test_names(spark):
    assert one(spark, *(x.slug(F.lit(v)) for v in ("Gäste WC", "2/2/227", "--Flur--"))) == ["gaeste-wc", "2-2-227", "flur"]
    assert one(spark, x.entity({"inverter_id": F.lit(1)}), x.entity({"meter_id": F.lit(0)}), x.entity({}), x.entity({"inverter_id": F.lit(1)}, emit=False)) == ["inv1", "meter0", None, None]
    assert one(spark, x.floor_of(F.lit("FBH.OG.Bad")), x.floor_of(F.lit("FBH")), x.metric_label("m"), x.metric_label("m", F.lit(1), F.lit("a"))) == ["OG", "", "m", "m[1,a]"]


def test_energy_balance_values(spark):
    def figures(*v):
        return one(spark, *x.balance(*(F.lit(float(k)) for k in v)).values())

    assert figures(21.9, 7, 15)[:2] == [13.9, 6.9] and figures(21.9, 7, 15)[2:] == [31.5, 49.6]
    assert figures(0, 5, 0)[2:] == [0.0, 0.0] and figures(5, 0, 6)[2] == 0.0 and figures(0, 0, 0) == [0.0] * 4


def test_local_time(spark):
    assert one(spark, *(F.date_format(x.to_utc(F.lit(t), "Europe/Berlin"), "HH:mm") for t in ("2026-01-15 12:00:00", "2026-06-15 12:00:00"))) == ["11:00", "10:00"]
    assert one(spark, F.date_format(x.local_midnight(F.lit("2026-06-15 23:30:00").cast("timestamp"), "Europe/Berlin"), "MM-dd HH:mm")) == ["06-15 22:00"]


def test_warm_up(spark):
    now = F.lit("2026-01-10").cast("timestamp")
    young, old = F.lit("2026-01-05").cast("timestamp"), F.lit("2026-01-01").cast("timestamp")
    assert one(spark, x.warm_up(F.lit("critical"), young, now, 7), x.warm_up(F.lit("critical"), old, now, 7), x.warm_up(F.lit(None).cast("string"), young, now, 7)) == ["info", "critical", None]


@pytest.mark.parametrize(
    ("hours", "active", "want"), [([0, 1, 2], [1, 1, 1], 3), ([0, 1, 2], [1, 0, 1], 1), ([0, 1, 2], [1, 1, 0], 0), ([0, 2], [1, 1], 1), ([0, 1], [1, None], 0)]
)
def test_streaks(spark, hours, active, want):
    rows = [("a", dt.datetime(2024, 1, 1, h), None if v is None else bool(v)) for h, v in zip(hours, active, strict=True)]
    df = spark.createDataFrame(rows, "k string, bucket timestamp, active boolean")
    assert s.trailing_streak(df, ["k"], F.col("active")).orderBy(F.desc("bucket")).first().streak == want


def test_runs(spark):
    day = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [(0, True), (10, True), (20, False), (30, True), (35, None), (40, True), (50, True)]
    df = spark.createDataFrame([("k", day(m), v) for m, v in rows], "k string, ts timestamp, v boolean")
    got = {(r.start.minute, r.minutes) for r in s.runs(df, ["k"], F.col("v")).collect()}
    assert got == {(0, 20.0), (30, 5.0), (40, 10.0)}
    assert s.runs(df.limit(1), ["k"], F.col("v")).first().minutes is None


def test_as_of_null_latest_and_carry(spark):
    left = spark.createDataFrame([(1, ts("2024-01-01 12:00")), (2, ts("2024-01-05 00:00")), (3, ts("2024-01-01 00:00"))], "i int, t timestamp")
    right = spark.createDataFrame([(ts("2024-01-01 06:00"), 1.0), (ts("2024-01-01 12:00"), 2.0), (ts("2024-01-02 09:00"), None)], "u timestamp, v double")
    got = {r.i: r.a for r in s.as_of_join(left, right, "t", "u", "v", "a").collect()}
    assert got == {1: 2.0, 2: None, 3: None}


def test_integral_and_counter(spark):
    df = spark.createDataFrame([("k", ts("2024-01-01 00:00"), 0.0), ("k", ts("2024-01-01 01:00"), 2.0), ("k", ts("2024-01-01 03:00"), 2.0)], "k string, ts timestamp, value double")
    assert s.integral(df, ["k"]).first().area == 5.0 and s.counter_delta(df, ["k"]).first().delta == 2.0
    down = spark.createDataFrame([("a", -5.0), ("a", 3000.0), ("a", None)], "k string, delta double")
    assert s.floored_sum(down, ["k"]).first().kwh == 3.0


def test_merge_of_states_is_exact(spark):
    rows = [(dt.datetime(2024, 1, d, 5), "k", 1e6 + d) for d in range(1, 8)]
    state = rollup.baseline(spark.createDataFrame(rows, "bucket timestamp, k string, avg_value double"), ["k"])
    r = rollup.merge(state, ["k"]).first()
    assert (r.n, r["mean"]) == (7, 1e6 + 4) and abs(r["stddev"] - 2.160246899469287) < 1e-9
    single = rollup.merge(state.where("day = '2024-01-01'"), ["k"]).first()
    assert single.n == 1 and single["stddev"] is None


ANOMALY = "time timestamp, source string, metric string, detector string, severity string, uc string, actual double, expected double, score double, payload string"


def anomaly(time, severity="info", uc="u", entity='"e"', firing="true", score=1.0, metric="m"):
    return (ts(time), "s", metric, "d", severity, uc, 1.0, 2.0, score, f'{{"entity":{entity},"firing":{firing}}}')


def test_upsert_gate_and_clear(spark):
    old = spark.createDataFrame([anomaly("2024-01-01", "info"), anomaly("2024-01-02", "critical")], ANOMALY)
    new = spark.createDataFrame([anomaly("2024-01-01", "warning", score=9.0), anomaly("2024-01-02", "info"), anomaly("2024-01-03")], ANOMALY)
    got = {r.time.day: (r.severity, r.score) for r in store.upsert(old, new, store.ANOMALY_KEY).collect()}
    assert got == {1: ("warning", 9.0), 2: ("info", 1.0), 3: ("info", 1.0)}
    assert {r.time.day for r in store.to_publish(store.changes(old, new, store.ANOMALY_KEY)).collect()} == {1, 3}
    kept = store.upsert(old, new.withColumn("actual", F.lit(None).cast("double")), store.ANOMALY_KEY, ["severity"]).orderBy("time").collect()
    assert [r.actual for r in kept] == [1.0, 1.0, None]

    as_of = F.lit("2024-01-08").cast("timestamp")
    rows = [anomaly("2024-01-05", uc="a"), anomaly("2024-01-06", uc="b"), anomaly("2024-01-07", uc="b", firing="false"), anomaly("2024-01-07", uc="c", entity="null"), anomaly("2023-12-01", uc="d")]
    rows.append((*anomaly("2024-01-07", uc="e")[:-1], '{"other":1}'))
    opened = store.open_entities(spark.createDataFrame(rows, ANOMALY), as_of)
    assert {(r.uc, r.entity) for r in opened.collect()} == {("a", "e"), ("c", None)}
    fired, none = spark.createDataFrame([("c", None)], "uc string, entity string"), spark.createDataFrame([], "uc string, entity string")
    ran = lambda *ucs: spark.createDataFrame([(u,) for u in ucs], "uc string")
    assert {r.uc for r in store.cleared(opened, ran("c"), none).collect()} == {"c"}  # the job of a did not run
    assert store.cleared(opened, ran("z"), none).isEmpty()
    gone = store.cleared(opened, ran("a", "c"), fired)
    marks = store.clear_markers(gone.withColumn("severity", F.lit("warning")), as_of).collect()
    assert [(r.uc, r.severity, r.score, r.payload) for r in marks] == [("a", "warning", 0.0, '{"entity":"e","firing":false,"clear":true}')]
    twice = spark.createDataFrame([anomaly("2024-01-05", score=1.0), anomaly("2024-01-05", score=7.0), anomaly("2024-01-05", score=3.0)], ANOMALY)
    assert [r.score for r in store.upsert(old.limit(0), twice, store.ANOMALY_KEY).collect()] == [7.0]
    assert store.outbox(gone.limit(1), firing=False).first().subject == "anomaly.a.e"


def test_save_replaces_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "t")
    store.save(spark.createDataFrame([anomaly("2024-01-01"), anomaly("2024-01-02")], ANOMALY), path, "time")
    store.save(spark.createDataFrame([anomaly("2024-01-02", "critical")], ANOMALY), path, "time")
    assert {(r.time.day, r.severity) for r in store.load(spark, path).collect()} == {(1, "info"), (2, "critical")}


def test_digest_arrow_and_clears(spark):
    until = F.lit("2024-01-15").cast("timestamp")
    rows = [anomaly("2024-01-10", "critical", metric=f"m{k}") for k in range(23)] + [anomaly("2024-01-03", metric=f"m{k}") for k in range(26)]
    df = spark.createDataFrame(rows, ANOMALY)
    r = digest.totals(digest.by_severity(df, until)).first()
    assert (r.total_now, r.total_prev, r.delta, r.arrow) == (23, 26, -3, "↓")
    assert "**Total this week: 23** (↓ 3 vs prior week, 26)" in digest.text(df, until).first().text
    cleared = spark.createDataFrame([anomaly("2024-01-10", firing="false")], ANOMALY)
    assert digest.totals(digest.by_severity(cleared, until, exclude_clears=True)).first().arrow == "→"
    null = spark.createDataFrame([(*anomaly("2024-01-10")[:6], None, None, None, "{}")], ANOMALY)
    assert "| m |  |  |  |" in digest.text(null, until).first().text


def test_pv_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"result": {"watts": {"2026-06-20 12:00:00": 5400, "2026-06-20 13:00:00": 5000}, "watt_hours_period": {"2026-06-20 12:00:00": 5000, "2026-06-20 13:00:00": 5600},'
        ' "watt_hours_day": {"2026-06-20": 31000, "2026-06-21": 24000}}}'
    )
    docs = readings.pv_documents(spark, str(tmp_path))
    noon = F.lit("2026-06-20 10:30:00").cast("timestamp")
    assert list(forecasts.pv_figures(docs, noon, "Europe/Berlin").first()) == [31.0, 24.0, 5.6, 5400.0]
    assert list(forecasts.pv_figures(docs, F.lit("2026-06-20 21:00:00").cast("timestamp"), "Europe/Berlin").first()) == [31.0, 24.0, 0.0, 0.0]
    empty = spark.createDataFrame([({}, {}, {})], "watts map<string,double>, watt_hours_period map<string,double>, watt_hours_day map<string,double>")
    assert list(forecasts.pv_figures(empty, noon, "UTC").first()) == [None] * 4
    assert forecasts.map_rows(empty, "watts", "UTC").count() == 0
    assert {r.forecast_for.hour for r in forecasts.map_rows(docs, "watts", "Europe/Berlin").collect()} == {10, 11}


def test_weather_arrays(spark):
    fields = {f: f for f in readings.WEATHER_METRICS}
    docs = spark.createDataFrame([(["a", "b"], *([1.0, 2.0] for _ in range(4)), [None, 2.0])], "time array<string>, " + ", ".join(f"{f} array<double>" for f in fields))
    assert forecasts.array_rows(docs, "time", fields).count() == 9
    short = docs.withColumn("precipitation", F.array(F.lit(1.0)))
    with pytest.raises(Exception, match="forecast array"):
        forecasts.array_rows(short, "time", fields).collect()


def test_weather_documents_and_scans(spark, tmp_path):
    arrays = ", ".join(f'"{f}": [1.0, 2.0]' for f in readings.WEATHER_METRICS)
    (tmp_path / "w.json").write_text('{"hourly": {"time": ["2026-01-01T00:00", "2026-01-01T01:00"], ' + arrays + "}}")
    rows = forecasts.array_rows(readings.weather_documents(spark, str(tmp_path)), "time", {f: f for f in readings.WEATHER_METRICS})
    assert rows.count() == 10
    df = spark.createDataFrame([("a", ts("2024-01-01")), ("b", ts("2024-01-02")), ("a", ts("2024-01-03"))], "ga string, ts timestamp")
    low, high = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-03").cast("timestamp")
    assert [r.ts.day for r in readings.channels(readings.between(df, low, high), ["a"]).collect()] == [3]


def test_models_are_tables(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(m, start + dt.timedelta(hours=k), [float(k % 7), float((k * 3) % 5)]) for m in ("a", "b") for k in range(80)]
    z = forest.scaled(df := spark.createDataFrame(rows, "model string, bucket timestamp, x array<double>"), forest.scales(df, 50))
    path, now = str(tmp_path / "models"), F.lit("2024-02-01").cast("timestamp")
    trees = forest.fit(z, trees=5)
    forest.save_models(trees, forest.thresholds(forest.score(z, trees), now), path)
    only_a = forest.fit(z.where("model = 'a'"), trees=3)
    forest.save_models(only_a, forest.thresholds(forest.score(z, only_a), now), path)
    trees, limits = forest.load_models(spark, path)
    assert {(r.model, r["count"]) for r in trees.select("model", "tree").distinct().groupBy("model").count().collect()} == {("a", 3), ("b", 5)}
    other = z.where("model = 'a'").withColumn("model", F.lit("unknown"))
    assert forest.score(z.unionByName(other), trees).select("model").distinct().count() == 2
    assert limits.count() == 2 and forest.classify(forest.score(z, trees), limits, now).count() == 160


def test_pv_underperformance_gate(spark):
    rows = spark.createDataFrame([(1, 6.5, 10.0), (2, 6.4, 10.0), (3, 4.9, 10.0), (4, 3.4, 10.0), (5, 0.1, 1.0)], "k int, actual_kwh double, expected_kwh double")
    out = energy.pv_underperformance(rows.select("k", "actual_kwh"), rows.select("k", "expected_kwh"), ["k"])
    assert [r.severity for r in out.orderBy("k").collect()] == [None, "info", "warning", "critical", None]


def test_rooms_by_channel_names(spark):
    catalog = spark.createDataFrame(
        [("1", "H.EG.Bad.FBH.Stellwert-Status", "Bad", "x"), ("2", "H.EG.Bad.FBH.Soll-Temperatur-Status", "Bad", "x"), ("3", "H.EG.Bad.Sensor.Temperatur", "Bad", "Sensorik"), ("4", "H.OG.Bad.Sensor.Temperatur", "Bad", "Sensorik"), ("5", "H.EG.x", None, "x")],
        "ga string, name string, room string, function string",
    )
    data = spark.createDataFrame([("1", 80.0), ("2", 21.0), ("3", 18.5), ("4", 5.0), ("5", 1.0)], "ga string, avg_value double")
    rooms = detectors.by_role(detectors.room_readings(data, catalog), ["room", "floor"], detectors.room_roles())
    got = detectors.cold_room(rooms).collect()
    assert [(r.room, r.floor, r.gap_c, r.severity) for r in got] == [("Bad", "EG", 2.5, "warning")]
    assert detectors.resolve_channel(catalog, "%Temperatur").first().ga == "3"


def test_use_case_tables(spark):
    families = usecases.families(spark)
    assert usecases.repeated_slugs(families).count() == 0 and usecases.bad_identifiers(usecases.profiles(spark)).count() == 0
    assert usecases.slugs(families).count() == 29
    assert usecases.profiles(spark).where("silenced").count() == 8
    bad = [usecases._profile("u", "Drop table", "m")]
    assert usecases.bad_identifiers(usecases.profiles(spark, bad)).count() == 1


def test_forest_finds_an_outlier_and_seasons_follow_a_wave(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("m", start + dt.timedelta(hours=k), [float(k % 7), float((k * 3) % 5)]) for k in range(300)] + [("m", dt.datetime(2024, 3, 1), [60.0, -40.0])]
    z = forest.scaled(df := spark.createDataFrame(rows, "model string, bucket timestamp, x array<double>"), forest.scales(df))
    trees = forest.fit(z, trees=30)
    scores = forest.score(z, trees, group_rows=3).orderBy("score").collect()
    assert scores[0].bucket == dt.datetime(2024, 3, 1) and len(scores) == 301
    import math

    wave = [("u", start + dt.timedelta(hours=k), 10 + 3 * math.sin(k * math.pi / 12) + 0.01 * (k % 5)) for k in range(400)]
    out = seasonal.forecast(spark.createDataFrame(wave, "uc string, bucket timestamp, y double"), ["uc"]).collect()
    assert len(out) == 24
    for r in out:
        k = int((r.forecast_for - start).total_seconds() // 3600)
        assert abs(r.forecast_value - 10 - 3 * math.sin(k * math.pi / 12)) < 0.5
    short = spark.createDataFrame(wave[:100], "uc string, bucket timestamp, y double")
    assert seasonal.forecast(short, ["uc"]).count() == 0


def test_scores_are_those_of_a_walk_down_each_tree(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("m", start + dt.timedelta(hours=k), [float(k * k % 31), float(k % 11)]) for k in range(60)]
    z = spark.createDataFrame(rows, "model string, bucket timestamp, z array<double>")
    trees = forest.fit(z, trees=7, subsample=16).cache()
    nodes = {(r.tree, r.node): r for r in trees.collect()}
    sizes = [r.size for (_, node), r in nodes.items() if node == 0]
    norm = float(forest.average_path(sum(sizes) / len(sizes)))
    for r in forest.score(z, trees, group_rows=13).collect():
        point = rows[int((r.bucket - start).total_seconds() // 3600)][2]
        paths = []
        for tree in range(7):
            at = 0
            while (node := nodes[tree, at]).feature >= 0:
                at = 2 * at + (1 if point[node.feature] < node.cut else 2)
            paths.append(node.depth + float(forest.average_path(node.size)))
        assert abs(r.score + 2 ** -(sum(paths) / 7 / norm)) < 1e-9


def test_second_training_keeps_the_first_time(spark):
    scores = spark.createDataFrame([("a", float(k)) for k in range(9)] + [("b", 1.0)], "model string, score double")
    early, late = (F.lit(f"2024-0{m}-01").cast("timestamp") for m in (1, 2))
    before = forest.thresholds(scores.where("model = 'a'"), early)
    got = {r.model: (r.trained_at.month, r.first_trained_at.month) for r in forest.thresholds(scores, late, before).collect()}
    assert got == {"a": (2, 1), "b": (2, 2)}
    young = F.lit("2024-02-03").cast("timestamp")
    low = spark.createDataFrame([("a", -1.0)], "model string, score double")
    limits = forest.thresholds(scores, late, before)
    assert forest.classify(low, limits, young).first().severity == "info"
    assert forest.classify(low, limits, young, since="first_trained_at").first().severity == "critical"


def test_look_back_counts_from_the_latest_closed_bucket(spark):
    hours = [ts(f"2024-01-01 {h:02d}:00:00") for h in (3, 4, 7, 9)]
    rows = spark.createDataFrame([(h, float(k)) for k, h in enumerate(hours)], "bucket timestamp, v double")
    as_of = F.lit("2024-01-01 08:30:00").cast("timestamp")
    last = rollup.look_back(rows, as_of, 4).collect()
    assert {(r.bucket.hour, r.v) for r in last} == {(7, 1.0), (7, 2.0)}
    every = rollup.look_back(rows, as_of, 2, "all").collect()
    assert {(r.bucket.hour, r.v) for r in every} == {(3, 0.0), (4, 0.0), (4, 1.0), (5, 1.0), (7, 2.0)}


def test_digest_of_no_anomalies(spark):
    none = spark.createDataFrame([], "time timestamp, source string, metric string, detector string, severity string, uc string, actual double, expected double, score double, payload string")
    text = digest.text(none, F.lit("2024-01-31").cast("timestamp")).first().text
    assert "**Total this week: 0** (→ 0 vs prior week, 0)" in text and "| critical | 0 |" in text
