"""Jobs end to end: stored tables read back, look-backs in hours and days, the default use cases, messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..functions import usecases
from ..operators import detectors as d
from ..operators import digest as g
from ..operators import energy as e
from ..operators import forecasts as fc
from ..operators import rollup as r
from ..operators import series as s
from ..sources import readings, store
from .base import HOURLY, ON_AT, SCORED, as_of, events, hourly, plain, sites
from .model_queries import SQL as MODEL_SQL
from .model_queries import _pv_documents
from .table_queries import _HISTORY, _PRIOR, _WEEK, _old_and_new

KEYS = ["event_type"]


def s4_stored_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest bucket against a baseline table that was written before: only the days of the look-back are read."""
    path = store.work_folder(spark, "baseline")
    store.save(r.baseline(hourly(spark, sf_dir), KEYS).withColumnRenamed("day", "on_day"), path, "on_day")
    states = store.load(spark, path, "2023-12-02", "2024-01-30")
    rows = r.from_states(r.last_bucket(hourly(spark, sf_dir), as_of()), states, KEYS)
    rows = rows.where(x.usable(F.col("avg_value")) & x.usable(F.col("stddev")))
    rows = rows.withColumn("zscore", x.zscore(F.col("avg_value"), F.col("mean"), F.col("stddev")))
    return plain(rows.select("bucket", "event_type", F.col("avg_value").alias("actual"), "n", "mean", "stddev", "zscore", x.tier(F.abs("zscore"), 3.0, 4.0, 6.0).alias("severity")))


def s6_stored_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs write to one anomaly table; the digest counts what is stored."""
    old, new = _old_and_new(spark, sf_dir)
    path = store.work_folder(spark, "anomalies")
    store.save(old, path, "time")
    store.save(store.upsert(store.load(spark, path, "2024-01-24"), new, store.ANOMALY_KEY), path, "time")  # the touched days only
    return g.by_severity(store.load(spark, path, "2024-01-17", "2024-01-30"), as_of())


def d2_cold_room_two_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rooms by the averages of their last two hourly buckets, at every closed bucket."""
    rows = events(spark, sf_dir).where("event_type IN ('view', 'click', 'error')").join(sites(spark, sf_dir), "user_id")
    rows = r.look_back(r.hourly(rows, ["room", "event_type"]), as_of(), 2, "all")
    kind = F.col("event_type")
    rooms = d.by_role(rows, ["room", "bucket"], {"valve_pct": (kind == "view", "avg"), "target_c": (kind == "click", "avg"), "actual_c": (kind == "error", "avg")})
    return plain(d.cold_room(rooms).select("room", "bucket", "valve_pct", "target_c", "actual_c", "gap_c", "severity"))


def d2_cold_room_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same at the latest closed bucket only; all rooms, cold or not."""
    rows = events(spark, sf_dir).where("event_type IN ('view', 'click', 'error')").join(sites(spark, sf_dir), "user_id")
    rows = r.look_back(r.hourly(rows, ["room", "event_type"]), as_of(), 2)
    return plain(rows.groupBy("room", "bucket").agg(F.avg("avg_value").alias("level"), F.count("*").alias("n")))


def d5_run_length_drift_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lengths per room over the last 21 days, at least 15 runs."""
    rows = readings.between(events(spark, sf_dir), as_of() - F.expr("INTERVAL 21 DAYS"), as_of())
    ambient = rows.where("event_type = 'error'").select("ts", "value")
    running = rows.where("event_type <> 'error'").join(sites(spark, sf_dir), "user_id")
    found = s.as_of_join(s.runs(running, ["room", "floor"], F.col("value") >= ON_AT, tie=["event_id"]), ambient, "start", "ts", "value", "ambient")
    return plain(d.run_length_drift(found, ["room", "floor"]))


#: Key columns of the default use cases and what stands for them in the events.
_KEY_SQL = {"inverter_id": "length(event_type)", "meter_id": "length(event_type) % 4", "ga": "event_type", "knx_name": "CASE WHEN event_type = 'error' THEN 'Keller.Stromwert' ELSE event_type END"}
_ONE_CHANNEL = "event_type = 'click'"
_METER_CHANNELS = "event_type IN ('click', 'signup')"
_INVERTER_CHANNELS = "event_type IN ('view', 'purchase')"


def _channels(keys: list[str]) -> str:
    """Which events a source of such keys has, so that the keys tell its rows apart."""
    return {"": _ONE_CHANNEL, "inverter_id": _INVERTER_CHANNELS, "meter_id": _METER_CHANNELS}.get(",".join(keys), "TRUE")


def s12_default_use_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All default profile use cases in one plan; a source's metrics are its hourly averages, each moved by its own place."""
    base, wide = hourly(spark, sf_dir), {}
    for source in {p[1] for p in usecases.PROFILES}:
        mine = [p for p in usecases.PROFILES if p[1] == source]
        named = [F.expr(_KEY_SQL[k]).alias(k) for k in mine[0][3]]
        wide[source] = base.where(_channels(mine[0][3])).select("bucket", *named, *((F.col("avg_value") + k).alias(p[2]) for k, p in enumerate(mine)))
    out = d.fan_out(wide, usecases.profiles(spark), as_of())
    return plain(out.select("uc", "label", "entity", "bucket", "value", "n", "mean", "zscore", "severity"))


def d12_pv_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of the day's forecast document as value messages; a figure that is not known is no message."""
    figures = fc.pv_figures(_pv_documents(spark, sf_dir), F.lit("2024-01-20 12:30:00").cast("timestamp"), "UTC", keep=["day"]).where("day = DATE'2024-01-20'")
    return _values(store.value_messages(figures, "pv", ["energy_today_kwh", "energy_tomorrow_kwh", "remaining_today_kwh", "power_now_w"]))


def d11_energy_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The energy balance since local midnight as value messages."""
    now = F.lit("2024-01-20 15:30:00").cast("timestamp")
    rows = events(spark, sf_dir).where((F.col("ts") >= x.local_midnight(now, "Europe/Berlin")) & (F.col("ts") <= now)).withColumn("day", F.lit("2024-01-20"))
    made = s.counter_delta(rows.where("event_type = 'view'"), ["user_id", "day"])
    meters = s.counter_delta(rows.where("event_type IN ('click', 'purchase')"), ["event_type", "day"])
    balance = e.energy_balance(made, meters, ["day"], F.col("event_type") == "click", F.col("event_type") == "purchase")
    return _values(store.value_messages(balance, "energy", BALANCE))


BALANCE = ["generation_kwh", "import_kwh", "export_kwh", "consumption_kwh", "direct_use_kwh", "self_consumption_pct", "self_sufficiency_pct"]


def _values(messages: DataFrame) -> DataFrame:
    return plain(messages.select("subject", F.get_json_object("body", "$.value").cast("double").alias("value")))


QUERIES = [
    s4_stored_baseline, s6_stored_anomalies, d2_cold_room_two_hours, d2_cold_room_now, d5_run_length_drift_days, s12_default_use_cases, d12_pv_messages, d11_energy_messages,
]

_ROOM_HOURS = """cells AS (
  SELECT c_mktsegment AS room, event_type, date_trunc('hour', ts) AS bucket, avg(value) AS avg_value FROM events JOIN customer ON user_id = c_custkey
  WHERE event_type IN ('view', 'click', 'error') GROUP BY 1, 2, 3),
shut AS (SELECT * FROM cells WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00')"""

_SINCE = "ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-31'"


def _long_sql() -> str:
    """One SELECT for each default use case that is not silenced."""
    place, parts = {}, []
    for uc, source, metric, keys, _, silenced, rel, absolute, dead_abs, dead_rel, scope, emit in usecases.PROFILES:
        k = place[source] = place.get(source, -1) + 1
        if silenced:
            continue
        named = [_KEY_SQL[c] for c in keys]
        label = f"'{metric}[' || " + " || ',' || ".join(f"({c})" for c in named) + " || ']'" if keys else f"'{metric}'"
        who = {"inverter_id": "'inv' || length(event_type)", "meter_id": "'meter' || (length(event_type) % 4)", "ga": "event_type"}[keys[0]] if keys and emit else "NULL"
        where = f"({_channels(keys)})" + (f" AND ({scope.replace('knx_name', '(' + _KEY_SQL['knx_name'] + ')')})" if scope else "")
        parts.append(f"SELECT '{uc}' AS uc, {label} AS label, {who} AS entity, bucket, avg_value + {k} AS value, {rel} AS rel, {absolute} AS abso, {dead_abs} AS dead, {dead_rel} AS dead_rel FROM hourly WHERE {where}")
    return "\n  UNION ALL ".join(parts)


_BALANCE = MODEL_SQL["d11_energy_balance"].replace("FROM events)", "FROM events WHERE ts >= TIMESTAMP '2024-01-19 23:00:00' AND ts <= TIMESTAMP '2024-01-20 15:30:00')").replace("date_trunc('day', ts) AS day", "DATE '2024-01-20' AS day")

SQL = {
    "s4_stored_baseline": f"""WITH {SCORED} SELECT bucket, event_type, round(actual, 7) AS actual, n, round(mean, 7) AS mean, round(sd, 7) AS stddev, round(zscore, 7) AS zscore, severity
FROM profile WHERE bucket = (SELECT max(bucket) FROM hourly WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00')""",
    "s6_stored_anomalies": f"""WITH {_HISTORY}, t AS (SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (time, metric))
SELECT s.severity, count(*) FILTER ({_WEEK}) AS n_now, count(*) FILTER ({_PRIOR}) AS n_prev FROM (VALUES ('info'), ('warning'), ('critical')) s(severity) LEFT JOIN t ON t.severity = s.severity GROUP BY 1""",
    "d2_cold_room_two_hours": f"""WITH {_ROOM_HOURS}, seen AS (
  SELECT room, event_type, avg_value, bucket + k * INTERVAL 1 HOUR AS bucket FROM shut, (VALUES (0), (1)) v(k)),
rooms AS (
  SELECT room, bucket, avg(avg_value) FILTER (event_type = 'view') AS valve_pct, avg(avg_value) FILTER (event_type = 'click') AS target_c, avg(avg_value) FILTER (event_type = 'error') AS actual_c
  FROM seen WHERE bucket <= (SELECT max(bucket) FROM shut) GROUP BY 1, 2)
SELECT room, bucket, round(valve_pct, 7) AS valve_pct, round(target_c, 7) AS target_c, round(actual_c, 7) AS actual_c, round(target_c - actual_c, 7) AS gap_c,
  CASE WHEN target_c - actual_c >= 3 THEN 'critical' WHEN target_c - actual_c >= 2 THEN 'warning' ELSE 'info' END AS severity FROM rooms WHERE valve_pct > 50 AND target_c - actual_c > 1""",
    "d2_cold_room_now": f"""WITH {_ROOM_HOURS}, e AS (SELECT max(bucket) AS last FROM shut)
SELECT room, last AS bucket, round(avg(avg_value), 7) AS level, count(*) AS n FROM shut, e WHERE bucket > last - INTERVAL 2 HOUR GROUP BY 1, 2""",
    "d5_run_length_drift_days": f"""WITH readings AS (
  SELECT c_mktsegment AS room, n_regionkey AS floor, event_id, ts, value >= 40 AS running FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE event_type <> 'error' AND {_SINCE}),
marks AS (
  SELECT *, lead(ts) OVER o AS next_ts, CASE WHEN running AND NOT coalesce(lag(running) OVER o, FALSE) THEN 1 ELSE 0 END AS new_run
  FROM readings WINDOW o AS (PARTITION BY room, floor ORDER BY ts, event_id)),
ids AS (SELECT *, sum(new_run) OVER (PARTITION BY room, floor ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM marks),
runs AS (SELECT room, floor, min(ts) AS start, (epoch_us(max(next_ts)) - epoch_us(min(ts))) / 1e6 / 60 AS minutes FROM ids WHERE running GROUP BY room, floor, run),
a AS (SELECT ts, value FROM events WHERE event_type = 'error' AND {_SINCE}),
w AS (SELECT room, floor, minutes, a.value AS ambient FROM runs ASOF LEFT JOIN a ON runs.start >= a.ts),
m AS (SELECT room, floor, count(*) AS n_runs, quantile_cont(minutes, 0.5) AS median_minutes FROM w WHERE minutes < 180 AND ambient >= 24 GROUP BY 1, 2)
SELECT room, floor, n_runs, round(median_minutes, 7) AS median_minutes,
  CASE WHEN median_minutes >= 55 THEN 'critical' WHEN median_minutes >= 45 THEN 'warning' WHEN median_minutes >= 38 THEN 'info' END AS severity FROM m WHERE n_runs >= 15""",
    "s12_default_use_cases": f"""WITH {HOURLY}, long AS ({_long_sql()}),
t AS (SELECT *, CAST(bucket AS DATE) AS day, hour(bucket) AS h, isodow(bucket) AS d FROM long),
s AS (
  SELECT a.uc, a.label, any_value(a.entity) AS entity, a.bucket, any_value(a.value) AS value, any_value(a.rel) AS rel, any_value(a.abso) AS abso, any_value(a.dead) AS dead, any_value(a.dead_rel) AS dead_rel,
    count(b.value) AS n, avg(b.value) AS mean, stddev_samp(b.value) AS sd
  FROM t a JOIN t b ON a.uc = b.uc AND a.label = b.label AND a.h = b.h AND a.d = b.d AND b.day < a.day AND b.day > a.day - INTERVAL 60 DAY
  WHERE a.bucket <= TIMESTAMP '2024-01-30 23:00:00' GROUP BY a.uc, a.label, a.bucket),
z AS (SELECT *, CASE WHEN greatest(sd, abso, rel * abs(mean)) > 0 AND abs(value - mean) >= greatest(dead, dead_rel * abs(mean)) THEN (value - mean) / greatest(sd, abso, rel * abs(mean)) END AS zscore FROM s WHERE sd IS NOT NULL)
SELECT uc, label, entity, bucket, round(value, 7) AS value, n, round(mean, 7) AS mean, round(zscore, 7) AS zscore,
  CASE WHEN abs(zscore) >= 6 THEN 'critical' WHEN abs(zscore) >= 4 THEN 'warning' WHEN abs(zscore) >= 3 THEN 'info' END AS severity FROM z""",
    "d12_pv_messages": f"""WITH f AS ({MODEL_SQL["a19_a21_pv_figures"]})
SELECT 'pv.' || name AS subject, value FROM (UNPIVOT (SELECT energy_today_kwh, energy_tomorrow_kwh, remaining_today_kwh, power_now_w FROM f WHERE day = TIMESTAMP '2024-01-20')
  ON energy_today_kwh, energy_tomorrow_kwh, remaining_today_kwh, power_now_w INTO NAME name VALUE value)""",
    "d11_energy_messages": f"""WITH f AS ({_BALANCE}) SELECT 'energy.' || name AS subject, value FROM (UNPIVOT (SELECT {", ".join(BALANCE)} FROM f) ON {", ".join(BALANCE)} INTO NAME name VALUE value)""",
}
