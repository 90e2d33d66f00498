"""Rollups, baselines, z-scores, rules and time-series steps over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..functions import usecases
from ..operators import detectors as d
from ..operators import rollup as r
from ..operators import series as s
from .base import HOURLY, ON_AT, SCORED, as_of, events, hourly, plain, sites

KEYS = ["event_type"]


def a1_hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(hourly(spark, sf_dir))


def a2_baseline_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(r.baseline(hourly(spark, sf_dir), KEYS))


def a3_baseline_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(r.merge(r.baseline(hourly(spark, sf_dir), KEYS), [*KEYS, "hour_of_day", "weekday"]))


def a4_last_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(r.last_bucket(hourly(spark, sf_dir), as_of()).select("bucket", "event_type", "avg_value"))


def d1_zscore_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = d.zscore_profile(hourly(spark, sf_dir), KEYS, as_of())
    return plain(out.select("bucket", "event_type", F.col("avg_value").alias("actual"), "n", "mean", "stddev", "zscore", "severity"))


def d1_zscore_last_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = d.zscore_profile(hourly(spark, sf_dir), KEYS, as_of(), buckets="last", scope="unbounded")
    return plain(out.select("bucket", "event_type", F.col("avg_value").alias("actual"), "n", "mean", "stddev", "zscore", "severity"))


def h1_zscore_knobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = d.zscore_profile(hourly(spark, sf_dir), KEYS, as_of(), knobs={"rel": 0.15, "absolute": 5.0, "deadband_abs": 20.0, "deadband_rel": 0.25})
    return plain(out.where("zscore IS NOT NULL").select("bucket", "event_type", "zscore", "severity"))


def s12_registry_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    def case(uc, metric, **kw):
        base = dict(keys=["event_type"], silenced=False, rel=0.0, absolute=0.0, dead_abs=0.0, dead_rel=0.0, scope=None, emit=True) | kw
        return (uc, "events_1h", metric, base["keys"], "info", base["silenced"], base["rel"], base["absolute"], base["dead_abs"], base["dead_rel"], base["scope"], base["emit"])

    cases = [
        case("level", "avg_value", scope="event_type <> 'error'"),
        case("idle_floor", "min_value", absolute=5.0, dead_abs=2.0),
        case("activity", "total_samples", emit=False),
        case("quiet", "on_samples", silenced=True),
    ]
    out = d.fan_out({"events_1h": hourly(spark, sf_dir)}, usecases.profiles(spark, cases), as_of())
    return plain(out.select("uc", "label", "entity", "bucket", "value", "n", "mean", "zscore", "severity"))


def a23_job_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = d.zscore_profile(hourly(spark, sf_dir), KEYS, as_of()).withColumn("entity", x.slug(F.col("event_type")))
    return d.summary(scored.withColumn("uc", F.concat(F.lit("level_"), F.col("event_type"))), ["uc"])


def a22_fired_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = d.zscore_profile(hourly(spark, sf_dir), KEYS, as_of()).where("severity IS NOT NULL")
    return scored.select(F.lit("level").alias("uc"), x.slug(F.col("event_type")).alias("entity")).distinct()


def _rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    rows = readings.join(sites(spark, sf_dir), "user_id")
    kind = F.col("event_type")
    return d.by_role(
        rows, ["room", "floor", "day"],
        {"valve_pct": (kind == "view", "avg"), "target_c": (kind == "click", "avg"), "actual_c": (kind == "error", "avg"), "window_open": (kind == "signup", "max")}, value="value",
    )


def a5_role_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_rooms(spark, sf_dir))


def d2_cold_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(d.cold_room(_rooms(spark, sf_dir)).select("room", "floor", "day", "valve_pct", "target_c", "actual_c", "gap_c", "severity"))


def d3_window_while_heating(spark: SparkSession, sf_dir: str) -> DataFrame:
    outdoor = events(spark, sf_dir).where("event_type = 'purchase'").groupBy(F.to_date("ts").alias("day")).agg(F.avg("value").alias("outdoor_c"))
    out = d.window_while_heating(_rooms(spark, sf_dir), outdoor, ["day"], cold_below=48.0)
    return plain(out.select("room", "floor", "day", "window_open", "valve_pct", "outdoor_c", "severity"))


def w4_trailing_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = s.trailing_streak(hourly(spark, sf_dir), KEYS, x.hour_active(F.col("on_samples"), F.col("total_samples")))
    return plain(rows.select("event_type", "bucket", F.col("streak").cast("long").alias("streak")))


def d4_left_on_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = d.left_on_streak(hourly(spark, sf_dir), KEYS, as_of(), most_active=0.6)
    return plain(out.withColumn("streak", F.col("streak").cast("long")))


def a6_active_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hourly(spark, sf_dir)
    return plain(rows.groupBy("event_type").agg(F.avg((F.col("on_samples") / F.col("total_samples") >= 0.5).cast("double")).alias("active_rate"), F.count("*").alias("hours")))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).where("event_type <> 'error'")
    return s.runs(rows, ["user_id"], F.col("value") >= ON_AT, tie=["event_id"])


def w1_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_runs(spark, sf_dir).withColumn("minutes", F.round("minutes", 3)))


def j4_as_of_ambient(spark: SparkSession, sf_dir: str) -> DataFrame:
    ambient = events(spark, sf_dir).where("event_type = 'error'").select("ts", "value")
    found = s.as_of_join(_runs(spark, sf_dir), ambient, "start", "ts", "value", "ambient")
    return plain(found.withColumn("minutes", F.round("minutes", 3)))


def j4_as_of_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    left = rows.where("event_type = 'click'").select("event_id", "user_id", "ts")
    right = rows.where("event_type = 'view'").select("user_id", F.col("ts").alias("seen"), "value")
    return plain(s.as_of_join(left, right, "ts", "seen", "value", "latest_view", keys=["user_id"]))


def d5_run_length_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    ambient = events(spark, sf_dir).where("event_type = 'error'").select("ts", "value")
    found = s.as_of_join(_runs(spark, sf_dir), ambient, "start", "ts", "value", "ambient")
    return plain(d.run_length_drift(found, ["user_id"], most_minutes=1440.0, least_runs=2))


def a7_counter_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return plain(s.counter_delta(rows, ["user_id", "day"]))


def a8_floored_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return plain(s.floored_sum(s.counter_delta(rows, ["user_id", "day"]), ["day"]))


def a10_curve_integral(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return plain(s.integral(rows, ["event_type", "day"], tie=["event_id"]))


def a12_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(events(spark, sf_dir).groupBy("event_type").agg(F.percentile("value", F.lit(0.5)).alias("median"), F.count("*").alias("n")))


def p7_resolve_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("ga"), F.col("p_name").alias("name"))
    return d.resolve_channel(part, "%a%")


def p9_since_local_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    now = F.lit("2024-01-20 15:30:00").cast("timestamp")
    rows = rows.where((F.col("ts") >= x.local_midnight(now, "Europe/Berlin")) & (F.col("ts") <= now))
    return plain(rows.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")))


def t2_newest_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.newest_first(r.closed(hourly(spark, sf_dir), as_of()), KEYS, 24)
    return plain(rows.select("event_type", "bucket", F.col("nth").cast("long").alias("nth"), "avg_value"))


def a13_count_even_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _runs(spark, sf_dir).where(F.col("minutes") < 0)
    return found.agg(F.count("*").alias("n_runs"), F.percentile("minutes", F.lit(0.5)).alias("median_minutes"))


def p6_name_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_name").alias("name"), F.col("p_brand").alias("function"))
    name = F.col("name")
    flags = {"suffix": name.like("%a"), "infix": name.like("%l%e%") & ~name.like("%re%"), "upper": name.like("%A%")}
    return part.groupBy("function").agg(*(F.count_if(c).alias(k) for k, c in flags.items()))


def p8_deadband(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = d.zscore_profile(hourly(spark, sf_dir), KEYS, as_of(), knobs={"deadband_abs": 5.0, "deadband_rel": 0.5})
    return out.groupBy("event_type").agg(F.count("*").alias("n"), F.count("zscore").alias("outside"))


def p1_closed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.lit("2024-01-15 10:20:00").cast("timestamp")
    rows = r.closed(hourly(spark, sf_dir), at)
    rows = rows.where(F.col("bucket") > F.date_trunc("hour", at) - F.expr("INTERVAL 24 HOURS"))
    return plain(rows.select("bucket", "event_type", "total_samples"))


QUERIES = [
    a13_count_even_if_empty, p6_name_patterns, p8_deadband, p1_closed_buckets, a1_hourly_rollup, a2_baseline_state, a3_baseline_merge, a4_last_bucket, d1_zscore_profile, d1_zscore_last_bucket, h1_zscore_knobs,
    s12_registry_fan_out, a22_fired_entities, a23_job_counters, a5_role_pivot, d2_cold_room, d3_window_while_heating, w4_trailing_streak,
    d4_left_on_streak, a6_active_rate, w1_runs, j4_as_of_ambient, j4_as_of_by_key, d5_run_length_drift, a7_counter_delta, a8_floored_sum,
    a10_curve_integral, a12_median, p7_resolve_channel, p9_since_local_midnight, t2_newest_buckets,
]

_ROOMS = """rooms AS (
  SELECT c_mktsegment AS room, n_regionkey AS floor, date_trunc('day', ts) AS day,
    avg(value) FILTER (event_type = 'view') AS valve_pct, avg(value) FILTER (event_type = 'click') AS target_c,
    avg(value) FILTER (event_type = 'error') AS actual_c, max(value) FILTER (event_type = 'signup') AS window_open
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)"""

STREAK = (
    HOURLY
    + """, flags AS (
  SELECT *, coalesce(on_samples / nullif(total_samples, 0) >= 0.5, FALSE) AS active FROM hourly),
breaks AS (
  SELECT *, CASE WHEN NOT active OR NOT coalesce(lag(active) OVER o, FALSE)
      OR coalesce(bucket - lag(bucket) OVER o <> INTERVAL 1 HOUR, TRUE) THEN 1 ELSE 0 END AS brk
  FROM flags WINDOW o AS (PARTITION BY event_type ORDER BY bucket)),
grp AS (SELECT *, sum(brk) OVER (PARTITION BY event_type ORDER BY bucket) AS g FROM breaks),
streaks AS (
  SELECT *, CASE WHEN active THEN row_number() OVER (PARTITION BY event_type, g ORDER BY bucket) ELSE 0 END AS streak FROM grp)"""
)

_RUNS = """readings AS (
  SELECT *, value >= 40 AS running FROM events WHERE event_type <> 'error'),
marks AS (
  SELECT *, lead(ts) OVER o AS next_ts,
    CASE WHEN running AND NOT coalesce(lag(running) OVER o, FALSE) THEN 1 ELSE 0 END AS new_run
  FROM readings WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)),
ids AS (SELECT *, sum(new_run) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM marks),
runs AS (
  SELECT user_id, min(ts) AS start, (epoch_us(max(next_ts)) - epoch_us(min(ts))) / 1e6 / 60 AS minutes
  FROM ids WHERE running GROUP BY user_id, run)"""

_Z_COLUMNS = "bucket, event_type, round(actual, 7) AS actual, n, round(mean, 7) AS mean, round(sd, 7) AS stddev, round(zscore, 7) AS zscore, severity"

SQL = {
    "a13_count_even_if_empty": f"WITH {_RUNS} SELECT count(*) AS n_runs, quantile_cont(minutes, 0.5) AS median_minutes FROM runs WHERE minutes < 0",
    "p6_name_patterns": """SELECT p_brand AS function, count(*) FILTER (p_name LIKE '%a') AS suffix, count(*) FILTER (p_name LIKE '%l%e%' AND p_name NOT LIKE '%re%') AS infix,
  count(*) FILTER (p_name LIKE '%A%') AS upper FROM part GROUP BY 1""",
    "p8_deadband": f"WITH {SCORED} SELECT event_type, count(*) AS n, count(*) FILTER (sd > 0 AND abs(actual - mean) >= greatest(5.0, 0.5 * abs(mean))) AS outside FROM z GROUP BY 1",
    "p1_closed_buckets": f"WITH {HOURLY} SELECT bucket, event_type, total_samples FROM hourly WHERE bucket <= TIMESTAMP '2024-01-15 09:00:00' AND bucket > TIMESTAMP '2024-01-14 10:00:00'",
    "a1_hourly_rollup": f"WITH {HOURLY} SELECT bucket, event_type, round(avg_value, 7) AS avg_value, round(min_value, 7) AS min_value, total_samples, on_samples FROM hourly",
    "a2_baseline_state": f"""WITH {HOURLY} SELECT date_trunc('day', bucket) AS day, hour(bucket)::INTEGER AS hour_of_day, isodow(bucket)::INTEGER AS weekday, event_type,
  count(avg_value) AS n, round(avg(avg_value), 7) AS mean, round(var_pop(avg_value) * count(avg_value), 7) AS m2 FROM hourly GROUP BY 1, 2, 3, 4""",
    "a3_baseline_merge": f"""WITH {HOURLY} SELECT event_type, hour(bucket)::INTEGER AS hour_of_day, isodow(bucket)::INTEGER AS weekday, count(*) AS n,
  round(avg(avg_value), 7) AS mean, round(stddev_samp(avg_value), 7) AS stddev FROM hourly GROUP BY 1, 2, 3""",
    "a4_last_bucket": f"""WITH {HOURLY} SELECT bucket, event_type, round(avg_value, 7) AS avg_value FROM hourly
  WHERE bucket = (SELECT max(bucket) FROM hourly WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00')""",
    "d1_zscore_profile": f"WITH {SCORED} SELECT {_Z_COLUMNS} FROM profile",
    "d1_zscore_last_bucket": f"""WITH {HOURLY}, states AS (
  SELECT *, CAST(bucket AS DATE) AS day, hour(bucket) AS h, isodow(bucket) AS d FROM hourly WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00'),
scored AS (
  SELECT a.bucket, a.event_type, any_value(a.avg_value) AS actual, count(b.avg_value) AS n, avg(b.avg_value) AS mean, stddev_samp(b.avg_value) AS sd
  FROM states a JOIN states b ON a.event_type = b.event_type AND a.h = b.h AND a.d = b.d AND b.day > a.day - INTERVAL 60 DAY
  WHERE a.bucket = (SELECT max(bucket) FROM states) GROUP BY 1, 2),
z AS (SELECT *, CASE WHEN sd > 0 THEN (actual - mean) / sd END AS zscore FROM scored WHERE sd IS NOT NULL),
profile AS (SELECT *, CASE WHEN abs(zscore) >= 6 THEN 'critical' WHEN abs(zscore) >= 4 THEN 'warning' WHEN abs(zscore) >= 3 THEN 'info' END AS severity FROM z)
SELECT {_Z_COLUMNS} FROM profile""",
    "h1_zscore_knobs": f"""WITH {SCORED}, k AS (
  SELECT bucket, event_type, (actual - mean) / greatest(sd, 5.0, 0.15 * abs(mean)) AS zscore FROM z
  WHERE abs(actual - mean) >= greatest(20.0, 0.25 * abs(mean)))
SELECT bucket, event_type, round(zscore, 7) AS zscore, CASE WHEN abs(zscore) >= 6 THEN 'critical' WHEN abs(zscore) >= 4 THEN 'warning' WHEN abs(zscore) >= 3 THEN 'info' END AS severity FROM k""",
    "s12_registry_fan_out": f"""WITH {HOURLY}, long AS (
  SELECT 'level' AS uc, 'avg_value[' || event_type || ']' AS label, event_type AS entity, bucket, avg_value AS value, 0.0 AS floor_sd, 0.0 AS dead FROM hourly WHERE event_type <> 'error'
  UNION ALL SELECT 'idle_floor', 'min_value[' || event_type || ']', event_type, bucket, min_value, 5.0, 2.0 FROM hourly
  UNION ALL SELECT 'activity', 'total_samples[' || event_type || ']', NULL, bucket, total_samples, 0.0, 0.0 FROM hourly),
t AS (SELECT *, CAST(bucket AS DATE) AS day, hour(bucket) AS h, isodow(bucket) AS d FROM long),
s AS (
  SELECT a.uc, a.label, any_value(a.entity) AS entity, a.bucket, any_value(a.value) AS value, any_value(a.floor_sd) AS floor_sd, any_value(a.dead) AS dead,
    count(b.value) AS n, avg(b.value) AS mean, stddev_samp(b.value) AS sd
  FROM t a JOIN t b ON a.label = b.label AND a.h = b.h AND a.d = b.d AND b.day < a.day AND b.day > a.day - INTERVAL 60 DAY
  WHERE a.bucket <= TIMESTAMP '2024-01-30 23:00:00' GROUP BY a.uc, a.label, a.bucket),
z AS (SELECT *, CASE WHEN greatest(sd, floor_sd) > 0 AND abs(value - mean) >= dead THEN (value - mean) / greatest(sd, floor_sd) END AS zscore FROM s WHERE sd IS NOT NULL)
SELECT uc, label, entity, bucket, round(value, 7) AS value, n, round(mean, 7) AS mean, round(zscore, 7) AS zscore,
  CASE WHEN abs(zscore) >= 6 THEN 'critical' WHEN abs(zscore) >= 4 THEN 'warning' WHEN abs(zscore) >= 3 THEN 'info' END AS severity FROM z""",
    "a22_fired_entities": f"WITH {SCORED} SELECT DISTINCT 'level' AS uc, lower(event_type) AS entity FROM profile WHERE severity IS NOT NULL",
    "a23_job_counters": f"""WITH {SCORED} SELECT 'level_' || event_type AS uc, count(*) AS scanned, count(severity) AS hits,
  count(DISTINCT CASE WHEN severity IS NOT NULL THEN event_type END) AS entities FROM profile GROUP BY 1""",
    "a5_role_pivot": f"""WITH {_ROOMS} SELECT room, floor, day, round(valve_pct, 7) AS valve_pct, round(target_c, 7) AS target_c,
  round(actual_c, 7) AS actual_c, round(window_open, 7) AS window_open FROM rooms""",
    "d2_cold_room": f"""WITH {_ROOMS} SELECT room, floor, day, round(valve_pct, 7) AS valve_pct, round(target_c, 7) AS target_c, round(actual_c, 7) AS actual_c,
  round(target_c - actual_c, 7) AS gap_c, CASE WHEN target_c - actual_c >= 3 THEN 'critical' WHEN target_c - actual_c >= 2 THEN 'warning' ELSE 'info' END AS severity
FROM rooms WHERE valve_pct > 50 AND target_c - actual_c > 1""",
    "d3_window_while_heating": f"""WITH {_ROOMS}, o AS (SELECT date_trunc('day', ts) AS day, avg(value) AS outdoor_c FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT room, floor, day, round(window_open, 7) AS window_open, round(valve_pct, 7) AS valve_pct, round(outdoor_c, 7) AS outdoor_c,
  CASE WHEN valve_pct >= 50 THEN 'critical' WHEN valve_pct >= 25 THEN 'warning' ELSE 'info' END AS severity
FROM rooms JOIN o USING (day) WHERE window_open > 0 AND valve_pct > 0 AND outdoor_c < 48""",
    "w4_trailing_streak": f"WITH {STREAK} SELECT event_type, bucket, streak FROM streaks",
    "d4_left_on_streak": f"""WITH {STREAK}, rates AS (
  SELECT event_type, bucket, avg((on_samples / nullif(total_samples, 0) >= 0.5)::INT::DOUBLE) OVER (
    PARTITION BY event_type ORDER BY bucket RANGE BETWEEN INTERVAL 718 HOUR PRECEDING AND CURRENT ROW) AS active_rate FROM hourly
  WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00'),
c AS (SELECT event_type, bucket, least(streak, 24) AS streak FROM streaks WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00')
SELECT event_type, bucket, streak, round(active_rate, 7) AS active_rate,
  CASE WHEN streak >= 9 THEN 'critical' WHEN streak >= 6 THEN 'warning' ELSE 'info' END AS severity
FROM c JOIN rates USING (event_type, bucket) WHERE active_rate < 0.6 AND streak >= 3""",
    "a6_active_rate": f"WITH {HOURLY} SELECT event_type, round(avg((on_samples / total_samples >= 0.5)::INT::DOUBLE), 7) AS active_rate, count(*) AS hours FROM hourly GROUP BY 1",
    "w1_runs": f"WITH {_RUNS} SELECT user_id, start, round(minutes, 3) AS minutes FROM runs",
    "j4_as_of_ambient": f"""WITH {_RUNS}, a AS (SELECT ts, value FROM events WHERE event_type = 'error')
SELECT user_id, start, round(minutes, 3) AS minutes, round(a.value, 7) AS ambient FROM runs ASOF LEFT JOIN a ON runs.start >= a.ts""",
    "j4_as_of_by_key": """WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'), r AS (SELECT user_id, ts AS seen, value FROM events WHERE event_type = 'view')
SELECT event_id, l.user_id, ts, round(r.value, 7) AS latest_view FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.seen""",
    "d5_run_length_drift": f"""WITH {_RUNS}, a AS (SELECT ts, value FROM events WHERE event_type = 'error'),
w AS (SELECT user_id, minutes, a.value AS ambient FROM runs ASOF LEFT JOIN a ON runs.start >= a.ts),
m AS (SELECT user_id, count(*) AS n_runs, quantile_cont(minutes, 0.5) AS median_minutes FROM w WHERE minutes < 1440 AND ambient >= 24 GROUP BY 1)
SELECT user_id, n_runs, round(median_minutes, 7) AS median_minutes,
  CASE WHEN median_minutes >= 55 THEN 'critical' WHEN median_minutes >= 45 THEN 'warning' WHEN median_minutes >= 38 THEN 'info' END AS severity FROM m WHERE n_runs >= 2""",
    "a7_counter_delta": "SELECT user_id, date_trunc('day', ts) AS day, round(arg_max(value, ts) - arg_min(value, ts), 7) AS delta FROM events GROUP BY 1, 2",
    "a8_floored_sum": """WITH d AS (SELECT user_id, date_trunc('day', ts) AS day, arg_max(value, ts) - arg_min(value, ts) AS delta FROM events GROUP BY 1, 2)
SELECT day, round(coalesce(sum(greatest(delta, 0)), 0) / 1000, 7) AS kwh FROM d GROUP BY 1""",
    "a10_curve_integral": """WITH t AS (
  SELECT event_type, date_trunc('day', ts) AS day, (value + lag(value) OVER o) / 2 * (epoch_us(ts) - epoch_us(lag(ts) OVER o)) / 1e6 / 3600 AS area
  FROM events WINDOW o AS (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts, event_id))
SELECT event_type, day, round(coalesce(sum(area), 0), 7) AS area FROM t GROUP BY 1, 2""",
    "a12_median": "SELECT event_type, round(quantile_cont(value, 0.5), 7) AS median, count(*) AS n FROM events GROUP BY 1",
    "p7_resolve_channel": "SELECT min(p_partkey) AS ga FROM part WHERE p_name LIKE '%a%'",
    "p9_since_local_midnight": """SELECT event_type, count(*) AS n, round(sum(value), 7) AS total FROM events
  WHERE ts >= TIMESTAMP '2024-01-19 23:00:00' AND ts <= TIMESTAMP '2024-01-20 15:30:00' GROUP BY 1""",
    "t2_newest_buckets": f"""WITH {HOURLY}, o AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY bucket DESC) AS nth FROM hourly WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00')
SELECT event_type, bucket, nth, round(avg_value, 7) AS avg_value FROM o WHERE nth <= 24""",
}
