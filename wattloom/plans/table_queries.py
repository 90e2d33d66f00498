"""Keyed tables, publish gate, digest, use-case tables and expression checks over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..functions import usecases
from ..operators import detectors as d
from ..operators import digest as g
from ..sources import store
from .base import SCORED, as_of, events, hourly, plain, sites
from .profile_queries import STREAK

LATER_TEXT = "2024-01-24 00:00:00"


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All firing buckets of the profile detector as anomaly rows."""
    rows = d.zscore_profile(hourly(spark, sf_dir), ["event_type"], as_of()).where("severity IS NOT NULL")
    body = F.to_json(F.struct(x.slug(F.col("event_type")).alias("entity"), F.lit(True).alias("firing")), {"ignoreNullFields": "false"})
    return rows.select(
        F.col("bucket").alias("time"), F.lit("events_1h").alias("source"), x.metric_label("avg_value", F.col("event_type")).alias("metric"), F.lit("zscore").alias("detector"),
        "severity", F.concat(F.lit("level_"), "event_type").alias("uc"), F.col("avg_value").alias("actual"), F.col("mean").alias("expected"), F.col("zscore").alias("score"), body.alias("payload"),
    )


def _old_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The table before a run, with milder severities, and the rows of the run, which overlap in time."""
    rows = history(spark, sf_dir)
    old = rows.where(F.col("time") < F.lit("2024-01-26").cast("timestamp")).withColumn("severity", F.lit("info"))
    return old, rows.where(F.col("time") >= F.lit(LATER_TEXT).cast("timestamp")).withColumn("score", -F.col("score"))


COLUMNS = ["time", "metric", "severity", "actual", "expected", "score"]


def k1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return plain(store.upsert(old, new, store.ANOMALY_KEY).select(*COLUMNS))


def k2_upsert_some_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    new = new.withColumns({"actual": F.lit(None).cast("double"), "expected": F.lit(None).cast("double")})
    return plain(store.upsert(old, new, store.ANOMALY_KEY, ["severity", "uc", "score", "payload"]).select(*COLUMNS))


def j9_old_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return plain(store.changes(old, new, store.ANOMALY_KEY).select("time", "metric", "severity", "old_severity", "inserted"))


def d10_publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return plain(store.to_publish(store.changes(old, new, store.ANOMALY_KEY)).select("time", "metric", "severity"))


def k7_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(spark, sf_dir).withColumn("entity", F.get_json_object("payload", "$.entity"))
    out = store.outbox(rows)
    return out.select("subject", F.get_json_object("body", "$.severity").alias("severity"), F.get_json_object("body", "$.level").cast("int").alias("level")).groupBy("subject", "severity", "level").count().withColumnRenamed("count", "n")


def k8_value_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = events(spark, sf_dir).agg(F.count("*").alias("n_readings"), F.countDistinct("user_id").alias("n_sites"), F.lit(None).cast("long").alias("absent"))
    return store.value_messages(row, "stats", ["n_readings", "n_sites", "absent"])


def w5_open_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(store.open_entities(history(spark, sf_dir), as_of()).select("uc", "entity", "time", "severity"))


def d9_auto_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(spark, sf_dir)
    fired = rows.where(F.col("time") >= F.lit("2024-01-30 18:00:00").cast("timestamp")).withColumn("entity", F.get_json_object("payload", "$.entity"))
    ran = rows.where("uc <> 'level_purchase'")  # that job did not run
    gone = store.cleared(store.open_entities(rows, as_of()), ran, fired)
    return plain(store.clear_markers(gone, as_of()).select("time", "uc", "metric", "severity", "score", "payload"))


def a23_job_counters_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return store.counters(store.changes(old, new, store.ANOMALY_KEY))


def h19_bad_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Use cases of the part table whose source, metric or key is no plain identifier."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    named = part.select("p_partkey", F.lower("p_type").alias("source"), F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(F.lower(F.replace("p_brand", F.lit("#"), F.lit("_")))).alias("metric"), F.array(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("keys"))
    return usecases.bad_identifiers(named).select("p_partkey", "source", "metric")


def k5_insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return plain(store.insert_missing(old, new, store.ANOMALY_KEY).select(*COLUMNS))


def d14_digest_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.by_severity(history(spark, sf_dir), as_of())


def d14_digest_by_use_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.by_use_case(history(spark, sf_dir), as_of())


def d14_digest_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(g.top(history(spark, sf_dir), as_of()).select("time", "severity", "uc", "metric", "score", "actual", "expected"))


def d14_digest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.totals(g.by_severity(history(spark, sf_dir), as_of()))


def k9_digest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.text(history(spark, sf_dir), as_of())


def _families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Use cases as the part table has them: families are brands, slugs are types."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select(F.col("p_brand").alias("family"), x.slug(F.col("p_type")).alias("uc")).distinct()


def u1_all_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usecases.slugs(_families(spark, sf_dir))


def u5_repeated_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usecases.repeated_slugs(_families(spark, sf_dir))


def h4_entity_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sites(spark, sf_dir)
    inverter = x.entity({"inverter_id": F.col("user_id")})
    joined = x.entity({"room": F.col("room"), "floor": F.col("floor")})
    address = x.entity({"ga": F.concat_ws("/", F.col("floor").cast("string"), F.col("user_id").cast("string"), F.lit("Gäste WC"))})
    return rows.select("user_id", inverter.alias("inverter"), joined.alias("place"), address.alias("address"), x.entity({"meter_id": F.col("user_id")}).alias("meter"))


def h6_h18_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sites(spark, sf_dir)
    name = F.concat_ws(".", F.lit("FBH"), F.concat(F.lit("F"), F.col("floor").cast("string")), F.col("room"))
    return rows.select("user_id", x.floor_of(name).alias("floor"), x.floor_of(F.col("room")).alias("no_floor"), F.concat_ws(" ", x.floor_of(name), F.col("room")).alias("label"), x.metric_label("avg_value", F.col("room"), F.col("user_id")).alias("metric"))


def h7_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    out = rows.select("event_id", F.date_trunc("hour", "ts").alias("hour"), F.date_trunc("day", "ts").alias("day"), F.hour("ts").alias("h"), (F.weekday("ts") + F.lit(1)).alias("d"), x.seconds_between(F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY"), F.date_trunc("hour", "ts")).alias("left_s"))
    return plain(out)


def h8_local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderdate").distinct()
    noon = F.concat(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd"), F.lit(" 12:00:00"))
    return plain(orders.select(F.col("o_orderdate").cast("timestamp").alias("day"), x.to_utc(noon, "Europe/Berlin").alias("utc")))


def h10_energy_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hourly(spark, sf_dir).groupBy("bucket").agg(
        *(F.coalesce(F.max(F.when(F.col("event_type") == k, F.col("avg_value"))), F.lit(0.0)).alias(a) for k, a in (("view", "made"), ("click", "bought"), ("error", "sold")))
    )
    return plain(rows.select("bucket", *(c.alias(k) for k, c in x.balance(F.col("made"), F.col("bought"), F.col("sold")).items())))


def h3_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    cols: dict[str, Column] = {
        "z": x.tier(v, 3, 4, 6), "gap": x.tier(v, 1, 2, 3), "valve": x.tier(v, 0, 25, 50, strict_info=True), "ratio": x.tier(v / 100, 0.65, 0.5, 0.35, below=True), "median": x.tier(v, 38, 45, 55),
    }
    rows = events(spark, sf_dir).select("event_id", *(c.alias(k) for k, c in cols.items()))
    return rows.withColumn("rank", x.severity_rank(F.col("z"))).withColumn("floored", x.at_least(F.col("median"), "warning")).withColumn("rose", x.escalated(F.col("ratio"), F.col("median")))


def h13_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.array_contains(F.json_object_keys("props"), "k").alias("has_k"), F.array_contains(F.json_object_keys("props"), "entity").alias("has_entity"))
    return rows


def u2_all_detectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(spark, sf_dir)
    streaks = d.left_on_streak(hourly(spark, sf_dir), ["event_type"], as_of(), most_active=0.6)
    streaks = streaks.select(F.col("bucket").alias("time"), F.lit("events_1h").alias("source"), x.metric_label("streak", F.col("event_type")).alias("metric"), F.lit("rule").alias("detector"), "severity", F.lit("appliance_runtime").alias("uc"), F.col("streak").cast("double").alias("score"))
    both = rows.unionByName(streaks, allowMissingColumns=True)
    return plain(both.groupBy("detector", "severity", "uc").agg(F.count("*").alias("n"), F.count("actual").alias("with_actual")))


QUERIES = [
    k1_upsert, k2_upsert_some_columns, k5_insert_missing, j9_old_severity, d10_publish_gate, k7_outbox, k8_value_messages, w5_open_entities, d9_auto_clear, a23_job_counters_written, h19_bad_identifiers,
    d14_digest_by_severity, d14_digest_by_use_case, d14_digest_top, d14_digest_totals, k9_digest_text, u1_all_slugs, u5_repeated_slugs, h4_entity_slug,
    h6_h18_names, h7_calendar, h8_local_time, h10_energy_expressions, h3_tiers, h13_json, u2_all_detectors,
]

_HISTORY = (
    SCORED
    + """, history AS (
  SELECT bucket AS time, 'avg_value[' || event_type || ']' AS metric, severity, 'level_' || event_type AS uc, event_type AS entity,
    actual, mean AS expected, zscore AS score FROM profile WHERE severity IS NOT NULL),
old AS (SELECT * REPLACE ('info' AS severity) FROM history WHERE time < TIMESTAMP '2024-01-26'),
new AS (SELECT * REPLACE (-score AS score) FROM history WHERE time >= TIMESTAMP '2024-01-24')"""
)
_RANK = "CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END"
_ROW = "time, metric, severity, round(actual, 7) AS actual, round(expected, 7) AS expected, round(score, 7) AS score"
_TIER = "CASE WHEN {v} >= {c} THEN 'critical' WHEN {v} >= {b} THEN 'warning' WHEN {v} {op} {a} THEN 'info' END"
_SLUG = "trim(regexp_replace(replace(replace(replace(replace(lower({}), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '[^a-z0-9]+', '-', 'g'), '-')"
_WEEK = "time >= TIMESTAMP '2024-01-24' AND time < TIMESTAMP '2024-01-31'"
_PRIOR = "time >= TIMESTAMP '2024-01-17' AND time < TIMESTAMP '2024-01-24'"

SQL = {
    "k1_upsert": f"WITH {_HISTORY}, t AS (SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (time, metric)) SELECT {_ROW} FROM t",
    "k2_upsert_some_columns": f"""WITH {_HISTORY}, t AS (
  SELECT coalesce(n.time, o.time) AS time, coalesce(n.metric, o.metric) AS metric, coalesce(n.severity, o.severity) AS severity,
    o.actual, o.expected, coalesce(n.score, o.score) AS score FROM old o FULL JOIN new n ON o.time = n.time AND o.metric = n.metric)
SELECT {_ROW} FROM t""",
    "k5_insert_missing": f"WITH {_HISTORY}, t AS (SELECT * FROM old UNION ALL SELECT * FROM new ANTI JOIN old USING (time, metric)) SELECT {_ROW} FROM t",
    "j9_old_severity": f"WITH {_HISTORY} SELECT n.time, n.metric, n.severity, o.severity AS old_severity, o.time IS NULL AS inserted FROM new n LEFT JOIN old o ON n.time = o.time AND n.metric = o.metric",
    "d10_publish_gate": f"WITH {_HISTORY} SELECT n.time, n.metric, n.severity FROM new n LEFT JOIN old o ON n.time = o.time AND n.metric = o.metric WHERE o.time IS NULL OR n.severity <> 'info'",
    "k7_outbox": f"WITH {_HISTORY} SELECT 'anomaly.' || uc || '.' || entity AS subject, severity, {_RANK} AS level, count(*) AS n FROM history GROUP BY 1, 2, 3",
    "k8_value_messages": """SELECT 'stats.n_readings' AS subject, '{"value":' || count(*) || '}' AS body FROM events
UNION ALL SELECT 'stats.n_sites', '{"value":' || count(DISTINCT user_id) || '}' FROM events""",
    "w5_open_entities": f"WITH {_HISTORY} SELECT uc, entity, max(time) AS time, arg_max(severity, time) AS severity FROM history WHERE time > TIMESTAMP '2024-01-24' GROUP BY 1, 2",
    "a23_job_counters_written": f"""WITH {_HISTORY}, c AS (SELECT n.uc, n.severity, o.time IS NULL AS fresh, o.severity AS was FROM new n LEFT JOIN old o ON n.time = o.time AND n.metric = o.metric)
SELECT uc, count(*) AS hits, count(*) FILTER (fresh) AS inserted,
  count(*) FILTER (fresh OR list_position(['info', 'warning', 'critical'], severity) > list_position(['info', 'warning', 'critical'], was)) AS published FROM c GROUP BY 1""",
    "h19_bad_identifiers": """WITH p AS (SELECT p_partkey, lower(p_type) AS source, CASE WHEN p_size > 25 THEN p_brand ELSE lower(replace(p_brand, '#', '_')) END AS metric, replace(p_name, ' ', '_') AS k FROM part)
SELECT p_partkey, source, metric FROM p WHERE NOT (regexp_matches(source, '^[a-z_][a-z0-9_]*$') AND regexp_matches(metric, '^[a-z_][a-z0-9_]*$') AND regexp_matches(k, '^[a-z_][a-z0-9_]*$'))""",
    "d9_auto_clear": f"""WITH {_HISTORY}, o AS (
  SELECT uc, entity, arg_max(metric, time) AS metric, arg_max(severity, time) AS severity FROM history WHERE time > TIMESTAMP '2024-01-24' GROUP BY 1, 2)
SELECT TIMESTAMP '2024-01-31' AS time, uc, metric, severity, 0.0::DOUBLE AS score, '{{"entity":"' || entity || '","firing":false,"clear":true}}' AS payload
FROM o WHERE uc <> 'level_purchase' AND NOT EXISTS (SELECT 1 FROM history h WHERE h.uc = o.uc AND h.entity = o.entity AND h.time >= TIMESTAMP '2024-01-30 18:00:00')""",
    "d14_digest_by_severity": f"""WITH {_HISTORY} SELECT s.severity, count(*) FILTER ({_WEEK}) AS n_now, count(*) FILTER ({_PRIOR}) AS n_prev
FROM (VALUES ('info'), ('warning'), ('critical')) s(severity) LEFT JOIN history h ON h.severity = s.severity GROUP BY 1""",
    "d14_digest_by_use_case": f"WITH {_HISTORY} SELECT uc, count(*) AS n FROM history WHERE {_WEEK} GROUP BY 1",
    "d14_digest_top": f"""WITH {_HISTORY} SELECT time, severity, uc, metric, round(score, 7) AS score, round(actual, 7) AS actual, round(expected, 7) AS expected
FROM history WHERE {_WEEK} ORDER BY {_RANK} DESC, abs(history.score) DESC NULLS LAST, time, metric LIMIT 10""",
    "d14_digest_totals": f"""WITH {_HISTORY}, c AS (SELECT count(*) FILTER ({_WEEK}) AS total_now, count(*) FILTER ({_PRIOR}) AS total_prev FROM history)
SELECT total_now, total_prev, total_now - total_prev AS delta, CASE WHEN total_now > total_prev THEN '↑' WHEN total_now < total_prev THEN '↓' ELSE '→' END AS arrow FROM c""",
    "k9_digest_text": f"""WITH {_HISTORY}, w AS (SELECT * FROM history WHERE {_WEEK}),
c AS (SELECT count(*) AS a, (SELECT count(*) FROM history WHERE {_PRIOR}) AS b FROM w),
sev AS (SELECT string_agg('| ' || s || ' | ' || n || ' |', chr(10) ORDER BY k) AS t FROM (
  SELECT s, k, (SELECT count(*) FROM w WHERE severity = s) AS n FROM (VALUES ('critical', 1), ('warning', 2), ('info', 3)) v(s, k))),
ucs AS (SELECT coalesce(string_agg('| ' || uc || ' | ' || n || ' |', chr(10) ORDER BY n DESC, uc), '') AS t FROM (SELECT uc, count(*) AS n FROM w GROUP BY 1)),
top AS (SELECT coalesce(string_agg('| ' || strftime(time, '%Y-%m-%d %H:%M') || ' | ' || severity || ' | ' || uc || ' | ' || metric || ' | ' || printf('%.2f', round(score, 7) + sign(score) * 1e-9) || ' | ' || printf('%.2f', round(actual, 7) + sign(actual) * 1e-9) || ' | ' || printf('%.2f', round(expected, 7) + sign(expected) * 1e-9) || ' |', chr(10)
    ORDER BY {_RANK} DESC, abs(score) DESC, time, metric), '') AS t FROM (SELECT * FROM w ORDER BY {_RANK} DESC, abs(score) DESC, time, metric LIMIT 10))
SELECT concat_ws(chr(10), '# Weekly Anomaly Digest — 2024-01-31', '', 'Window: 2024-01-24 → 2024-01-31 (7 days)', '',
  '**Total this week: ' || c.a || '** (' || CASE WHEN c.a > c.b THEN '↑' WHEN c.a < c.b THEN '↓' ELSE '→' END || ' ' || abs(c.a - c.b) || ' vs prior week, ' || c.b || ')',
  '', '## By severity', '', '| severity | count |', '|---|---:|', sev.t, '', '## By use-case', '', '| uc | count |', '|---|---:|', ucs.t, '', '## Top 10 anomalies', '',
  '| time | severity | uc | metric | score | actual | expected |', '|---|---|---|---|---:|---:|---:|', top.t) || chr(10) AS text
FROM c, sev, ucs, top""",
    "u1_all_slugs": f"SELECT DISTINCT {_SLUG.format('p_type')} AS uc FROM part",
    "u5_repeated_slugs": f"SELECT uc, count(*) AS count FROM (SELECT DISTINCT p_brand, {_SLUG.format('p_type')} AS uc FROM part) GROUP BY uc HAVING count(*) > 1",
    "h4_entity_slug": f"""SELECT c_custkey AS user_id, 'inv' || c_custkey AS inverter, {_SLUG.format("c_mktsegment || '-' || n_regionkey")} AS place,
  n_regionkey || '-' || c_custkey || '-gaeste-wc' AS address, 'meter' || c_custkey AS meter FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "h6_h18_names": """SELECT c_custkey AS user_id, 'F' || n_regionkey AS floor, '' AS no_floor, 'F' || n_regionkey || ' ' || c_mktsegment AS label,
  'avg_value[' || c_mktsegment || ',' || c_custkey || ']' AS metric FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "h7_calendar": """SELECT event_id, date_trunc('hour', ts) AS hour, date_trunc('day', ts) AS day, hour(ts)::INTEGER AS h, isodow(ts)::INTEGER AS d,
  (epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) - epoch_us(date_trunc('hour', ts))) / 1e6 AS left_s FROM events""",
    "h8_local_time": """SELECT DISTINCT o_orderdate::TIMESTAMP AS day, (strftime(o_orderdate::TIMESTAMP, '%Y-%m-%d') || ' 12:00:00')::TIMESTAMP AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' AS utc FROM orders""",
    "h10_energy_expressions": """WITH h AS (SELECT date_trunc('hour', ts) AS bucket, event_type, avg(value) AS v FROM events GROUP BY 1, 2),
p AS (SELECT bucket, coalesce(max(v) FILTER (event_type = 'view'), 0) AS g, coalesce(max(v) FILTER (event_type = 'click'), 0) AS i, coalesce(max(v) FILTER (event_type = 'error'), 0) AS e FROM h GROUP BY 1),
b AS (SELECT *, g + i - e AS c, greatest(g - e, 0) AS d FROM p)
SELECT bucket, round(greatest(c, 0), 3) AS consumption_kwh, round(d, 3) AS direct_use_kwh,
  round(CASE WHEN g > 0 THEN greatest(least(100 * d / g, 100), 0) ELSE 0 END, 1) AS self_consumption_pct,
  round(CASE WHEN c > 0 THEN greatest(least(100 * d / c, 100), 0) ELSE 0 END, 1) AS self_sufficiency_pct FROM b""",
    "h3_tiers": f"""WITH t AS (SELECT event_id, {_TIER.format(v="value", a=3, b=4, c=6, op=">=")} AS z, {_TIER.format(v="value", a=1, b=2, c=3, op=">=")} AS gap,
  {_TIER.format(v="value", a=0, b=25, c=50, op=">")} AS valve, CASE WHEN value / 100 < 0.35 THEN 'critical' WHEN value / 100 < 0.5 THEN 'warning' WHEN value / 100 < 0.65 THEN 'info' END AS ratio,
  {_TIER.format(v="value", a=38, b=45, c=55, op=">=")} AS median FROM events),
r AS (SELECT *, coalesce(list_position(['info', 'warning', 'critical'], z), 0)::INTEGER AS rank, coalesce(list_position(['info', 'warning', 'critical'], ratio), 0) AS rr,
  coalesce(list_position(['info', 'warning', 'critical'], median), 0) AS rm FROM t)
SELECT event_id, z, gap, valve, ratio, median, rank, CASE WHEN rm >= 2 THEN median END AS floored, rr > 0 AND rm > rr AS rose FROM r""",
    "h13_json": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, list_contains(json_keys(props), 'k') AS has_k, list_contains(json_keys(props), 'entity') AS has_entity FROM events",
    "u2_all_detectors": f"""WITH {SCORED}, {STREAK.split(", flags AS", 1)[0].replace("hourly AS", "hourly2 AS")}, flags AS{STREAK.split(", flags AS", 1)[1]}, rates AS (
  SELECT event_type, bucket, avg((on_samples / nullif(total_samples, 0) >= 0.5)::INT::DOUBLE) OVER (
    PARTITION BY event_type ORDER BY bucket RANGE BETWEEN INTERVAL 718 HOUR PRECEDING AND CURRENT ROW) AS rate FROM hourly
  WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00'),
c AS (SELECT event_type, bucket, least(streak, 24) AS streak FROM streaks WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00')
SELECT 'zscore' AS detector, severity, 'level_' || event_type AS uc, count(*) AS n, count(actual) AS with_actual FROM profile WHERE severity IS NOT NULL GROUP BY 1, 2, 3
UNION ALL SELECT 'rule', CASE WHEN streak >= 9 THEN 'critical' WHEN streak >= 6 THEN 'warning' ELSE 'info' END, 'appliance_runtime', count(*), 0
FROM c JOIN rates USING (event_type, bucket) WHERE rate < 0.6 AND streak >= 3 GROUP BY 1, 2, 3""",
}
