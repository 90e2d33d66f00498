"""Stored tables that follow their input: rollups with late readings, a scoring stream, a journal of anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..operators import detectors as d
from ..operators import rollup as r
from ..sources import store
from ..sources.journal import Journal
from ..sources.maintained import Rollups
from ..streaming import rollup as streaming
from ..streaming import scoring
from .base import HOURLY, ON_AT, SCORED, as_of, events, plain
from .profile_queries import SQL as PROFILE_SQL
from .table_queries import _HISTORY, _old_and_new

KEYS = ["event_type"]
#: What arrives late: one reading in seven of a week.
_LATE = "event_id % 7 = 0 AND ts >= TIMESTAMP'2024-01-05' AND ts < TIMESTAMP'2024-01-12'"


def _stored(spark: SparkSession, sf_dir: str) -> Rollups:
    """Rollup and baseline of the events in four batches, one of them empty, one late; refreshed after the first and the last."""
    rows = events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    stored = Rollups(spark, store.work_folder(spark, "rollups"), rows.schema, KEYS, on_at=ON_AT)
    late, cut = F.expr(_LATE), F.lit("2024-01-20").cast("timestamp")
    parts = [~late & (F.col("ts") < cut), ~late & (F.col("ts") >= cut), F.lit(False), late]
    for batch, part in enumerate(parts, 1):
        stored.append(rows.where(part), batch)
        if batch in (1, len(parts)):
            stored.refresh()
    return stored


def s3_maintained_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_stored(spark, sf_dir).rollup())


def a2_maintained_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_stored(spark, sf_dir).baseline().withColumnRenamed("on_day", "day"))


def s3_refreshed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one refresh with late readings wrote again: hours and days by count, and the rollup rows of those days."""
    rows = events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    stored = Rollups(spark, store.work_folder(spark, "rollups"), rows.schema, KEYS, on_at=ON_AT)
    stored.append(rows.where(~F.expr(_LATE)), 1)
    stored.refresh()
    stored.append(rows.where(_LATE), 2)
    done = stored.refresh()
    return stored.rollup(days=done.days).agg(F.lit(done.hours).cast("long").alias("hours"), F.lit(len(done.days)).cast("long").alias("days"), F.count("*").alias("rows"))


def d1_maintained_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile detector over the stored rollup: no raw reading is aggregated again."""
    out = d.zscore_profile(_stored(spark, sf_dir).rollup(), KEYS, as_of())
    return plain(out.select("bucket", "event_type", F.col("avg_value").alias("actual"), "n", "mean", "stddev", "zscore", "severity"))


def d1_maintained_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day's closed buckets of the stored rollup against the stored states of the days of the look-back."""
    stored = _stored(spark, sf_dir)
    rows = r.closed(stored.rollup("2024-01-30", "2024-01-30"), as_of())
    rows = r.from_states(rows, stored.baseline("2023-12-01", "2024-01-30"), KEYS)
    rows = rows.where(x.usable(F.col("avg_value")) & x.usable(F.col("stddev")))
    rows = rows.withColumn("zscore", x.zscore(F.col("avg_value"), F.col("mean"), F.col("stddev")))
    return plain(rows.select("bucket", "event_type", F.col("avg_value").alias("actual"), "n", "mean", "stddev", "zscore", x.tier(F.abs("zscore"), 3.0, 4.0, 6.0).alias("severity")))


def _scored_stream(spark: SparkSession, sf_dir: str) -> tuple[Journal, str]:
    """The events as a stream: hours that the watermark closes are scored against the stored baseline as they come."""
    place = store.work_folder(spark, "scored")
    stored = _stored(spark, sf_dir)
    table = Journal(spark, f"{place}/anomalies", scoring.ANOMALIES, store.ANOMALY_KEY)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    hours = streaming.hourly(streaming.source(spark, sf_dir, "events.parquet", schema), KEYS)
    batch = scoring.scorer(table, f"{place}/outbox", lambda b: scoring.profile_scores(b, stored, "events_1h"), compact_every=2)
    streaming.start(hours, batch, f"{place}/state").awaitTermination()
    return table, f"{place}/outbox"


def r2_streamed_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_scored_stream(spark, sf_dir)[0].view().select("time", "metric", "uc", "severity", "actual", "expected", "score"))


def r2_streamed_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scoring.messages(spark, _scored_stream(spark, sf_dir)[1])
    field = lambda n: F.get_json_object("body", f"$.{n}")
    return plain(out.select("time", "subject", field("severity").alias("severity"), field("level").cast("int").alias("level")))


def _journal(spark: SparkSession, sf_dir: str, update: list[str] | None, compacted: bool) -> DataFrame:
    """Two runs' anomalies in a journal; the second batch is sent twice."""
    old, new = _old_and_new(spark, sf_dir)
    table = Journal(spark, store.work_folder(spark, "journal"), scoring.ANOMALIES, store.ANOMALY_KEY)
    table.append(old, 1)
    if compacted:
        table.compact()
        table.vacuum()
    table.append(new, 2, update)
    table.append(new.withColumn("severity", F.lit("info")), 2, update)
    if compacted:
        table.compact()
    return plain(table.view().select("time", "metric", "severity", "actual", "expected", "score"))


def k1_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _journal(spark, sf_dir, None, False)


def k2_journal_some_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _journal(spark, sf_dir, ["severity", "uc", "score", "payload"], True)


def k5_journal_insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _journal(spark, sf_dir, [], True)


QUERIES = [
    s3_maintained_rollup, a2_maintained_baseline, s3_refreshed_days, d1_maintained_zscore, d1_maintained_states, r2_streamed_anomalies, r2_streamed_outbox,
    k1_journal, k2_journal_some_columns, k5_journal_insert_missing,
]

_ROW = "time, metric, severity, round(actual, 7) AS actual, round(expected, 7) AS expected, round(score, 7) AS score"
_LATE_SQL = _LATE.replace("TIMESTAMP'", "TIMESTAMP '")
_STREAMED = SCORED + """, h AS (SELECT * FROM profile WHERE severity IS NOT NULL AND bucket + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events))"""

SQL = {
    "s3_maintained_rollup": PROFILE_SQL["a1_hourly_rollup"],
    "a2_maintained_baseline": PROFILE_SQL["a2_baseline_state"],
    "s3_refreshed_days": f"""WITH {HOURLY}, late AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events WHERE {_LATE_SQL}),
d AS (SELECT DISTINCT CAST(h AS DATE) AS d FROM late)
SELECT (SELECT count(*) FROM late) AS hours, (SELECT count(*) FROM d) AS days, count(*) AS rows FROM hourly WHERE CAST(bucket AS DATE) IN (SELECT d FROM d)""",
    "d1_maintained_zscore": PROFILE_SQL["d1_zscore_profile"],
    "d1_maintained_states": f"""WITH {SCORED} SELECT bucket, event_type, round(actual, 7) AS actual, n, round(mean, 7) AS mean, round(sd, 7) AS stddev, round(zscore, 7) AS zscore, severity
FROM profile WHERE bucket >= TIMESTAMP '2024-01-30' AND bucket <= TIMESTAMP '2024-01-30 23:00:00'""",
    "r2_streamed_anomalies": f"""WITH {_STREAMED} SELECT bucket AS time, 'avg_value[' || event_type || ']' AS metric, 'level_' || event_type AS uc, severity, round(actual, 7) AS actual,
  round(mean, 7) AS expected, round(zscore, 7) AS score FROM h""",
    "r2_streamed_outbox": f"""WITH {_STREAMED} SELECT bucket AS time, 'anomaly.level_' || event_type || '.' || event_type AS subject, severity,
  CASE severity WHEN 'info' THEN 1 WHEN 'warning' THEN 2 ELSE 3 END AS level FROM h""",
    "k1_journal": f"WITH {_HISTORY}, t AS (SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (time, metric)) SELECT {_ROW} FROM t",
    "k2_journal_some_columns": f"""WITH {_HISTORY}, t AS (
  SELECT coalesce(n.time, o.time) AS time, coalesce(n.metric, o.metric) AS metric, coalesce(n.severity, o.severity) AS severity, CASE WHEN o.time IS NULL THEN n.actual ELSE o.actual END AS actual,
    CASE WHEN o.time IS NULL THEN n.expected ELSE o.expected END AS expected, coalesce(n.score, o.score) AS score FROM old o FULL JOIN new n ON o.time = n.time AND o.metric = n.metric)
SELECT {_ROW} FROM t""",
    "k5_journal_insert_missing": f"WITH {_HISTORY}, t AS (SELECT * FROM old UNION ALL SELECT * FROM new ANTI JOIN old USING (time, metric)) SELECT {_ROW} FROM t",
}
