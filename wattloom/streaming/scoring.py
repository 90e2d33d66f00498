"""Scoring inside the stream: closed hourly buckets meet the stored baseline, anomalies go to a journal and messages to an outbox.

A micro-batch is one batch number throughout. Its anomalies are appended to the journal first; that is the only place where they are
computed, so a retry takes them from there, whatever the baseline has become. What is new or rose in severity is told against the
table before that batch, and written to the outbox under the same number. A crash between any two steps loses and
doubles nothing: each step is done once or found done. A message's ``batch`` and ``subject`` name it, for a
transport that may send twice.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..operators import rollup as r
from ..sources import store, versions
from ..sources.journal import Journal
from ..sources.maintained import Rollups

ANOMALIES = "time timestamp, source string, metric string, detector string, severity string, uc string, actual double, expected double, score double, payload string"
MESSAGES = "batch long, time timestamp, subject string, body string"


def profile_scores(buckets: DataFrame, baselines: Rollups, source: str, value: str = "avg_value", days: int = 60) -> DataFrame:
    """Firing anomalies of hourly ``buckets`` against the stored states of the days before; only those days are read."""
    span = buckets.agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).first()
    keys = baselines.keys
    if span.a is None:
        low = high = "1970-01-01"
    else:
        low, high = str((span.a - timedelta(days=days)).date()), str(span.b.date())
    rows = r.from_states(buckets, baselines.baseline(low, high), keys, days)
    rows = rows.where(x.usable(F.col(value)) & x.usable(F.col("mean")) & x.usable(F.col("stddev")))
    rows = rows.withColumn("score", x.zscore(F.col(value), F.col("mean"), F.col("stddev")))
    rows = rows.withColumn("severity", x.tier(F.abs("score"), 3.0, 4.0, 6.0)).where("severity IS NOT NULL")
    names = [F.col(k) for k in keys]
    body = F.to_json(F.struct(x.entity(dict(zip(keys, names, strict=True))).alias("entity"), F.lit(True).alias("firing")), {"ignoreNullFields": "false"})
    return rows.select(
        F.col("bucket").alias("time"), F.lit(source).alias("source"), x.metric_label(value, *names).alias("metric"), F.lit("zscore").alias("detector"), "severity",
        F.concat(F.lit("level_"), F.concat_ws("_", *names)).alias("uc"), F.col(value).alias("actual"), F.col("mean").alias("expected"), "score", body.alias("payload"),
    )


def scorer(journal: Journal, outbox: str, score: Callable[[DataFrame], DataFrame], publish: Callable[[DataFrame, int], None] | None = None, update: list[str] | None = None, compact_every: int = 0) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. ``publish`` gets the batch's messages, once unless it dies in it."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not journal.has(number):
            journal.append(score(batch), number, update)
        place = f"{outbox}/batch={number}"
        if not versions.finished(spark, place):
            rows = journal.rows(number)
            days = [d[0] for d in rows.select(F.to_date(journal.time)).distinct().collect()]
            news = store.to_publish(store.changes(journal.view(days=days, before=number), rows, journal.key))
            news = news.withColumn("entity", F.get_json_object("payload", "$.entity"))
            body = F.to_json(F.struct("uc", "entity", "severity", x.severity_rank(F.col("severity")).alias("level"), F.lit(True).alias("firing"), "payload"), {"ignoreNullFields": "false"})
            named = news.select(F.lit(number).cast("long").alias("batch"), "time", F.concat_ws(".", F.lit("anomaly"), "uc", "entity").alias("subject"), body.alias("body"))
            versions.write_once(named, place)
        if publish and str(number) not in versions.children(spark, f"{outbox}/published"):
            publish(spark.read.schema(MESSAGES).parquet(place), number)
            versions.mark(spark, f"{outbox}/published/{number}")
        if compact_every and number % compact_every == compact_every - 1:
            journal.compact(number)

    return run


def messages(spark: SparkSession, outbox: str) -> DataFrame:
    """All finished batches' messages."""
    found = versions.numbers(spark, outbox, "batch")
    return spark.read.schema(MESSAGES).parquet(*[f"{outbox}/batch={b}" for b in found]) if found else spark.createDataFrame([], MESSAGES)
