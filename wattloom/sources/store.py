"""Keyed result tables: upsert, clear markers, open entities, publish gate, outbox.

Tables are DataFrames; ``save`` writes one back as Parquet partitioned by day,
replacing only the days an upsert touched. Nothing reads and overwrites one path
in the same plan.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import escalated, severity_rank

ANOMALY_KEY = ["time", "source", "metric", "detector"]
FORECAST_KEY = ["forecast_for", "source", "metric", "model"]


def upsert(existing: DataFrame, new: DataFrame, key: list[str], update: list[str] | None = None) -> DataFrame:
    """``existing`` with ``new`` merged in by key: one full outer join.

    On a match the ``update`` columns (all others than the key by default) take
    the new value, also where it is NULL; the rest stay. Of rows of ``new`` that repeat a key,
    the one with the largest other columns, in their order, counts.
    """
    update = [c for c in existing.columns if c not in key] if update is None else update
    new = one_of_each(new, key).withColumn("_new", F.lit(True))
    old = existing.withColumn("_old", F.lit(True))
    both = old.alias("o").join(new.alias("n"), key, "full_outer")
    cols = [F.col(k) for k in key]
    for c in existing.columns:
        if c not in key:
            fresh = F.col("_new").isNotNull() if c in update else F.col("_old").isNull()
            theirs = F.col(f"n.{c}") if c in new.columns else F.lit(None)
            cols.append(F.when(fresh, theirs).otherwise(F.col(f"o.{c}")).alias(c))
    return both.select(*cols).select(*existing.columns)


def one_of_each(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row of each key: the one with the largest other columns, in their order."""
    others = [c for c in rows.columns if c not in key]
    if not others:
        return rows.distinct()
    return rows.groupBy(*key).agg(F.max(F.struct(*others)).alias("_row")).select(*(c if c in key else F.col("_row")[c].alias(c) for c in rows.columns))


def changes(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``new`` with ``inserted`` and ``old_severity``: what an upsert would do to each row."""
    old = existing.select(*key, F.col("severity").alias("old_severity"), F.lit(True).alias("_old"))
    return new.join(old, key, "left").withColumn("inserted", F.col("_old").isNull()).drop("_old")


def counters(changed: DataFrame) -> DataFrame:
    """Per use case: rows written, how many of them were new, and how many are to be published."""
    rose = F.col("inserted") | escalated(F.col("old_severity"), F.col("severity"))
    return changed.groupBy("uc").agg(F.count("*").alias("hits"), F.count_if("inserted").alias("inserted"), F.count_if(rose).alias("published"))


def to_publish(changed: DataFrame) -> DataFrame:
    """Rows that are new or rose in severity."""
    return changed.where(F.col("inserted") | escalated(F.col("old_severity"), F.col("severity")))


def open_entities(anomalies: DataFrame, as_of: Column, days: int = 7, latest_by: str = "time") -> DataFrame:
    """The latest row of each (uc, entity) in the look-back, if it is not a clear marker.

    Only payloads that have the key ``entity`` count; a null entity is one of its
    own. ``firing`` false in the payload marks a clear.
    """
    rows = anomalies.where((F.col("time") > as_of - F.make_interval(days=F.lit(days))) & (F.col("time") <= as_of))
    rows = rows.where(F.array_contains(F.json_object_keys("payload"), "entity"))
    rows = rows.withColumn("entity", F.get_json_object("payload", "$.entity"))
    latest = Window.partitionBy("uc", "entity").orderBy(F.desc(latest_by), *ANOMALY_KEY[1:])
    rows = rows.withColumn("_nth", F.row_number().over(latest)).where("_nth = 1").drop("_nth")
    return rows.where(F.coalesce(F.get_json_object("payload", "$.firing"), F.lit("true")) != "false")


def cleared(open_rows: DataFrame, ran: DataFrame, fired: DataFrame) -> DataFrame:
    """Open rows of use cases that ``ran`` (``uc``) whose (uc, entity) is not among ``fired``.

    A use case that is silenced, failed or had no bucket to score is not in ``ran``, and clears nothing.
    """
    hit = fired.select(F.col("uc").alias("_uc"), F.col("entity").alias("_entity")).distinct()
    of_run = open_rows.join(ran.select("uc").distinct(), "uc", "left_semi")
    return of_run.join(hit, (F.col("uc") == F.col("_uc")) & F.col("entity").eqNullSafe(F.col("_entity")), "left_anti")


def clear_markers(gone: DataFrame, as_of: Column) -> DataFrame:
    """A marker row at ``as_of`` for every entity that went quiet: severity as it was, score 0."""
    body = F.to_json(F.struct("entity", F.lit(False).alias("firing"), F.lit(True).alias("clear")), {"ignoreNullFields": "false"})
    none = F.lit(None).cast("double")
    return gone.select(
        as_of.alias("time"), "source", "metric", "detector", "severity", "uc", none.alias("actual"), none.alias("expected"), F.lit(0.0).alias("score"), body.alias("payload")
    )


def insert_missing(existing: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """``existing`` and those ``rows`` whose key it does not have."""
    fresh = one_of_each(rows, key).join(existing.select(*key), key, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def outbox(rows: DataFrame, firing: bool = True) -> DataFrame:
    """Messages ``subject, body`` for anomaly rows (``uc, entity, severity, payload``); level 0 when cleared."""
    level = severity_rank(F.col("severity")) if firing else F.lit(0)
    body = F.struct("uc", "entity", "severity", level.alias("level"), F.lit(firing).alias("firing"), "payload")
    return rows.select(F.concat_ws(".", F.lit("anomaly"), "uc", "entity").alias("subject"), F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))


def value_messages(row: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    """``subject, body`` for each named column of each row; NULL values are left out."""
    pairs = ", ".join(f"'{k}', `{k}`" for k in keys)
    long = row.select(F.expr(f"stack({len(keys)}, {pairs}) AS (key, value)")).where("value IS NOT NULL")
    return long.select(F.concat_ws(".", F.lit(prefix), "key").alias("subject"), F.to_json(F.struct("value")).alias("body"))


def save(table: DataFrame, path: str, time: str) -> None:
    """Write ``table`` partitioned by the day of ``time``; days it does not have stay as they are at ``path``.

    Rows go to a new folder first and are moved from there, so ``table`` may have been read from ``path``.
    """
    spark = table.sparkSession
    step = f"{path.rstrip('/')}-step-{uuid.uuid4().hex}"
    table.withColumn("day", F.to_date(time)).write.partitionBy("day").parquet(step)
    rows = spark.read.schema(table.schema).option("basePath", step).parquet(step).withColumn("day", F.to_date(time))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    remove(spark, step)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the one that spark.checkpoint.dir names; of our own in local mode where it is unset, an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='wattloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/wattloom/{name}-{uuid.uuid4().hex}"


def forecasts_of(table: DataFrame, source: str, metric: str, model: str, low: Column, high: Column) -> DataFrame:
    """Stored forecasts of one source, metric and model in ``[low, high]``; all of it reaches the scan as filters."""
    return table.where((F.col("source") == source) & (F.col("metric") == metric) & (F.col("model") == model)).where(F.col("forecast_for").between(low, high))


def load(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """A saved table; only the folders of the days from ``first`` to ``last`` are read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("day") <= F.lit(last).cast("date"))
    return rows.drop("day")
