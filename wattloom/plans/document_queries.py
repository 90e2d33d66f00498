"""Forecast documents written as JSON files, some of them broken by rule, and read back with their rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..operators import forecasts as fc
from ..sources import documents, store
from ..sources.readings import WEATHER_METRICS
from .base import HOURLY, plain
from .model_queries import _pv_documents, _weather_documents


def _write(docs: DataFrame, text: Column, folder: str) -> None:
    """One file for each day's document."""
    docs.select(F.date_format("day", "yyyy-MM-dd").alias("day"), text.alias("value")).repartition("day").write.partitionBy("day").text(folder)


def _day(file: str = "file") -> Column:
    return F.regexp_extract(file, r"day=(\d{4}-\d\d-\d\d)", 1).cast("date")


def _pv_folder(spark: SparkSession, sf_dir: str) -> str:
    """A day's forecast by the day of the month: cut off, without result, empty, with a word for a number, else good."""
    folder = store.work_folder(spark, "pv-documents")
    docs = _pv_documents(spark, sf_dir)
    k = F.day("day") % 7
    text = (
        F.when(k == 1, F.expr("substr(j, 1, length(j) - 9)")).when(k == 2, F.lit('{"message": "limit"}')).when(k == 3, F.lit('{"result": {"watts": []}}'))
        .when(k == 4, F.regexp_replace("j", r'"watts":\{"([^"]+)":[^,}]+', r'"watts":{"$1":"high"')).otherwise(F.col("j"))
    )
    _write(docs.withColumn("j", F.to_json(F.struct(F.struct("watts", "watt_hours_period", "watt_hours_day").alias("result")))), text, folder)
    return folder


def s9_pv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: how many hours it has, or why it was rejected."""
    good, rejects = documents.pv(spark, _pv_folder(spark, sf_dir))
    good = good.select(_day().alias("day"), F.size("watts").cast("double").alias("hours"), F.lit(None).cast("string").alias("reason"))
    return plain(good.unionByName(rejects.select(_day().alias("day"), F.lit(None).cast("double").alias("hours"), "reason")))


def s9_pv_rows_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = documents.pv(spark, _pv_folder(spark, sf_dir))
    return plain(fc.map_rows(good, "watts", "Europe/Berlin"))


def s10_weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of good documents by day; rejects with their reason: a list that is too short, or not there."""
    docs = _weather_documents(spark, sf_dir)
    k, time = F.day("day") % 5, F.transform("time", lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm"))
    fields = list(WEATHER_METRICS)
    cut = F.when(k == 1, F.slice("level", 2, 100)).otherwise(F.col("level"))
    lists = {f: F.col("level") for f in fields} | {fields[0]: cut, fields[1]: F.when(k == 2, None).otherwise(F.col("busy"))}
    text = F.to_json(F.struct(F.struct(time.alias("time"), *(c.alias(f) for f, c in lists.items())).alias("hourly")))
    folder = store.work_folder(spark, "weather-documents")
    _write(docs, text, folder)
    good, rejects = documents.weather(spark, folder)
    rows = fc.array_rows(good, "time", WEATHER_METRICS, ["file"]).groupBy(_day().alias("day"), "metric").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.min(x.to_utc(F.col("forecast_for"), "UTC")).alias("first"))
    none = rejects.select(_day().alias("day"), F.col("reason").alias("metric"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("total"), F.lit(None).cast("timestamp").alias("first"))
    return plain(rows.unionByName(none))


def p19_empty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert from empty and rejected documents only: the table stays as it was."""
    folder = _pv_folder(spark, sf_dir)
    good, _ = documents.pv(spark, folder)
    table = lambda rows: rows.select("forecast_for", F.lit("pv").alias("source"), F.lit("watts").alias("metric"), F.lit("doc").alias("model"), F.col("value").alias("forecast_value"))
    old = table(fc.map_rows(good, "watts", "UTC"))
    new = table(fc.map_rows(good.where(F.size("watts") == 0), "watts", "UTC"))
    return plain(store.upsert(old, new, store.FORECAST_KEY).select("forecast_for", "forecast_value"))


QUERIES = [s9_pv_documents, s9_pv_rows_of_files, s10_weather_documents, p19_empty_documents]

_VIEWS = HOURLY + """, v AS (SELECT *, date_trunc('day', bucket)::TIMESTAMP AS day, day(bucket) % 7 AS k FROM hourly WHERE event_type = 'view')"""
_METRICS = list(WEATHER_METRICS.items())
_LONG = " UNION ALL ".join(f"SELECT day, bucket, '{m}' AS metric, {'CASE WHEN on_samples > 0 THEN on_samples::DOUBLE END' if k == 1 else 'avg_value'} AS v FROM c WHERE k NOT IN (1, 2)" for k, (_, m) in enumerate(_METRICS))

SQL = {
    "s9_pv_documents": f"""WITH {_VIEWS} SELECT day, CASE WHEN any_value(k) = 3 THEN 0 WHEN any_value(k) NOT IN (1, 2, 4) THEN count(*)::DOUBLE END AS hours,
  CASE any_value(k) WHEN 1 THEN 'malformed' WHEN 2 THEN 'missing result' WHEN 4 THEN 'value: watts' END AS reason FROM v GROUP BY day""",
    "s9_pv_rows_of_files": f"WITH {_VIEWS} SELECT bucket AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' AS forecast_for, round(avg_value, 7) AS value FROM v WHERE k NOT IN (1, 2, 3, 4)",
    "s10_weather_documents": f"""WITH {HOURLY}, c AS (SELECT *, date_trunc('day', bucket)::TIMESTAMP AS day, day(bucket) % 5 AS k FROM hourly WHERE event_type = 'click'),
l AS ({_LONG})
SELECT day, metric, count(v) AS n, round(sum(v), 7) AS total, min(bucket) AS first FROM l WHERE v IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT day, CASE any_value(k) WHEN 1 THEN 'length: {_METRICS[0][0]}' ELSE 'missing {_METRICS[1][0]}' END, 0, NULL, NULL FROM c WHERE k IN (1, 2) GROUP BY day""",
    "p19_empty_documents": f"WITH {_VIEWS} SELECT bucket AS forecast_for, round(avg_value, 7) AS forecast_value FROM v WHERE k NOT IN (1, 2, 3, 4)",
}
