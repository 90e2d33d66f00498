"""Forecast documents, one JSON file each, checked against their shape: good ones, and the rest with a reason.

A file is read whole and taken apart in steps, so that what is wrong has a name: ``malformed`` (no JSON object), ``missing <field>``,
``not a map: <field>`` or ``not a list: <field>``, ``value: <field>``, ``time: <field>``, ``length: <field>``. The first in the order
of the fields counts. A map that is absent, null or an empty list is empty, as the senders mean it; numbers may be
written as strings; a null in a weather list is a gap. Nothing is read as null in silence, and no document stops the others;
only a file of no bytes is in neither table, as Spark's scans pass it over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .readings import WEATHER_METRICS

#: Fields of the documents: fixed values.
PV_MAPS = ("watts", "watt_hours_period", "watt_hours_day")
_EMPTY = ("[]", "null", "")


def _files(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def _object(text: Column) -> Column:
    """A JSON object's fields as raw text; NULL for anything else."""
    return F.when(F.ltrim(text).startswith("{"), F.from_json(text, "map<string,string>", {"mode": "PERMISSIVE"}))


def _sorted_out(rows: DataFrame, reasons: list[Column], columns: list[Column]) -> tuple[DataFrame, DataFrame]:
    rows = rows.withColumn("reason", F.coalesce(*reasons))
    return rows.where("reason IS NULL").select("file", *columns), rows.where("reason IS NOT NULL").select("file", "reason", "text")


def pv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``file, watts, watt_hours_period, watt_hours_day`` (maps to double) of good documents; ``file, reason, text`` of the others."""
    rows = _files(spark, path).withColumn("_doc", _object(F.col("text")))
    rows = rows.withColumn("_result", _object(F.col("_doc")["result"]))
    reasons = [F.when(F.col("_doc").isNull(), "malformed"), F.when(~F.map_contains_key("_doc", F.lit("result")), "missing result"), F.when(F.col("_result").isNull(), "not a map: result")]
    columns = []
    for m in PV_MAPS:
        raw = F.col("_result")[m]
        empty = raw.isNull() | F.trim(raw).isin(*_EMPTY)
        none = F.create_map().cast("map<string,string>")
        rows = rows.withColumn(f"_{m}", F.when(empty, none).otherwise(_object(raw)))
        keys, values = F.map_keys(f"_{m}"), F.map_values(f"_{m}")
        reasons += [F.when(F.col(f"_{m}").isNull(), f"not a map: {m}"), F.when(F.exists(values, lambda v: v.try_cast("double").isNull()), f"value: {m}"), F.when(F.exists(keys, lambda k: F.try_to_timestamp(k).isNull()), f"time: {m}")]
        columns.append(F.transform_values(f"_{m}", lambda _, v: v.try_cast("double")).alias(m))
    return _sorted_out(rows, reasons, columns)


def weather(spark: SparkSession, path: str, metrics: dict[str, str] = WEATHER_METRICS) -> tuple[DataFrame, DataFrame]:
    """``file, time`` (strings) and a list of doubles for each of ``metrics``; and the rejects."""
    rows = _files(spark, path).withColumn("_doc", _object(F.col("text")))
    rows = rows.withColumn("_hourly", _object(F.col("_doc")["hourly"]))
    reasons = [F.when(F.col("_doc").isNull(), "malformed"), F.when(~F.map_contains_key("_doc", F.lit("hourly")), "missing hourly"), F.when(F.col("_hourly").isNull(), "not a map: hourly")]
    columns = []
    for f in ("time", *metrics):
        raw = F.col("_hourly")[f]
        rows = rows.withColumn(f"_{f}", F.when(F.ltrim(raw).startswith("["), F.from_json(raw, "array<string>")))
        held = F.col(f"_{f}")
        reasons += [F.when(~F.map_contains_key("_hourly", F.lit(f)), f"missing {f}"), F.when(held.isNull(), f"not a list: {f}")]
        if f == "time":
            reasons.append(F.when(F.exists(held, lambda t: F.try_to_timestamp(t).isNull()), "time: time"))
            columns.append(held.alias(f))
        else:
            reasons += [F.when(F.size(held) != F.size("_time"), f"length: {f}"), F.when(F.exists(held, lambda v: v.isNotNull() & v.try_cast("double").isNull()), f"value: {f}")]
            columns.append(F.transform(held, lambda v: v.try_cast("double")).alias(f))
    return _sorted_out(rows, reasons, columns)
