"""Scans of raw readings and channel tables, and of forecast documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Field names of outside documents: fixed values.
PV_SCHEMA = "result struct<watts: map<string,double>, watt_hours_period: map<string,double>, watt_hours_day: map<string,double>>"
#: Field of a weather document and metric it is stored as. Fixed values.
WEATHER_METRICS = {
    "temperature_2m": "temperature",
    "cloud_cover": "cloud_cover",
    "precipitation": "precipitation",
    "shortwave_radiation": "solar_radiation",
    "wind_speed_10m": "wind_speed",
}
WEATHER_SCHEMA = "hourly struct<time: array<string>, " + ", ".join(f"{f}: array<double>" for f in WEATHER_METRICS) + ">"


def readings(spark: SparkSession, path: str, time: str = "ts") -> DataFrame:
    """A Parquet table of readings with its time as ``timestamp`` (zone-less times are UTC)."""
    df = spark.read.parquet(path)
    return df.withColumn(time, F.col(time).cast("timestamp"))


def between(df: DataFrame, low: Column, high: Column, time: str = "ts") -> DataFrame:
    """Rows in ``(low, high]``; reaches the scan as a filter."""
    return df.where((F.col(time) > low) & (F.col(time) <= high))


def channels(df: DataFrame, names: list, column: str = "ga") -> DataFrame:
    return df.where(F.col(column).isin(names))


def latest_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents of a folder, one a file, under a fixed schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def pv_documents(spark: SparkSession, path: str) -> DataFrame:
    return latest_file(spark, path, PV_SCHEMA).select("result.*")


def weather_documents(spark: SparkSession, path: str) -> DataFrame:
    return latest_file(spark, path, WEATHER_SCHEMA).select("hourly.*")
