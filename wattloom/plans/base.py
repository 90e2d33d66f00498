"""The driver tables seen as sensor data: events are readings, customers are sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollup

AS_OF_TEXT = "2024-01-31 00:00:00"
ON_AT = 40.0


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, room, floor`` of every customer."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("room"), F.col("c_nationkey").alias("n_nationkey"))
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", F.col("n_regionkey").alias("floor"))
    return customer.join(F.broadcast(nation), "n_nationkey").drop("n_nationkey")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.hourly(events(spark, sf_dir), ["event_type"], on_at=ON_AT)


def plain(df: DataFrame) -> DataFrame:
    """Doubles to seven places, times without zone, days as times: what SQL engines agree on."""
    cols = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        cols.append((F.round(c, 7) if kind == "double" else c.cast("timestamp_ntz") if kind in ("timestamp", "date") else c).alias(f.name))
    return df.select(*cols)


#: Common table expressions of the SQL side.
HOURLY = """hourly AS (
  SELECT date_trunc('hour', ts) AS bucket, event_type, avg(value) AS avg_value, min(value) AS min_value,
    count(*) AS total_samples, count(*) FILTER (value >= 40) AS on_samples
  FROM events GROUP BY 1, 2)"""

SCORED = (
    HOURLY
    + """, states AS (
  SELECT *, CAST(bucket AS DATE) AS day, hour(bucket) AS h, isodow(bucket) AS d FROM hourly),
scored AS (
  SELECT a.bucket, a.event_type, any_value(a.avg_value) AS actual, count(b.avg_value) AS n, avg(b.avg_value) AS mean,
    stddev_samp(b.avg_value) AS sd
  FROM states a JOIN states b ON a.event_type = b.event_type AND a.h = b.h AND a.d = b.d
    AND b.day < a.day AND b.day > a.day - INTERVAL 60 DAY
  WHERE a.bucket <= TIMESTAMP '2024-01-30 23:00:00' GROUP BY a.bucket, a.event_type),
z AS (
  SELECT *, CASE WHEN sd > 0 THEN (actual - mean) / sd END AS zscore FROM scored WHERE sd IS NOT NULL),
profile AS (
  SELECT *, CASE WHEN abs(zscore) >= 6 THEN 'critical' WHEN abs(zscore) >= 4 THEN 'warning'
    WHEN abs(zscore) >= 3 THEN 'info' END AS severity FROM z)"""
)
