"""Time-series steps: runs, streaks, as-of lookups, counter deltas, curve integrals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import seconds_between


def runs(readings: DataFrame, keys: list[str], running: Column, time: str = "ts", tie: list[str] | None = None) -> DataFrame:
    """Runs of consecutive running readings of a series: ``keys, start, minutes``.

    A run ends at the first reading that is not running, or at the last reading
    if it is still open (a single open reading has NULL minutes). A NULL reading
    splits a run; a gap between readings does not.
    """
    order = Window.partitionBy(*keys).orderBy(time, *(tie or []))
    rows = readings.withColumn("_on", running).withColumn("_next", F.lead(time).over(order))
    new = F.when(F.col("_on") & ~F.coalesce(F.lag("_on").over(order), F.lit(False)), 1).otherwise(0)
    rows = rows.withColumn("_new", new)
    rows = rows.withColumn("run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = rows.where("_on").groupBy(*keys, "run").agg(F.min(time).alias("start"), F.max("_next").alias("_end"))
    return out.select(*keys, "start", (seconds_between(F.col("_end"), F.col("start")) / 60).alias("minutes"))


def trailing_streak(rows: DataFrame, keys: list[str], active: Column, bucket: str = "bucket") -> DataFrame:
    """Adds ``streak``: how many hours in a row up to each bucket were active, 0 if this one was not.

    A missing or a repeated hour breaks the streak.
    """
    order = Window.partitionBy(*keys).orderBy(bucket)
    gap = seconds_between(F.col(bucket), F.lag(bucket).over(order))
    rows = rows.withColumn("_on", F.coalesce(active, F.lit(False)))
    fresh = ~F.col("_on") | ~F.coalesce(F.lag("_on").over(order), F.lit(False)) | F.coalesce(gap != 3600, F.lit(True))
    rows = rows.withColumn("_fresh", F.when(fresh, 1).otherwise(0))
    rows = rows.withColumn("_group", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.row_number().over(Window.partitionBy(*keys, "_group").orderBy(bucket))
    return rows.withColumn("streak", F.when(F.col("_on"), place).otherwise(0)).drop("_on", "_fresh", "_group")


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    value: str,
    alias: str,
    keys: list[str] | None = None,
    spans: str = "day",
) -> DataFrame:
    """Each row of ``left`` with the latest ``value`` of ``right`` at or before its time; a NULL latest value stays NULL.

    Union, one sort, one running ``last``. Without keys the whole table would be
    one sorted group, so rows are cut into calendar ``spans``: each span is one
    window group, and a table of the last reading per span (one row per
    day, not per reading) carries the value over into spans that start without one.
    """
    keys = keys or []
    cell = F.struct(F.col(value).alias("v"), F.col(right_time).alias("t"))
    span = lambda t: F.date_trunc(spans, F.col(t).cast("timestamp")).alias("_span")
    cols = left.columns
    a = left.select(*cols, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(_cell_type(right, value, right_time)).alias("_cell"), span(left_time))
    b = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), cell.alias("_cell"), span(right_time))
    both = a.unionByName(b, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_span").orderBy("_t", "_side")
    both = both.withColumn("_got", F.last("_cell", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    ends = both.groupBy(*keys, "_span").agg(F.max_by("_cell", F.when(F.col("_cell").isNotNull(), F.col("_t"))).alias("_end"))
    order = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(order)).drop("_end")
    out = both.where("_side = 1").join(ends, [*keys, "_span"], "left")
    return out.select(*cols, F.coalesce("_got", "_carry").getField("v").alias(alias))


def _cell_type(right: DataFrame, value: str, time: str) -> str:
    kinds = dict(right.dtypes)
    return f"struct<v:{kinds[value]},t:{kinds[time]}>"


def counter_delta(readings: DataFrame, keys: list[str], time: str = "ts", value: str = "value") -> DataFrame:
    """Last minus first value of a counter per key: partial aggregation, no sort."""
    return readings.groupBy(*keys).agg((F.max_by(value, time) - F.min_by(value, time)).alias("delta"))


def floored_sum(deltas: DataFrame, keys: list[str], scale: float = 1000.0) -> DataFrame:
    """Sum of deltas with negative and missing ones as 0, scaled (Wh to kWh)."""
    total = F.coalesce(F.sum(F.greatest(F.coalesce("delta", F.lit(0.0)), F.lit(0.0))), F.lit(0.0))
    return deltas.groupBy(*keys).agg((total / scale).alias("kwh"))


def integral(samples: DataFrame, keys: list[str], time: str = "ts", value: str = "value", tie: list[str] | None = None) -> DataFrame:
    """Area in value-hours under the straight lines between samples, per key."""
    order = Window.partitionBy(*keys).orderBy(time, *(tie or []))
    step = seconds_between(F.col(time), F.lag(time).over(order)) / 3600
    area = (F.col(value) + F.lag(value).over(order)) / 2 * step
    return samples.withColumn("_area", area).groupBy(*keys).agg(F.coalesce(F.sum("_area"), F.lit(0.0)).alias("area"))


def hourly_grid(series: DataFrame, keys: list[str], bucket: str = "bucket", value: str = "y") -> DataFrame:
    """A regular hourly series from each key's first to last bucket; missing hours count as 0."""
    ends = series.groupBy(*keys).agg(F.min(bucket).alias("_a"), F.max(bucket).alias("_b"))
    grid = ends.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 HOUR"))).alias(bucket))
    return grid.join(series, [*keys, bucket], "left").withColumn(value, F.coalesce(value, F.lit(0.0)))
