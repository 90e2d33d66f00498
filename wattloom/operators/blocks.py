"""Runs, streaks and integrals of series that are too long for one sorted group.

Time is cut into blocks, by the calendar. Windows over rows are inside a key and block; what crosses a block's edge is
carried by one row a block (the row before, the time after, a streak's length), over which the windows per key run. So the largest
group is a block, and one channel with a third of all readings is as many groups as it has blocks. Results are those of the
functions of the same names in ``series``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import seconds_between


def _inside(keys: list[str], time: str, tie: list[str]):  # noqa: ANN202  a WindowSpec
    return Window.partitionBy(*keys, "_block").orderBy(time, *tie)


def _with(rows: DataFrame, per_block: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of their block; NULL keys are keys."""
    named = per_block.withColumnsRenamed({k: f"_of_{k}" for k in [*keys, "_block"]})
    same = reduce(Column.__and__, [rows[k].eqNullSafe(named[f"_of_{k}"]) for k in [*keys, "_block"]])
    return rows.join(named, same).drop(*(f"_of_{k}" for k in [*keys, "_block"]))


def neighbours(rows: DataFrame, keys: list[str], time: str, cells: list[str], tie: list[str] | None = None, spans: str = "day") -> DataFrame:
    """Adds ``_block``, ``_prev`` (a struct of ``cells`` of the row before, NULL for the first of a series) and ``_next`` (the time of the row after)."""
    tie = tie or []
    rows = rows.withColumn("_block", F.date_trunc(spans, F.col(time).cast("timestamp"))).withColumn("_cell", F.struct(*cells))
    ends = rows.groupBy(*keys, "_block").agg(F.max_by("_cell", F.struct(time, *tie)).alias("_tail"), F.min(time).alias("_head"))
    blocks = Window.partitionBy(*keys).orderBy("_block")
    ends = ends.select(*keys, "_block", F.lag("_tail").over(blocks).alias("_before"), F.lead("_head").over(blocks).alias("_after"))
    inside = _inside(keys, time, tie)
    rows = _with(rows, ends, keys)
    return rows.withColumns({"_prev": F.coalesce(F.lag("_cell").over(inside), "_before"), "_next": F.coalesce(F.lead(time).over(inside), "_after"), "_ends": F.lead(time).over(inside).isNull()}).drop("_cell", "_before", "_after")


def runs(readings: DataFrame, keys: list[str], running: Column, time: str = "ts", tie: list[str] | None = None, spans: str = "day") -> DataFrame:
    rows = neighbours(readings.withColumn("_on", running), keys, time, ["_on"], tie, spans)
    new = F.col("_on") & ~F.coalesce(F.col("_prev._on"), F.lit(False))
    upto = _inside(keys, time, tie or []).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_k", F.sum(F.when(new, 1).otherwise(0)).over(upto))
    parts = rows.where("_on").groupBy(*keys, "_block", "_k").agg(F.min(time).alias("start"), F.max("_next").alias("_end"), F.max("_ends").alias("_open"))
    # a run inside its block is whole; of the others there are two a block at most: one that came in (0), one that goes on
    whole = parts.where("_k > 0 AND NOT _open").select(*keys, "start", "_end")
    order = Window.partitionBy(*keys).orderBy("_block", "_k").rowsBetween(Window.unboundedPreceding, 0)
    edge = parts.where("_k = 0 OR _open").withColumn("_run", F.sum(F.when(F.col("_k") > 0, 1).otherwise(0)).over(order))
    edge = edge.groupBy(*keys, "_run").agg(F.min("start").alias("start"), F.max("_end").alias("_end")).drop("_run")
    return whole.unionByName(edge).select(*keys, "start", (seconds_between(F.col("_end"), F.col("start")) / 60).alias("minutes"))


def trailing_streak(rows: DataFrame, keys: list[str], active: Column, bucket: str = "bucket", spans: str = "month") -> DataFrame:
    names = rows.columns
    rows = neighbours(rows.withColumn("_on", F.coalesce(active, F.lit(False))), keys, bucket, [bucket, "_on"], None, spans)
    gap = seconds_between(F.col(bucket), F.col("_prev")[bucket])
    fresh = ~F.col("_on") | ~F.coalesce(F.col("_prev._on"), F.lit(False)) | F.coalesce(gap != 3600, F.lit(True))
    order = _inside(keys, bucket, [])
    rows = rows.withColumns({"_fresh": fresh, "_r": F.row_number().over(order)})
    since = F.max(F.when(F.col("_fresh"), F.col("_r"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_since", since)
    # at a block's end: the streak since its last break, or all its rows on top of what came in
    tail = F.when(F.max("_since").isNull(), F.count("*")).otherwise(F.max_by(F.when(F.col("_on"), F.col("_r") - F.col("_since") + 1).otherwise(0), "_r"))
    ends = rows.groupBy(*keys, "_block").agg(tail.alias("_tail"), F.max("_since").isNotNull().alias("_broken"))
    blocks = Window.partitionBy(*keys).orderBy("_block")
    ends = ends.withColumn("_group", F.sum(F.col("_broken").cast("int")).over(blocks.rowsBetween(Window.unboundedPreceding, 0)))
    sofar = F.sum("_tail").over(Window.partitionBy(*keys, "_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0))
    ends = ends.withColumn("_sofar", sofar).select(*keys, "_block", F.lag("_sofar").over(blocks).alias("_came"))
    out = _with(rows, ends, keys)
    length = F.when(F.col("_since").isNull(), F.col("_r") + F.coalesce("_came", F.lit(0))).otherwise(F.col("_r") - F.col("_since") + 1)
    return out.select(*names, F.when(F.col("_on"), length).otherwise(0).cast("int").alias("streak"))


def integral(samples: DataFrame, keys: list[str], time: str = "ts", value: str = "value", tie: list[str] | None = None, spans: str = "day") -> DataFrame:
    rows = neighbours(samples, keys, time, [time, value], tie, spans)
    area = (F.col(value) + F.col("_prev")[value]) / 2 * seconds_between(F.col(time), F.col("_prev")[time]) / 3600
    return rows.withColumn("_area", area).groupBy(*keys).agg(F.coalesce(F.sum("_area"), F.lit(0.0)).alias("area"))
