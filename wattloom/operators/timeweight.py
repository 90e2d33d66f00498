"""Time-weighted states that merge: area under a curve, rise and resets of a counter, over any cut of time.

A state is the first and the last sample of a stretch and what lies between: ``n, first, last, area, rise, resets``. States
of stretches that do not overlap merge in order of time, adding the step from one's last to the next one's first sample; merged
states are states again. So hours make days and days make months, and only the hours are made of raw samples, each from
its own sorted array.

Defined results: a NULL value is a sample: no area, rise or reset is counted to or from it; one sample has area 0; equal times are
ordered by ``tie``, then value; a counter that falls was reset and rose by its new value; samples without a time are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import seconds_between

FIGURES = ("area", "rise", "resets")


def _step(a: Column, b: Column) -> dict[str, Column]:
    """What the step between two samples adds."""
    down = b["v"] < a["v"]
    return {
        "area": F.coalesce((a["v"] + b["v"]) / 2 * seconds_between(b["t"], a["t"]) / 3600, F.lit(0.0)),
        "rise": F.coalesce(F.when(down, b["v"]).otherwise(b["v"] - a["v"]), F.lit(0.0)),
        "resets": F.coalesce(down.cast("long"), F.lit(0).cast("long")),
    }


def states(samples: DataFrame, keys: list[str], time: str = "ts", value: str = "value", spans: str = "hour", tie: list[str] | None = None) -> DataFrame:
    """A state per key and span of raw samples: ``keys, span, n, first, last, area, rise, resets``."""
    cell = F.struct(F.col(time).alias("t"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(tie or [])), F.col(value).cast("double").alias("v"))
    rows = samples.where(F.col(time).isNotNull()).groupBy(*keys, F.date_trunc(spans, F.col(time).cast("timestamp")).alias("span"))
    rows = rows.agg(F.array_sort(F.collect_list(cell)).alias("_s")).withColumn("n", F.size("_s").cast("long"))
    steps = F.zip_with(F.slice("_s", 1, F.col("n").cast("int") - 1), F.slice("_s", 2, F.col("n").cast("int") - 1), lambda a, b: F.struct(*(c.alias(k) for k, c in _step(a, b).items())))
    rows = rows.withColumn("_d", steps)
    point = lambda c: F.struct(c["t"].alias("t"), c["v"].alias("v"))
    zero = {"area": F.lit(0.0), "rise": F.lit(0.0), "resets": F.lit(0).cast("long")}
    sums = [_total(k, zero[k]) for k in FIGURES]
    return rows.select(*keys, "span", "n", point(F.element_at("_s", 1)).alias("first"), point(F.element_at("_s", -1)).alias("last"), *sums)


def _total(figure: str, zero: Column) -> Column:
    return F.aggregate("_d", zero, lambda acc, d: acc + d[figure]).alias(figure)


def merge(states: DataFrame, keys: list[str], spans: str | None = None) -> DataFrame:
    """States of stretches that do not overlap, merged per key, or per key and coarser span; the window is over states, not samples."""
    group = [*keys, "span"] if spans else keys
    rows = states.withColumn("span", F.date_trunc(spans, F.col("first.t").cast("timestamp"))) if spans else states.drop("span")
    order = Window.partitionBy(*group).orderBy("first.t")
    rows = rows.withColumn("_before", F.lag("last").over(order))
    step = _step(F.col("_before"), F.col("first"))
    rows = rows.withColumns({f"_{k}": F.when(F.col("_before").isNotNull(), c).otherwise(F.lit(0)) for k, c in step.items()})
    sums = [(F.sum(k) + F.sum(f"_{k}")).alias(k) for k in FIGURES]
    return rows.groupBy(*group).agg(F.sum("n").alias("n"), F.min_by("first", "first.t").alias("first"), F.max_by("last", "last.t").alias("last"), *sums)


def average(state: DataFrame) -> DataFrame:
    """Adds ``mean``, the time-weighted mean of a stretch; of a single moment, its value."""
    hours = seconds_between(F.col("last.t"), F.col("first.t")) / 3600
    return state.withColumn("mean", F.when(hours > 0, F.col("area") / hours).otherwise(F.col("first.v")))
