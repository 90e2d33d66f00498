"""Exact quantiles of groups of any size by rank selection: histograms narrow until few values are left, then an exact pick.

A wanted quantile lies between two ranks. For each interval that holds one, a pass counts its values in ``bins`` equal parts
(a partial aggregation, so a hot group is a few counts from each task), with each part's least and greatest value, and keeps the part
that holds the rank. When it has no more than ``most`` values, or only equal ones, a window over those alone picks. Memory depends on
``bins`` and ``most``, not on the group; a value's bits bound the passes, two or three in practice.

Defined results: NULL and NaN are left out; a group without values has no row; the value between two ranks is interpolated as by
``percentile``; NULL keys are a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..sources import store

BINS, MOST = 1024, 10_000


def _met(rows: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    named = side.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    within = F.col("_v").between(F.col("low"), F.col("high"))
    same = reduce(Column.__and__, [rows[k].eqNullSafe(named[f"_of_{k}"]) for k in keys], within)
    return rows.join(named, same).drop(*(f"_of_{k}" for k in keys))


def quantiles(rows: DataFrame, keys: list[str], value: str, at: list[float], bins: int = BINS, most: int = MOST) -> DataFrame:
    """``keys, q, value, n`` for each of the quantiles ``at``."""
    spark = rows.sparkSession
    rows = rows.select(*keys, F.col(value).cast("double").alias("_v")).where(x.usable(F.col("_v")))
    old: list[str] = []

    def written(df: DataFrame, name: str) -> DataFrame:
        path = store.work_folder(spark, name)
        df.write.parquet(path)
        old.append(path)
        return spark.read.schema(df.schema).parquet(path)

    ends = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    wanted = F.explode(F.array(*(F.lit(float(q)) for q in at))).alias("q")
    asked = ends.select(*keys, "n", "low", "high", wanted).withColumn("p", F.col("q") * (F.col("n") - 1))
    asked = asked.withColumn("rank", F.explode(F.array(F.floor("p"), F.ceil("p"))))
    # ranks of one key and interval go together; ``under`` counts the values before the interval, ``held`` those in it
    asked = written(asked.select(*keys, "q", "p", "rank", "n"), "ranks")
    open_ = _keyed(asked.select(*keys, "rank").distinct(), ends, keys)
    open_ = written(open_.select(*keys, "rank", "low", "high", F.lit(0).cast("long").alias("under"), F.col("n").alias("held")), "intervals")
    wide = (F.col("held") > most) & (F.col("low") < F.col("high"))
    while open_.where(wide).limit(1).count():
        spans = open_.where(wide).select(*keys, "low", "high").distinct()
        place = F.least(F.floor((F.col("_v") - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1))
        counts = _met(rows, spans, keys).groupBy(*keys, "low", "high", place.alias("bin")).agg(F.count("*").alias("c"), F.min("_v").alias("a"), F.max("_v").alias("b"))
        upto = Window.partitionBy(*keys, "low", "high").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("upto", F.sum("c").over(upto))
        mine = _keyed(open_.where(wide), counts, [*keys, "low", "high"])
        first, last = F.col("under") + F.col("upto") - F.col("c"), F.col("under") + F.col("upto")
        mine = mine.where((F.col("rank") >= first) & (F.col("rank") < last))
        narrow = mine.select(*keys, "rank", F.col("a").alias("low"), F.col("b").alias("high"), first.alias("under"), F.col("c").alias("held"))
        open_ = written(open_.where(~wide).unionByName(narrow), "intervals")
    flat = open_.where("low = high").select(*keys, "rank", F.col("low").alias("x"))
    spans = open_.where("low < high").select(*keys, "low", "high", "under").distinct()
    nth = F.row_number().over(Window.partitionBy(*keys, "low", "high", "under").orderBy("_v")) - 1 + F.col("under")
    picked = _met(rows, spans, keys).select(*keys, nth.cast("long").alias("rank"), F.col("_v").alias("x"))
    found = flat.unionByName(_keyed(open_.where("low < high").select(*keys, "rank"), picked, [*keys, "rank"]).select(*keys, "rank", "x"))
    out = written(_keyed(asked, found, [*keys, "rank"]), "found")
    low, high = F.min("x"), F.max("x")
    up, down = F.max("p") - F.floor(F.max("p")), F.floor(F.max("p")) + 1 - F.max("p")
    result = out.groupBy(*keys, "q").agg(F.when(low == high, low).otherwise(down * low + up * high).alias("value"), F.max("n").alias("n"))
    for path in old[:-1]:
        store.remove(spark, path)
    return result


def _keyed(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join where NULL keys are equal; the keys once."""
    named = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(Column.__and__, [left[k].eqNullSafe(named[f"_of_{k}"]) for k in keys])
    return left.join(named, same).drop(*(f"_of_{k}" for k in keys))
