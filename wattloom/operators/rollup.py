"""Hourly rollups and mergeable baseline profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hourly(readings: DataFrame, keys: list[str], time: str = "ts", value: str = "value", on_at: float | None = None) -> DataFrame:
    """``bucket, keys, avg_value, min_value, total_samples`` (and ``on_samples``: readings at or above ``on_at``)."""
    figures = [F.avg(value).alias("avg_value"), F.min(value).alias("min_value"), F.count("*").alias("total_samples")]
    if on_at is not None:
        figures.append(F.count_if(F.col(value) >= on_at).alias("on_samples"))
    return readings.groupBy(F.date_trunc("hour", F.col(time).cast("timestamp")).alias("bucket"), *keys).agg(*figures)


def closed(rollup: DataFrame, as_of: Column) -> DataFrame:
    """Buckets that ended an hour or more before ``as_of``'s hour: the scan filter of every detector."""
    return rollup.where(F.col("bucket") <= F.date_trunc("hour", as_of) - F.expr("INTERVAL 1 HOUR"))


def last_bucket(rollup: DataFrame, as_of: Column) -> DataFrame:
    """All rows of the latest closed bucket, one bucket for the whole table, found before any other filter."""
    shut = closed(rollup, as_of)
    return shut.join(F.broadcast(shut.agg(F.max("bucket").alias("bucket"))), "bucket")


def look_back(rollup: DataFrame, as_of: Column, hours: int, buckets: str = "last") -> DataFrame:
    """Rows of the ``hours`` buckets up to and with ``bucket``: of the latest closed one, or of ``all`` closed ones.

    In history mode a row is copied to each of the ``hours`` buckets that see it.
    """
    shut = closed(rollup, as_of)
    end = F.broadcast(shut.agg(F.max("bucket").alias("_end")))  # one row
    if buckets == "last":
        rows = shut.join(end, F.col("bucket") > F.col("_end") - F.make_interval(hours=F.lit(hours)))
        return rows.withColumn("bucket", F.col("_end")).drop("_end")
    later = F.transform(F.sequence(F.lit(0), F.lit(hours - 1)), lambda k: F.col("bucket") + F.make_interval(hours=k))
    rows = shut.withColumn("bucket", F.explode(later))
    return rows.join(end, F.col("bucket") <= F.col("_end")).drop("_end")


def calendar(df: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Adds ``day, hour_of_day, weekday`` (Monday is 1)."""
    return df.withColumns(
        {"day": F.to_date(bucket), "hour_of_day": F.hour(bucket), "weekday": F.weekday(bucket) + F.lit(1)}
    )


def baseline(rollup: DataFrame, keys: list[str], value: str = "avg_value") -> DataFrame:
    """Partial statistics ``n, mean, m2`` per day, hour of day, weekday and key; a sample is an hourly value."""
    rows = calendar(rollup.where(F.col(value).isNotNull()))
    return rows.groupBy("day", "hour_of_day", "weekday", *keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("m2")
    )


def merge(states: DataFrame, keys: list[str]) -> DataFrame:
    """Merged ``n, mean, stddev`` of partial statistics (pairwise centred form); stddev is NULL under two samples."""
    group = Window.partitionBy(*keys)
    total = F.sum("n").over(group)
    centre = F.sum(F.col("n") * F.col("mean")).over(group) / total
    rows = states.withColumn("_mean", centre)
    moved = F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2))
    out = rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.first("_mean").alias("mean"), moved.alias("_m2"))
    return out.withColumn("stddev", F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (F.col("n") - 1)))).drop("_m2")


def profile_history(rollup: DataFrame, keys: list[str], value: str = "avg_value", days: int = 60, scope: str = "before_day") -> DataFrame:
    """Every bucket with the baseline it had at the time: adds ``n, mean, stddev``.

    The states of one key, hour and weekday are merged by a range window over
    days, so no bucket is joined with its past. Sums are taken around the
    group's mean to keep the precision of the pairwise form.
    ``scope``: ``before_day`` leaves the bucket's own day out, ``unbounded`` has no upper end.
    """
    rows = calendar(rollup)
    group = ["hour_of_day", "weekday", *keys]
    states = baseline(rollup, keys, value).withColumn("_at", F.unix_date("day"))
    every = Window.partitionBy(*group)
    states = states.withColumn("_c", F.sum(F.col("n") * F.col("mean")).over(every) / F.sum("n").over(every))
    shift = F.col("mean") - F.col("_c")
    past = Window.partitionBy(*group).orderBy("_at")
    span = past.rangeBetween(-days + 1, -1) if scope == "before_day" else past.rangeBetween(-days + 1, Window.unboundedFollowing)
    states = states.withColumns(
        {
            "_n": F.sum("n").over(span),
            "_s": F.sum(F.col("n") * shift).over(span),
            "_q": F.sum(F.col("m2") + F.col("n") * shift * shift).over(span),
        }
    )
    out = rows.join(states.select("day", *group, "_c", "_n", "_s", "_q"), ["day", *group], "left")
    m2 = F.greatest(F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n"), F.lit(0.0))
    return out.withColumns(
        {"n": F.col("_n"), "mean": F.col("_c") + F.col("_s") / F.col("_n"), "stddev": F.when(F.col("_n") > 1, F.sqrt(m2 / (F.col("_n") - 1)))}
    ).drop("_c", "_n", "_s", "_q")


def from_states(rows: DataFrame, states: DataFrame, keys: list[str], days: int = 60) -> DataFrame:
    """Rows of one bucket with the merged ``n, mean, stddev`` of stored states (``on_day`` and as ``baseline``) of the days before.

    A row meets the states of its own key, hour and weekday in the look-back: one a week. Rows without any go.
    """
    rows = calendar(rows)
    past = F.col("on_day").between(F.date_sub("day", days - 1), F.date_sub("day", 1))
    met = rows.select("bucket", "day", "hour_of_day", "weekday", *keys).join(states, ["hour_of_day", "weekday", *keys]).where(past)
    return rows.join(merge(met, ["bucket", *keys]), ["bucket", *keys])
