"""Multi-seasonal decomposition, forecast and anomaly check, in DataFrame operations.

Trend: centred moving average over a week. Seasons: means by hour of day of what the
trend leaves, then means by hour of week of what is left, each centred. The trend
goes on as the straight line through its last week. (An additive
approximation of MSTL, Bandara et al. 2021, without an order search.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as x

WEEK = 168


def _hour(bucket: str = "bucket") -> Column:
    return F.floor(F.unix_seconds(bucket) / 3600).cast("long")


def decompose(series: DataFrame, keys: list[str], value: str = "y") -> DataFrame:
    """A regular hourly series with ``trend, daily, weekly, residual``."""
    rows = series.withColumn("_h", _hour())
    near = Window.partitionBy(*keys).orderBy("_h").rowsBetween(-WEEK // 2, WEEK // 2)
    rows = rows.withColumn("trend", F.avg(value).over(near)).withColumns({"_d": F.col("_h") % 24, "_w": F.col("_h") % WEEK})
    rest = F.col(value) - F.col("trend")
    everything = Window.partitionBy(*keys)
    by_day, by_week = Window.partitionBy(*keys, "_d"), Window.partitionBy(*keys, "_w")
    rows = rows.withColumn("_r", rest)
    rows = rows.withColumn("daily", F.avg("_r").over(by_day) - F.avg("_r").over(everything))
    rows = rows.withColumn("_r", F.col("_r") - F.col("daily"))
    rows = rows.withColumn("weekly", F.avg("_r").over(by_week) - F.avg("_r").over(everything))
    return rows.withColumn("residual", F.col(value) - F.col("trend") - F.col("daily") - F.col("weekly")).drop("_r", "_d", "_w")


def forecast(series: DataFrame, keys: list[str], horizon: int = 24, width: float = 3.0, least: int = 2 * WEEK, value: str = "y") -> DataFrame:
    """``keys, forecast_for, forecast_value, forecast_lower, forecast_upper, sigma`` for the next hours of each series.

    Series with fewer than ``least`` points or no residual spread are left out.
    """
    parts = decompose(series, keys, value)
    fine = F.when(~F.isnan("residual"), F.col("residual"))
    newest = Window.partitionBy(*keys)
    parts = parts.withColumn("_end", F.max("_h").over(newest))
    line = parts.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.stddev_samp(fine).alias("sigma"),
        F.max("_end").alias("_end"),
        F.regr_slope(F.when(F.col("_h") > F.col("_end") - WEEK, F.col("trend")), (F.col("_h") - F.col("_end")).cast("double")).alias("_slope"),
        F.regr_intercept(F.when(F.col("_h") > F.col("_end") - WEEK, F.col("trend")), (F.col("_h") - F.col("_end")).cast("double")).alias("_level"),
    )
    line = line.where((F.col("n") >= least) & x.usable(F.col("sigma")) & (F.col("sigma") > 0))
    ahead = line.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    ahead = ahead.withColumn("_w", (F.col("_end") + F.col("step")) % WEEK)
    season = parts.groupBy(*keys, (F.col("_h") % WEEK).alias("_w")).agg((F.first("daily") + F.first("weekly")).alias("_season"))
    out = ahead.join(season, [*keys, "_w"])
    middle = F.col("_level") + F.col("_slope") * F.col("step") + F.col("_season")
    return out.select(
        *keys,
        F.timestamp_seconds((F.col("_end") + F.col("step")) * 3600).alias("forecast_for"),
        middle.alias("forecast_value"),
        (middle - width * F.col("sigma")).alias("forecast_lower"),
        (middle + width * F.col("sigma")).alias("forecast_upper"),
        "sigma",
    )


def anomalies(
    actual: DataFrame,
    predicted: DataFrame,
    keys: list[str],
    bucket: str = "bucket",
    value: str = "y",
    tiers: tuple[float, float, float] = (1.0, 1.5, 2.5),
    floor: str = "info",
) -> DataFrame:
    """Actual values at forecast times: adds ``score`` (sigmas away) and ``severity``."""
    rows = actual.join(predicted.withColumnRenamed("forecast_for", bucket), [*keys, bucket])
    score = F.abs(F.col(value) - F.col("forecast_value")) / F.col("sigma")
    return rows.withColumn("score", score).withColumn("severity", x.at_least(x.tier(F.col("score"), *tiers), floor))
