"""Forecast documents to rows, and the figures read off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import to_utc


def map_rows(docs: DataFrame, column: str, zone: str, keep: list[str] | None = None) -> DataFrame:
    """``forecast_for, value`` for every entry of a map from local time to number; empty maps give no row."""
    rows = docs.select(*(keep or []), F.explode(column).alias("at", "value"))
    return rows.select(*(keep or []), to_utc(F.col("at"), zone).alias("forecast_for"), "value")


def pv_figures(docs: DataFrame, as_of: Column, zone: str, keep: list[str] | None = None) -> DataFrame:
    """``energy_today_kwh, energy_tomorrow_kwh, remaining_today_kwh, power_now_w`` of each document.

    A figure whose map is empty or lacks the day is NULL; power is 0 if no point
    of the current local hour is at or before ``as_of``, the remaining energy 0
    if no period is left.
    """
    local = F.from_utc_timestamp(as_of, zone)
    day = lambda n: F.date_format(F.date_add(F.to_date(local), n), "yyyy-MM-dd")
    key_time = lambda k: F.to_timestamp_ltz(k)
    entries = lambda m: F.map_entries(F.coalesce(m, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))))
    filled = lambda c: F.size(F.coalesce(F.map_keys(c), F.array().cast("array<string>"))) > 0

    def of_day(n: int) -> Column:
        return F.round(F.try_element_at("watt_hours_day", day(n)) / 1000, 3)

    left = F.filter(entries(F.col("watt_hours_period")), lambda e: (F.to_date(key_time(e["key"])) == F.to_date(local)) & (key_time(e["key"]) > local))
    left = F.round(F.aggregate(left, F.lit(0.0), lambda acc, e: acc + e["value"]) / 1000, 3)
    now = F.filter(entries(F.col("watts")), lambda e: (F.date_trunc("hour", key_time(e["key"])) == F.date_trunc("hour", local)) & (key_time(e["key"]) <= local))
    now = F.array_max(F.transform(now, lambda e: F.struct(key_time(e["key"]).alias("t"), e["value"].alias("v"))))["v"]
    return docs.select(
        *(keep or []),
        of_day(0).alias("energy_today_kwh"),
        of_day(1).alias("energy_tomorrow_kwh"),
        F.when(filled(F.col("watt_hours_period")), left).alias("remaining_today_kwh"),
        F.when(filled(F.col("watts")), F.coalesce(now, F.lit(0.0))).alias("power_now_w"),
    )


def array_rows(docs: DataFrame, time: str, fields: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """``forecast_for, metric, value`` from parallel arrays; nulls are skipped.

    ``fields``: array column to metric name. An array that is missing or not as long as
    the times is an error, not padding.
    """
    same = F.lit(True)
    for f in fields:
        same = same & (F.size(f) == F.size(time)) & F.col(f).isNotNull()
    checked = F.when(same, F.col(time)).otherwise(F.raise_error(F.lit("a forecast array is missing or of another length")).cast(docs.schema[time].dataType))
    rows = docs.select(*(keep or []), checked.alias("_t"), *fields).select(*(keep or []), F.explode(F.arrays_zip("_t", *fields)).alias("z"))
    pairs = ", ".join(f"'{name}', z.`{f}`" for f, name in fields.items())
    rows = rows.select(*(keep or []), F.col("z._t").alias("forecast_for"), F.expr(f"stack({len(fields)}, {pairs}) AS (metric, value)"))
    return rows.where("value IS NOT NULL")
