"""Profile z-scores and the rule detectors. All score ``last`` or ``all`` closed buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as x
from . import blocks
from . import rollup as r
from . import series as s


def zscore_profile(
    rollup: DataFrame, keys: list[str], as_of: Column, value: str = "avg_value", buckets: str = "all", scope: str = "before_day",
    days: int = 60, floor: str = "info", knobs: dict[str, float] | None = None,
) -> DataFrame:
    """Closed buckets against their baseline: adds ``n, mean, stddev, zscore, severity``.

    Buckets without a usable baseline are left out; others stay, with a NULL severity if nothing is wrong.
    """
    rows, end = r.closed(rollup, as_of), F.broadcast(r.closed(rollup, as_of).agg(F.max("bucket").alias("_end")))  # one row
    if buckets == "last":
        rows = rows.join(end, F.col("bucket") > F.col("_end") - F.make_interval(days=F.lit(days + 2))).drop("_end")
    rows = r.profile_history(rows, keys, value, days, scope)
    if buckets == "last":
        rows = rows.join(end, F.col("bucket") == F.col("_end")).drop("_end")
    rows = rows.where(x.usable(F.col(value)) & x.usable(F.col("mean")) & x.usable(F.col("stddev")))
    z = x.zscore(F.col(value), F.col("mean"), F.col("stddev"), **(knobs or {}))
    return rows.withColumn("zscore", z).withColumn("severity", x.at_least(x.tier(F.abs("zscore"), 3.0, 4.0, 6.0), floor))


def fan_out(rollups: dict[str, DataFrame], use_cases: DataFrame, as_of: Column, buckets: str = "all", days: int = 60) -> DataFrame:
    """Every metric of every source with its own knobs, in one plan.

    ``rollups``: source name to wide rollup. Wide columns become rows
    ``source, metric, label, bucket, value``, meet the broadcast use-case
    table (silenced ones dropped) and are scored by one window. ``scope``
    predicates apply to the wide rows of their source. With ``buckets="last"`` only the
    look-back of ``days`` before each source's last closed bucket is scored.
    """
    cells: dict[str, list[Column]] = {}
    rows = use_cases.where("NOT silenced").select("source", "metric", "keys", "scope").distinct().collect()  # configuration, not data
    for source, metric, keys, scope in rows:
        names = [F.col(k) for k in keys]
        cell = F.struct(
            F.lit(metric).alias("metric"), F.col(metric).cast("double").alias("value"),
            x.metric_label(metric, *names).alias("label"), x.entity(dict(zip(keys, names, strict=True))).alias("entity"),
        )
        cells.setdefault(source, []).append(F.when(F.expr(scope), cell) if scope else cell)
    parts = [
        rollups[source].select(F.lit(source).alias("source"), "bucket", F.explode(F.array(*made)).alias("m")).where("m IS NOT NULL").select("source", "bucket", "m.*")
        for source, made in cells.items() if source in rollups
    ]
    long = reduce(DataFrame.unionByName, parts)
    shut = r.closed(long, as_of)
    if buckets == "last":
        ends = shut.groupBy("source").agg(F.max("bucket").alias("_end"))  # a row a source
        shut = shut.join(F.broadcast(ends), "source").where(F.col("bucket") > F.col("_end") - F.make_interval(days=F.lit(days + 2)))
    scored = r.profile_history(shut, ["source", "metric", "label"], "value", days)  # the entity goes with the label, and is NULL without keys
    if buckets == "last":
        scored = scored.where("bucket = _end").drop("_end")
    scored = scored.where(x.usable(F.col("value")) & x.usable(F.col("mean")) & x.usable(F.col("stddev")))
    scored = scored.join(F.broadcast(use_cases.where("NOT silenced").drop("keys", "scope")), ["source", "metric"])
    z = x.zscore(F.col("value"), F.col("mean"), F.col("stddev"), F.col("stddev_rel"), F.col("stddev_abs"), F.col("deadband_abs"), F.col("deadband_rel"))
    scored = scored.withColumn("zscore", z).withColumn("severity", x.at_least(x.tier(F.abs("zscore"), 3.0, 4.0, 6.0), F.col("floor")))
    return scored.withColumn("entity", F.when(F.col("emit_entity"), F.col("entity")))


def by_role(readings: DataFrame, group: list[str], roles: dict[str, tuple[Column, str]], value: str = "avg_value") -> DataFrame:
    """A column per role: the average or maximum of the values whose channel matches; one pass."""
    made = [(F.avg if how == "avg" else F.max)(F.when(match, F.col(value))).alias(name) for name, (match, how) in roles.items()]
    return readings.groupBy(*group).agg(*made)


def room_roles() -> dict[str, tuple[Column, str]]:
    """Channel name patterns of a room. Fixed values."""
    name, kind = F.col("name"), F.col("function")
    return {
        "valve_pct": (name.like("%FBH.Stellwert-Status"), "avg"),
        "target_c": (name.like("%FBH.Soll-Temperatur-Status"), "avg"),
        "actual_c": (name.like("%Sensor.Temperatur") & (kind == "Sensorik"), "avg"),
        "window_open": (name.like("%Fenster%Geöffnet-Status") & ~name.like("%Stellung-%") & (kind == "Sicherheit"), "max"),
    }


def room_readings(rollup: DataFrame, catalog: DataFrame) -> DataFrame:
    """Channel rollups with ``room, floor, name, function`` of the channel; channels without a room go."""
    known = catalog.where("room IS NOT NULL").select("ga", "name", "room", "function")
    return rollup.join(known, "ga").withColumn("floor", x.floor_of(F.col("name")))


def cold_room(rooms: DataFrame, valve_above: float = 50.0, gap: tuple[float, float, float] = (1.0, 2.0, 3.0)) -> DataFrame:
    """Rows with ``valve_pct, target_c, actual_c`` whose valve is open and whose room stays cold: adds ``gap_c, severity``."""
    rows = rooms.withColumn("gap_c", F.col("target_c") - F.col("actual_c"))
    rows = rows.where(x.usable(F.col("valve_pct")) & x.usable(F.col("gap_c")) & (F.col("valve_pct") > valve_above) & (F.col("gap_c") > gap[0]))
    return rows.withColumn("severity", x.tier(F.col("gap_c"), *gap))


def window_while_heating(
    rooms: DataFrame,
    outdoor: DataFrame,
    join: list[str],
    cold_below: float = 12.0,
    valve: tuple[float, float, float] = (0.0, 25.0, 50.0),
) -> DataFrame:
    """Rows with ``window_open, valve_pct`` whose window is open while heating and it is cold outside (``outdoor_c``)."""
    rows = rooms.join(outdoor, join)
    rows = rows.where(x.usable(F.col("window_open")) & (F.col("window_open") > 0) & x.usable(F.col("valve_pct")) & (F.col("valve_pct") > valve[0]))
    rows = rows.where(x.usable(F.col("outdoor_c")) & (F.col("outdoor_c") < cold_below))
    return rows.withColumn("severity", x.tier(F.col("valve_pct"), *valve, strict_info=True))


def left_on_streak(
    rollup: DataFrame, keys: list[str], as_of: Column, most_active: float = 0.5, rate_days: int = 30, tiers: tuple[int, int, int] = (3, 6, 9), buckets: str = "all",
    spans: str | None = None,
) -> DataFrame:
    """Appliances on for hours in a row that are usually off: ``keys, bucket, streak, active_rate, severity``.

    ``rollup`` has ``on_samples, total_samples``. The rate of a bucket is over the
    ``rate_days`` up to its end, so history sees nothing of its future; always-on loads (rate at or over
    ``most_active``, or unknown) are skipped. A streak counts 24 hours at most. ``spans``: cut long series into such blocks of time.
    """
    shut = r.closed(rollup, as_of)
    end = F.broadcast(shut.agg(F.max("bucket").alias("_end")))  # one row
    if buckets == "last":
        shut = shut.join(end, F.col("bucket") > F.col("_end") - F.make_interval(days=F.lit(rate_days))).drop("_end")
    on = F.col("on_samples") / F.when(F.col("total_samples") != 0, F.col("total_samples"))
    recent = Window.partitionBy(*keys).orderBy(F.unix_timestamp("bucket")).rangeBetween(1 - (rate_days * 86_400 - 3_600), 0)
    rows = shut.withColumn("active_rate", F.avg((on >= 0.5).cast("double")).over(recent))
    active = x.hour_active(F.col("on_samples"), F.col("total_samples"))
    rows = blocks.trailing_streak(rows, keys, active, spans=spans) if spans else s.trailing_streak(rows, keys, active)
    if buckets == "last":
        rows = rows.join(end, F.col("bucket") == F.col("_end")).drop("_end")
    rows = rows.withColumn("streak", F.least("streak", F.lit(24))).where(F.col("active_rate") < most_active)
    rows = rows.withColumn("severity", x.tier(F.col("streak"), *tiers)).where("severity IS NOT NULL")
    return rows.select(*keys, "bucket", "streak", "active_rate", "severity")


def run_length_drift(
    found: DataFrame,
    keys: list[str],
    ambient: str = "ambient",
    warm_at: float = 24.0,
    most_minutes: float = 180.0,
    least_runs: int = 15,
    tiers: tuple[float, float, float] = (38.0, 45.0, 55.0),
) -> DataFrame:
    """Median run length on warm days per key: ``keys, n_runs, median_minutes, severity``; keys with too few runs go."""
    warm = found.where((F.col("minutes") < most_minutes) & x.usable(F.col(ambient)) & (F.col(ambient) >= warm_at))
    out = warm.groupBy(*keys).agg(F.count("*").alias("n_runs"), F.percentile("minutes", F.lit(0.5)).alias("median_minutes"))
    return out.where(F.col("n_runs") >= least_runs).withColumn("severity", x.tier(F.col("median_minutes"), *tiers))


def resolve_channel(catalog: DataFrame, pattern: str, function: str | None = None) -> DataFrame:
    """The one channel whose name matches: the smallest address of several."""
    rows = catalog.where(F.col("name").like(pattern))
    rows = rows if function is None else rows.where(F.col("function") == function)
    return rows.agg(F.min("ga").alias("ga"))


def summary(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Counters of a scoring job per use case: scanned, hits, distinct entities fired."""
    hit = F.col("severity").isNotNull()
    return scored.groupBy(*keys).agg(
        F.count("*").alias("scanned"), F.count_if(hit).alias("hits"), F.countDistinct(F.when(hit, F.coalesce("entity", F.lit("")))).alias("entities")
    )


def newest_first(rows: DataFrame, keys: list[str], n: int, bucket: str = "bucket") -> DataFrame:
    """The ``n`` newest buckets of each key."""
    order = Window.partitionBy(*keys).orderBy(F.desc(bucket))
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n)
