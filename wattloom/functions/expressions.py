"""Column expressions: severities, z-scores, names, labels, local time, energy figures.

All are built-in expressions, so they stay inside generated code and fold into
whatever plan uses them. None reads the clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEVERITIES = ("info", "warning", "critical")


def usable(x: Column) -> Column:
    """Neither NULL nor NaN. (In Spark NaN >= 3 is true, so every threshold needs this guard.)"""
    return x.isNotNull() & ~F.isnan(x.cast("double"))


def tier(x: Column, info: float, warning: float, critical: float, below: bool = False, strict_info: bool = False, strict: bool = False) -> Column:
    """The severity of a value by three cut-offs, NULL under the first or if not usable.

    ``below``: smaller is worse, cut-offs then always strict. ``strict`` and
    ``strict_info``: a value at the cut-off (the first one only) does not count.
    """

    def hit(cut: float, exclusive: bool) -> Column:
        if below:
            return x < cut
        return x > cut if exclusive else x >= cut

    graded = F.when(hit(critical, strict), "critical").when(hit(warning, strict), "warning").when(hit(info, strict or strict_info), "info")
    return F.when(usable(x), graded)


def severity_rank(severity: Column) -> Column:
    """0 for NULL, then 1 to 3."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, SEVERITIES)), severity), F.lit(0)).cast("int")


def at_least(severity: Column, floor: Column | str) -> Column:
    """The severity if it reaches the floor, else NULL."""
    floor = F.lit(floor) if isinstance(floor, str) else floor
    return F.when(severity_rank(severity) >= severity_rank(floor), severity)


def escalated(old: Column, new: Column) -> Column:
    """A known severity became a higher one."""
    return F.coalesce(old.isNotNull() & (severity_rank(new) > severity_rank(old)), F.lit(False))


def zscore(actual: Column, mean: Column, stddev: Column, rel=0.0, absolute=0.0, deadband_abs=0.0, deadband_rel=0.0) -> Column:
    """(actual - mean) / max(stddev, floors); NULL inside the deadband, without spread or if anything is unusable."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    spread = F.greatest(stddev, as_column(absolute), as_column(rel) * F.abs(mean))
    away = F.abs(actual - mean) >= F.greatest(as_column(deadband_abs), as_column(deadband_rel) * F.abs(mean))
    fine = usable(actual) & usable(mean) & usable(stddev) & (spread > 0) & away
    return F.when(fine, (actual - mean) / spread)


def warm_up(severity: Column, since: Column, as_of: Column, days: int) -> Column:
    """``info`` instead of anything higher while the model is younger than ``days``."""
    return F.when(severity.isNotNull() & (as_of < since + F.make_interval(days=F.lit(days))), "info").otherwise(severity)


def slug(name: Column) -> Column:
    """Lower case, umlauts spelt out, all else one hyphen."""
    out = F.lower(name)
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(out, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def entity(keys: dict[str, Column], emit: bool = True) -> Column:
    """Who an anomaly is about: the address as slug, inv<id>, meter<id>, else all values joined; NULL for none."""
    if not emit or not keys:
        return F.lit(None).cast("string")
    if "ga" in keys:
        return slug(keys["ga"])
    if list(keys) == ["inverter_id"]:
        return F.concat(F.lit("inv"), keys["inverter_id"].cast("string"))
    if list(keys) == ["meter_id"]:
        return F.concat(F.lit("meter"), keys["meter_id"].cast("string"))
    return slug(F.concat_ws("-", *(k.cast("string") for k in keys.values())))


def metric_label(metric: Column | str, *keys: Column) -> Column:
    """``metric`` or ``metric[v1,v2]``."""
    metric = F.lit(metric) if isinstance(metric, str) else metric
    return F.concat(metric, F.lit("["), F.concat_ws(",", *(k.cast("string") for k in keys)), F.lit("]")) if keys else metric


def floor_of(name: Column) -> Column:
    """The second dotted part of a channel name, '' if there is none."""
    return F.split_part(name, F.lit("."), F.lit(2))


def hour_active(on: Column, total: Column, least: float = 0.5) -> Column:
    return F.coalesce(on / F.when(total != 0, total) >= least, F.lit(False))


def local_midnight(as_of: Column, zone: str) -> Column:
    """The UTC time at which the local day of ``as_of`` began."""
    return F.to_utc_timestamp(F.date_trunc("day", F.from_utc_timestamp(as_of, zone)), zone)


def to_utc(text: Column, zone: str) -> Column:
    """A naive local time string as UTC; an ambiguous time takes the earlier offset."""
    return F.to_utc_timestamp(F.to_timestamp_ltz(text), zone)


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 1e6


def balance(generation: Column, imported: Column, exported: Column) -> dict[str, Column]:
    """Household energy figures in kWh and per cent; rates are 0 without a denominator and end at 0 and 100."""
    consumption = generation + imported - exported
    direct = F.greatest(generation - exported, F.lit(0.0))

    def rate(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, F.greatest(F.least(100 * part / whole, F.lit(100.0)), F.lit(0.0))).otherwise(F.lit(0.0))

    return {
        "consumption_kwh": F.round(F.greatest(consumption, F.lit(0.0)), 3),
        "direct_use_kwh": F.round(direct, 3),
        "self_consumption_pct": F.round(rate(direct, generation), 1),
        "self_sufficiency_pct": F.round(rate(direct, consumption), 1),
    }
