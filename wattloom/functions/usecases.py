"""Use-case tables: what to score, with which knobs. Plain rows that join with rollups.

The default rows are fixed values: the metrics, features and rules of a
household with boiler, solar inverter, battery, wall box and room automation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROFILE_SCHEMA = (
    "uc string, source string, metric string, keys array<string>, floor string, silenced boolean, stddev_rel double, "
    "stddev_abs double, deadband_abs double, deadband_rel double, scope string, emit_entity boolean"
)

_INVERTER, _METER, _CHANNEL = ["inverter_id"], ["meter_id"], ["ga", "knx_name"]
_FIRST = "inverter_id = 1"


def _profile(uc, source, metric, keys=(), silenced=False, rel=0.0, absolute=0.0, dead_abs=0.0, dead_rel=0.0, scope=None, emit=True):
    return (uc, source, metric, list(keys), "info", silenced, rel, absolute, dead_abs, dead_rel, scope, emit)


#: Fixed values.
PROFILES = [
    _profile("boiler_curburnpow", "ems_esp_boiler_1h", "curburnpow_avg", absolute=6.0),
    _profile("boiler_curflowtemp", "ems_esp_boiler_1h", "curflowtemp_avg"),
    _profile("boiler_rettemp", "ems_esp_boiler_1h", "rettemp_avg"),
    _profile("boiler_heatingactive", "ems_esp_boiler_1h", "heatingactive_samples"),
    _profile("dhw_curtemp", "ems_esp_dhw_1h", "curtemp_avg"),
    _profile("dhw_curflow", "ems_esp_dhw_1h", "curflow_avg"),
    _profile("solar_ac_power", "solaredge_inverter_1h", "ac_power_avg", _INVERTER),
    _profile("solar_inverter_temperature", "solaredge_inverter_1h", "temperature_avg", _INVERTER),
    _profile("pv_production", "solaredge_powerflow_1h", "pv_production_avg", _INVERTER),
    _profile("consumer_total", "solaredge_powerflow_1h", "consumer_total_avg", _INVERTER, True, scope=_FIRST, emit=False),
    _profile("grid_power", "solaredge_powerflow_1h", "grid_power_avg", _INVERTER, True, scope=_FIRST, emit=False),
    _profile("grid_consumption", "solaredge_powerflow_1h", "grid_consumption_avg", _INVERTER, True, scope=_FIRST, emit=False),
    _profile("grid_delivery", "solaredge_powerflow_1h", "grid_delivery_avg", _INVERTER, True, scope=_FIRST, emit=False),
    _profile("pv_self_consumption", "solaredge_powerflow_1h", "consumer_used_pv_production_avg", _INVERTER, True, scope=_FIRST, emit=False),
    _profile("battery_charge", "solaredge_powerflow_1h", "battery_charge_avg", _INVERTER, True, scope=_FIRST, emit=False),
    _profile("battery_discharge", "solaredge_powerflow_1h", "consumer_used_battery_production_avg", _INVERTER, True, scope=_FIRST, emit=False),
    _profile("battery_soc", "solaredge_battery_1h", "soc_avg", _INVERTER, True, dead_abs=5.0, scope=_FIRST, emit=False),
    _profile("wallbox_power_total", "warp_meter_1h", "power_total_avg", _METER),
    _profile("knx_value", "knx_1h", "avg_value", _CHANNEL, rel=0.15, dead_rel=0.25, scope="knx_name NOT LIKE '%Stromwert' AND knx_name NOT LIKE '%Helligkeit%'"),
    _profile("appliance_standby", "knx_appliance_1h", "idle_floor", _CHANNEL, rel=0.10, absolute=5.0, dead_abs=20.0),
]

#: uc, source, features, keys, hour of day as a feature, silenced. Fixed values.
FORESTS = [
    ("heating_iforest", "ems_esp_boiler_1h", ["curburnpow_avg", "curflowtemp_avg", "rettemp_avg", "outdoortemp_avg", "heatingactive_samples"], [], False, False),
    ("pv_iforest", "solaredge_powerflow_1h", ["pv_production_avg", "consumer_total_avg", "grid_power_avg", "grid_consumption_avg", "grid_delivery_avg"], _INVERTER, True, False),
    ("battery_iforest", "solaredge_battery_1h", ["soc_avg", "power_avg"], [], True, True),
    ("wallbox_iforest", "warp_meter_1h", ["power_total_avg", "voltage_l1_avg", "voltage_l2_avg", "voltage_l3_avg", "current_l1_avg", "current_l2_avg", "current_l3_avg"], _METER, False, False),
]
RULES = ["fbh_cold", "window_while_heating", "appliance_runtime", "freezer_icing"]
#: uc, source, metric, seasons in hours, look-back days, horizon hours, width of the bounds in sigmas, warm-up days. Fixed values.
SEASONALS = [("heating_activity_seasonal", "ems_esp_boiler_1h", "heatingactive_samples", [24, 168], 365, 24, 3.0, 14)]

IDENTIFIER = "^[a-z_][a-z0-9_]*$"


def profiles(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(PROFILES if rows is None else rows, PROFILE_SCHEMA)


def families(spark: SparkSession, profile_rows=None) -> DataFrame:
    """``family, uc`` of all use cases."""
    rows = [("profile", p[0]) for p in (PROFILES if profile_rows is None else profile_rows)]
    rows += [("forest", f[0]) for f in FORESTS] + [("rule", r) for r in RULES] + [("seasonal", s[0]) for s in SEASONALS]
    return spark.createDataFrame(rows, "family string, uc string")


def slugs(all_families: DataFrame) -> DataFrame:
    return all_families.select("uc").distinct()


def repeated_slugs(all_families: DataFrame) -> DataFrame:
    """Slugs that more than one use case has; to be empty."""
    return all_families.groupBy("uc").count().where("count > 1")


def bad_identifiers(use_cases: DataFrame) -> DataFrame:
    """Use cases whose source, metric or keys are no plain identifiers; to be empty."""
    names = F.concat(F.array("source", "metric"), F.col("keys"))
    return use_cases.where(F.exists(names, lambda n: ~n.rlike(IDENTIFIER)))
