"""Energy balance and yield against forecast, from counters and curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as x
from . import series as s


def energy_balance(generation: DataFrame, meters: DataFrame, keys: list[str], imported: Column, exported: Column) -> DataFrame:
    """The balance per ``keys`` (a day, a site): kWh figures and rates.

    ``generation``: counter deltas in Wh with ``keys``; ``meters``: deltas in kWh
    with ``keys``, of which the two predicates pick the import and the export
    meter. What is missing counts as 0.
    """
    made = s.floored_sum(generation, keys).withColumnRenamed("kwh", "generation_kwh")
    grid = meters.groupBy(*keys).agg(
        F.max(F.when(imported, F.col("delta"))).alias("import_kwh"), F.max(F.when(exported, F.col("delta"))).alias("export_kwh")
    )
    rows = made.join(grid, keys, "full_outer")
    rows = rows.select(*keys, *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("generation_kwh", "import_kwh", "export_kwh")))
    return rows.withColumns(x.balance(F.col("generation_kwh"), F.col("import_kwh"), F.col("export_kwh")))


def pv_underperformance(
    actual: DataFrame,
    expected: DataFrame,
    keys: list[str],
    least_kwh: float = 3.0,
    tiers: tuple[float, float, float] = (0.65, 0.5, 0.35),
) -> DataFrame:
    """``actual_kwh`` against ``expected_kwh`` per key: adds ``ratio, severity``, NULL where too little was expected."""
    rows = actual.join(expected, keys)
    exact = F.when(F.col("expected_kwh") >= least_kwh, F.col("actual_kwh") / F.col("expected_kwh"))
    return rows.withColumn("ratio", F.round(exact, 3)).withColumn("severity", x.tier(exact, *tiers, below=True))
