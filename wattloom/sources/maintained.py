"""Stored hourly rollups and baseline states that follow their readings: only what changed is computed again.

Readings arrive in numbered batches. A refresh lists the hours that the new batches touch (the invalidation list, kept as
``plan/version=<n>``), reads the readings of those days only, computes those hours again, puts them beside the stored other hours
of the day, and writes new versions of the touched days of the rollup, then of the baseline states. Both count once the refresh is
marked done, so a reader has rollup and baseline of one refresh, the last or the one before. A refresh that dies
goes on by its plan.

Defined results: a batch that is sent again changes nothing; batches may come in any order, with readings of any age; a NULL
time belongs to no hour and is left out; a refresh without new batches, or of empty ones, writes no day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import rollup
from . import versions


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: its number, the batches it took up, and how many hours and days it wrote again."""

    version: int
    batches: list[int]
    hours: int
    days: list


class Rollups:
    """Readings, their hourly rollup and their baseline states in one folder."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], time: str = "ts", value: str = "value", on_at: float | None = None) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.time, self.value, self.on_at = keys, time, value, on_at

    def append(self, readings: DataFrame, batch: int) -> bool:
        """Store a batch of readings by day; whether it was new."""
        kept = readings.select(*self.schema.names).where(F.col(self.time).isNotNull()).withColumn("day", F.to_date(self.time))
        return versions.write_once(kept, f"{self.path}/readings/batch={batch}", "day")

    def done(self) -> int:
        """The last refresh that counts, 0 if none."""
        return max(map(int, versions.children(self.spark, f"{self.path}/done")), default=0)

    def _readings(self, batches: list[int], days: list | None = None) -> DataFrame:
        """Stored readings of some batches and days: folders of other days are not listed for the scan."""
        folders = []
        for b in batches:
            there = versions.children(self.spark, f"{self.path}/readings/batch={b}", "day=")
            folders += [f"{self.path}/readings/batch={b}/day={d}" for d in there if days is None or d in {str(x) for x in days}]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _hour(self):  # noqa: ANN202
        return F.date_trunc("hour", F.col(self.time).cast("timestamp")).alias("bucket")

    def _made(self, readings: DataFrame) -> DataFrame:
        return rollup.hourly(readings, self.keys, self.time, self.value, self.on_at)

    def _rollup_schema(self) -> StructType:
        return self._made(self.spark.createDataFrame([], self.schema)).schema

    def _states(self, hours: DataFrame) -> DataFrame:
        return rollup.baseline(hours, self.keys).withColumnRenamed("day", "on_day")

    def _plan(self, version: int) -> tuple[list[int], DataFrame]:
        """Batches and hours of a refresh: as it was planned before, or planned now."""
        folder, schema = f"{self.path}/plan", "batch int, bucket timestamp"
        if not versions.finished(self.spark, f"{folder}/version={version}"):
            known = self.spark.read.schema(schema).parquet(*[f"{folder}/version={v}" for v in range(1, version)]) if version > 1 else self.spark.createDataFrame([], schema)
            taken = {r.batch for r in known.select("batch").distinct().collect()}
            new = [b for b in versions.numbers(self.spark, f"{self.path}/readings", "batch") if b not in taken]
            rows = self.spark.createDataFrame([(b,) for b in new], "batch int").select("batch", F.lit(None).cast("timestamp").alias("bucket"))  # empty ones too
            for b in new:
                rows = rows.unionByName(self._readings([b]).select(self._hour()).distinct().select(F.lit(b).cast("int").alias("batch"), "bucket"))
            versions.write_once(rows, f"{folder}/version={version}")
        plan = self.spark.read.schema(schema).parquet(f"{folder}/version={version}")
        batches = sorted(r.batch for r in plan.select("batch").distinct().collect())
        return batches, plan.where("bucket IS NOT NULL").select("bucket").distinct()

    def refresh(self) -> Refreshed:
        """Take up all new batches."""
        version = self.done() + 1
        batches, hours = self._plan(version)
        days = sorted(r[0] for r in hours.select(F.to_date("bucket")).distinct().collect())
        n_hours = hours.count()
        if days:
            every = sorted(self._taken(version))
            again = self._made(self._readings(every, days).join(hours.withColumnRenamed("bucket", "_hour"), self._hour() == F.col("_hour"), "left_semi"))
            others = self.rollup(days=days).join(hours, "bucket", "left_anti")
            versions.write_days(others.unionByName(again), f"{self.path}/rollup", "bucket", version)
            fresh = versions.read(self.spark, f"{self.path}/rollup", self._rollup_schema(), version, days=days)
            versions.write_days(self._states(fresh), f"{self.path}/baseline", "on_day", version)
        versions.mark(self.spark, f"{self.path}/done/{version}")
        return Refreshed(version, batches, n_hours, days)

    def _taken(self, version: int) -> set[int]:
        """Batches that refreshes up to ``version`` planned for; one that arrives meanwhile waits for the next."""
        folders = [f"{self.path}/plan/version={v}" for v in range(1, version + 1)]
        return {r.batch for r in self.spark.read.schema("batch int, bucket timestamp").parquet(*folders).select("batch").distinct().collect()}

    def rollup(self, first: str | None = None, last: str | None = None, days: list | None = None) -> DataFrame:
        """The hourly rollup as of the last refresh; days outside are not read."""
        return versions.read(self.spark, f"{self.path}/rollup", self._rollup_schema(), self.done(), first, last, days)

    def baseline(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Baseline states (``on_day`` and as ``rollup.baseline``) as of the last refresh."""
        empty = self._states(self.spark.createDataFrame([], self._rollup_schema()))
        return versions.read(self.spark, f"{self.path}/baseline", empty.schema, self.done(), first, last)

    def vacuum(self) -> int:
        return sum(versions.vacuum(self.spark, f"{self.path}/{t}", self.done()) for t in ("rollup", "baseline"))
