"""A keyed table as a journal: changes are appended under a batch number, the newest of each key and column wins, days are compacted.

Appending never touches what is stored, so a reader sees the table before or after a batch, a writer that dies leaves
nothing, and a batch that is sent again changes nothing. A change row carries the names of the columns it sets where its key exists
(``update``, as in ``store.upsert``): all, some, or none, which is an insertion if the key is missing.

``compact`` folds the finished changes of the touched days into new versions of those days; readers take a day's version and
only the changes after it. Keys hold their time, so a key never moves to another day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import store, versions

_EXTRA = "_batch long, _set array<string>"


class Journal:
    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, key: list[str], time: str = "time") -> None:
        self.spark, self.path, self.key, self.time = spark, path.rstrip("/"), key, time
        self.schema = spark.createDataFrame([], schema).schema
        self.others = [c for c in self.schema.names if c not in key]
        self._stored = StructType(self.schema.fields + spark.createDataFrame([], _EXTRA).schema.fields)

    def has(self, batch: int) -> bool:
        return versions.finished(self.spark, f"{self.path}/changes/batch={batch}")

    def append(self, rows: DataFrame, batch: int, update: list[str] | None = None) -> bool:
        """Add the changes of a batch; whether it was new. Numbers rise: one below a compaction's that never came is an error.

        Columns that ``rows`` does not have are NULL and not set; of rows that repeat a key the one with the largest other columns counts.
        """
        if self.has(batch):
            return False
        if batch <= max(versions.numbers(self.spark, f"{self.path}/days", "version"), default=-1):
            raise ValueError(f"batch {batch} comes after a compaction that would have held it")
        there = [c for c in self.others if c in rows.columns]
        sets = there if update is None else update
        kept = store.one_of_each(rows.select(*self.key, *there), self.key)
        full = kept.select(*(F.col(c) if c in kept.columns else F.lit(None).cast(self.schema[c].dataType).alias(c) for c in self.schema.names))
        full = full.withColumns({"_batch": F.lit(batch).cast("long"), "_set": F.array(*map(F.lit, sets)).cast("array<string>")})
        return versions.write_once(full.withColumn("day", F.to_date(self.time)), f"{self.path}/changes/batch={batch}", "day")

    def _days_of(self, batch: int) -> list[str]:
        return versions.children(self.spark, f"{self.path}/changes/batch={batch}", "day=")

    def rows(self, batch: int) -> DataFrame:
        """The change rows of a batch."""
        folders = [f"{self.path}/changes/batch={batch}/day={d}" for d in self._days_of(batch)]
        rows = self.spark.read.schema(self._stored).parquet(*folders) if folders else self.spark.createDataFrame([], self._stored)
        return rows.select(*self.schema.names)

    def _open(self, days: set[str] | None, before: int | None) -> list[tuple[int, str]]:
        """Changes that no compaction holds: ``(batch, day)``."""
        base = versions.newest(self.spark, f"{self.path}/days")
        batches = [b for b in versions.numbers(self.spark, f"{self.path}/changes", "batch") if before is None or b < before]
        return [(b, d) for b in batches for d in self._days_of(b) if b > base.get(d, -1) and (days is None or d in days)]

    def _fold(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        """The latest value of each column among the rows that set it, or that of the row that came first."""
        rows = base.withColumns({"_batch": F.lit(-1).cast("long"), "_set": F.lit(None).cast("array<string>")}).unionByName(changes)
        cols = []
        for c in self.others:
            sets = F.when(F.col("_set").isNull() | F.array_contains("_set", c), F.col("_batch"))
            latest, first = F.max_by(F.struct(c), sets), F.min_by(F.struct(c), "_batch")
            cols.append(F.coalesce(latest, first)[c].alias(c))
        return rows.groupBy(*self.key).agg(*cols).select(*self.schema.names)

    def view(self, first: str | None = None, last: str | None = None, days: list | None = None, before: int | None = None) -> DataFrame:
        """The table, of all days or some; ``before``: as it was before a batch (none that is compacted)."""
        only = None if days is None else {str(d) for d in days}
        changed = [(b, d) for b, d in self._open(only, before) if (first is None or d >= first) and (last is None or d <= last)]
        base = versions.read(self.spark, f"{self.path}/days", self.schema, None, first, last, days)
        if not changed:
            return base
        rows = self.spark.read.schema(self._stored).parquet(*[f"{self.path}/changes/batch={b}/day={d}" for b, d in changed])
        return self._fold(base, rows)

    def compact(self, upto: int | None = None) -> list[str]:
        """Fold the changes of batches up to one into their days; the days."""
        open_ = self._open(None, None if upto is None else upto + 1)
        days = sorted({d for _, d in open_})
        if days:
            version = max(b for b, _ in open_)
            versions.write_days(self.view(days=days, before=version + 1), f"{self.path}/days", self.time, version)
        return days

    def vacuum(self) -> int:
        """Remove day versions and changes that no reader takes any more; how many folders."""
        gone, base = versions.vacuum(self.spark, f"{self.path}/days"), versions.newest(self.spark, f"{self.path}/days")
        for b in versions.numbers(self.spark, f"{self.path}/changes", "batch"):
            for d in self._days_of(b):
                if b <= base.get(d, -1):
                    store.remove(self.spark, f"{self.path}/changes/batch={b}/day={d}")
                    gone += 1
        return gone
