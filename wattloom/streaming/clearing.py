"""Open and cleared entities kept as state in a stream.

An entity of a use case is open from the run at which it fires. At the first later run of its use case at which it does not fire
it is cleared once, with the severity it had; if no run comes within the look-back it expires and nothing is said. That is what
``store.open_entities``, ``cleared`` and ``clear_markers`` find from tables, run by run.

State is held per use case and bucket of entities, so a use case with very many entities spreads over tasks; the news
that a use case ran goes to each of its buckets. Rows may come in any order within the watermark: hits and runs
wait in the state and are gone through in order of time by event-time timers, a time's hits before its run. State is in
RocksDB under the stream's checkpoint, so a restarted stream goes on where it was, and holds open entities only.

The watermark is that of the stream that is further behind, so a stream that falls silent holds back the other. A hit without
severity and a run without use case are signs of time (``reached``): they say only how far their stream has come. Whoever
writes the streams sends them when nothing fires, and at the end, or the last runs stay unjudged. A restarted stream goes on
from the joint watermark only, so then both streams have to send rows before it moves.

Defined results: a null entity is one of its own; of hits of one entity and time the first by source, metric and
detector counts; repeated hits and runs change nothing; rows later than the watermark are dropped, as everywhere in Spark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .. import shipping

NAMES = ["source", "metric", "detector", "severity"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed timers need, for queries started inside; the session's own setting comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class OpenEntities(StatefulProcessor):
    """Of one use case and bucket: what waits for the watermark, and what is open since when."""

    def __init__(self, days: int) -> None:
        self.span = days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hits = handle.getMapState("hits", "at long, entity string", "source string, metric string, detector string, severity string")
        self.runs = handle.getMapState("runs", "at long", "ran boolean")
        self.open = handle.getMapState("open", "entity string", "at long, source string, metric string, detector string, severity string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: ANN001, N803
        for r in rows:
            if r.ran is None:  # a sign of time
                continue
            if r.ran:
                self.runs.updateValue((r.at,), (True,))
            else:
                held, row = self.hits.getValue((r.at, r.key)), tuple(r[c] for c in NAMES)
                if held is None or [x or "" for x in row[:3]] < [x or "" for x in held[:3]]:
                    self.hits.updateValue((r.at, r.key), row)
            self.handle.registerTimer(r.at)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: ANN001, N803
        now = expiredTimerInfo.getExpiryTimeInMs()
        fired = [(k, v) for k, v in self.hits.iterator() if k[0] == now]
        for (_, entity), row in fired:
            self.hits.removeKey((now, entity))
            self.open.updateValue((entity,), (now, *row))
            self.handle.registerTimer(now + self.span)
        ran = self.runs.containsKey((now,))
        if ran:
            self.runs.removeKey((now,))
        out = []
        for (entity,), (at, *row) in list(self.open.iterator()):
            if at <= now - self.span:
                self.open.removeKey((entity,))
            elif ran and at < now:
                self.open.removeKey((entity,))
                when = dt.datetime.fromtimestamp(now / 1000, dt.UTC)
                out.append(Row(uc=key[0], entity=entity[1:] if entity else None, time=when, **dict(zip(NAMES, row, strict=True))))
        return iter(out)

    def close(self) -> None:
        pass


def clears(hits: DataFrame, ran: DataFrame, late: str = "1 hour", days: int = 7, buckets: int = 16) -> DataFrame:
    """A stream of ``uc, entity, time, source, metric, detector, severity``: entities that went quiet, at the run that showed it.

    ``hits``: a stream of ``uc, entity, time, source, metric, detector, severity``; ``ran``: one of ``uc, time``, a row for each run
    of a use case. Either may hold rows of ``reached``. Start the query inside ``rocks``. Times count in milliseconds.
    """
    shipping.ship(hits.sparkSession)
    at = F.unix_millis("time").alias("at")
    key = F.when(F.col("entity").isNull(), "").otherwise(F.concat(F.lit("="), "entity"))
    mine = hits.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", late)
    mine = mine.select("uc", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), "time", at, key.alias("key"), F.when(F.col("severity").isNotNull(), False).alias("ran"), *NAMES)
    all_ = ran.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", late)
    none = [F.lit(None).cast("string").alias(c) for c in ["key", *NAMES]]
    all_ = all_.select("uc", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "time", at, none[0], F.when(F.col("uc").isNotNull(), True).alias("ran"), *none[1:])
    made = "uc string, entity string, time timestamp, source string, metric string, detector string, severity string"
    return mine.unionByName(all_).groupBy("uc", "bucket").transformWithState(OpenEntities(days), made, "Append", "EventTime")


def reached(rows: DataFrame, time: Column) -> DataFrame:
    """One row shaped like ``rows``, of hits or of runs: their stream has come to ``time``, and no earlier row will follow."""
    return rows.sparkSession.range(1).select(*((time if c == "time" else F.lit(None)).cast(kind).alias(c) for c, kind in rows.dtypes))


def start_clears(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:  # noqa: ANN003
    """Write a stream of ``clears`` to Parquet at ``path``."""
    with rocks(stream.sparkSession):
        return stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def replay(spark: SparkSession, parts: list[DataFrame], folder: str, run: Callable[[], None] | None = None) -> None:
    """Write ``parts`` one after the other as the files of a stream's source; ``run`` after each."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(folder)
        if run:
            run()
