"""Structured Streaming: hourly rollups of closed buckets, and keyed upserts per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources import store


def hourly(readings: DataFrame, keys: list[str], time: str = "ts", value: str = "value", late: str = "1 hour") -> DataFrame:
    """Tumbling hourly rollup of a stream; in append mode a bucket comes out once, when the watermark closes it."""
    rows = readings.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    out = rows.groupBy(F.window(time, "1 hour").alias("w"), *keys).agg(
        F.avg(value).alias("avg_value"), F.min(value).alias("min_value"), F.count("*").alias("total_samples")
    )
    return out.select(F.col("w.start").alias("bucket"), *keys, "avg_value", "min_value", "total_samples")


def source(spark: SparkSession, folder: str, file: str, schema) -> DataFrame:
    """Parquet files named ``file`` in ``folder`` as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(folder)


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what its source has now, into Parquet files, and read them."""
    query = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def upsert_batches(path: str, key: list[str], time: str, score: Callable[[DataFrame], DataFrame], publish: Callable[[DataFrame], None] | None = None):
    """A ``foreachBatch`` function: score the batch, merge it into the table at ``path``, then publish what was new or escalated.

    Only the days the batch touches are read back and rewritten, so a batch costs
    its own days and not the table. Running a batch again gives the same table.
    """

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = score(batch).persist()
        days = [r[0] for r in new.select(F.to_date(time)).distinct().collect()]
        if days:
            try:
                old = spark.read.schema(StructType(list(new.schema)).add("day", "date")).parquet(path).where(F.col("day").isin(days)).drop("day")
                old.limit(1).count()
            except Exception as missing:  # noqa: BLE001  the first batch has no table yet
                if "PATH_NOT_FOUND" not in str(missing):
                    raise
                old = new.limit(0)
            news = store.work_folder(spark, "news")
            if publish:  # what is new is told against the table before the merge
                rows = store.to_publish(store.changes(old, new, key))
                rows.write.parquet(news)
            store.save(store.upsert(old, new, key), path, time)
            if publish:
                publish(spark.read.schema(rows.schema).parquet(news))
                store.remove(spark, news)
        new.unpersist()

    return run


def start(stream: DataFrame, batch: Callable, checkpoint: str, **trigger) -> StreamingQuery:
    return stream.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
