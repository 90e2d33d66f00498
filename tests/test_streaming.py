"""A streamed rollup equals the batch one, and upserting micro-batches twice changes nothing."""

from pyspark.sql import functions as F

from tests.conftest import DATA
from wattloom.operators import rollup
from wattloom.sources import readings, store
from wattloom.streaming import rollup as streaming


def test_stream_equals_batch(spark, tmp_path):
    events = readings.readings(spark, f"{DATA}/sf0.001/events.parquet")
    events.repartitionByRange(3, "ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = streaming.hourly(stream, ["event_type"]).writeStream.format("memory").queryName("hours").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {tuple(r) for r in spark.table("hours").select("bucket", "event_type", "total_samples").collect()}
    want = {tuple(r) for r in rollup.hourly(events, ["event_type"]).select("bucket", "event_type", "total_samples").collect()}
    last = max(b for b, *_ in want)
    assert got <= want and {r for r in want if (last - r[0]).total_seconds() > 2 * 3600} <= got


def test_batches_merge_and_publish_once(spark, tmp_path):
    path, sent = str(tmp_path / "table"), []

    def score(batch):
        return batch.select("time", F.lit("s").alias("source"), "metric", F.lit("d").alias("detector"), "severity")

    run = streaming.upsert_batches(path, store.ANOMALY_KEY, "time", score, lambda rows: sent.extend((r.metric, r.severity) for r in rows.collect()))
    make = lambda rows: spark.createDataFrame(rows, "time string, metric string, severity string").withColumn("time", F.col("time").cast("timestamp"))
    run(make([("2024-01-01 05:00:00", "a", "info"), ("2024-01-02 05:00:00", "b", "warning")]), 0)
    run(make([("2024-01-01 05:00:00", "a", "critical"), ("2024-01-01 06:00:00", "c", "info")]), 1)
    run(make([("2024-01-01 05:00:00", "a", "critical"), ("2024-01-01 06:00:00", "c", "info")]), 1)
    assert sorted(sent) == [("a", "critical"), ("a", "info"), ("b", "warning"), ("c", "info")]
    assert {(r.metric, r.severity) for r in store.load(spark, path).collect()} == {("a", "critical"), ("b", "warning"), ("c", "info")}
