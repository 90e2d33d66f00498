"""Streams replayed from the driver tables, part by part, with a restart in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import detectors as d
from ..sources import store
from ..streaming import clearing
from .base import AS_OF_TEXT, SCORED, as_of, hourly, plain

#: Where the replay is cut; the stream stops after each part and starts again.
CUTS = ["2024-01-21"]
_UC = "CASE WHEN event_type IN ('click', 'view') THEN 'level_visits' ELSE 'level_others' END"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.zscore_profile(hourly(spark, sf_dir), ["event_type"], as_of()).select(F.expr(_UC).alias("uc"), F.col("event_type").alias("entity"), F.col("bucket").alias("time"), "severity")


def _cut(rows: DataFrame, time: str = "time") -> list[DataFrame]:
    ends = [None, *CUTS, None]
    out = []
    for low, high in zip(ends, ends[1:], strict=False):
        part = rows if low is None else rows.where(F.col(time) >= F.lit(low).cast("timestamp"))
        out.append(part if high is None else part.where(F.col(time) < F.lit(high).cast("timestamp")))
    return out


def r3_streamed_clears(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Use cases of several channels, run hour by hour as a stream that is stopped and restarted: which channels were cleared when."""
    place = store.work_folder(spark, "clears")
    scored = _scored(spark, sf_dir).persist()
    hits = scored.where("severity IS NOT NULL").select("uc", "entity", "time", F.lit("events_1h").alias("source"), F.lit("avg_value").alias("metric"), F.lit("zscore").alias("detector"), "severity")
    ran = scored.select("uc", "time").distinct()

    def read(name: str, like: DataFrame) -> DataFrame:
        return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/{name}")

    for mine, theirs, end in zip(_cut(hits), _cut(ran), [*CUTS, AS_OF_TEXT], strict=True):
        # a part is whole when it is written: both streams have come to its end, just before the first time of the next one
        last = F.lit(end).cast("timestamp") - F.expr("INTERVAL '0.001' SECOND")
        clearing.replay(spark, [mine.unionByName(clearing.reached(hits, last))], f"{place}/hits")
        clearing.replay(spark, [theirs.unionByName(clearing.reached(ran, last))], f"{place}/runs")
        stream = clearing.clears(read("hits", hits), read("runs", ran), late="0 seconds", buckets=4)
        clearing.start_clears(stream, f"{place}/out", f"{place}/state").awaitTermination()
    scored.unpersist()
    gone = spark.read.schema(stream.schema).parquet(f"{place}/out")
    marks = store.clear_markers(gone.withColumnRenamed("time", "at"), F.col("at"))
    return plain(marks.select("time", "uc", F.get_json_object("payload", "$.entity").alias("entity"), "metric", "severity", "score"))


QUERIES = [r3_streamed_clears]

SQL = {
    "r3_streamed_clears": f"""WITH {SCORED}, s AS (SELECT {_UC} AS uc, event_type AS entity, bucket AS time, severity FROM profile),
hits AS (SELECT * FROM s WHERE severity IS NOT NULL), runs AS (SELECT DISTINCT uc, time FROM s),
next AS (SELECT h.uc, h.entity, h.severity, h.time AS fired, min(r.time) AS time FROM hits h JOIN runs r ON r.uc = h.uc AND r.time > h.time GROUP BY ALL)
SELECT time, uc, entity, 'avg_value' AS metric, severity, 0.0::DOUBLE AS score FROM next n
WHERE time < fired + INTERVAL 7 DAY AND NOT EXISTS (FROM hits h WHERE h.uc = n.uc AND h.entity = n.entity AND h.time = n.time)""",
}
