"""Fan-out over use cases: the last buckets alone are the last buckets of the whole history."""

import pytest
from pyspark.sql import functions as F

from wattloom.functions import usecases
from wattloom.operators import detectors


def test_last_buckets_equal_those_of_the_whole_history(spark):
    hours = spark.range(200 * 24).select(F.col("id"), F.timestamp_seconds(F.lit(1_700_000_000 // 3600 * 3600) + F.col("id") * 3600).alias("bucket"))
    rows = hours.withColumn("name", F.explode(F.array(F.lit("a"), F.lit("b")))).withColumn("level", F.pmod(F.xxhash64("id", "name"), F.lit(1000)) / 10.0)
    sources = {"one_1h": rows, "two_1h": rows.where("id < 4700").withColumn("level", F.col("level") * 3)}  # the second one ends earlier
    cases = [(f"uc_{s}", s, "level", ["name"], "info", False, 0.0, 0.0, 0.0, 0.0, None, True) for s in sources]
    table, at = usecases.profiles(spark, cases), F.timestamp_seconds(F.lit(1_800_000_000))

    def scored(buckets):
        found = detectors.fan_out(sources, table, at, buckets).select("source", "label", "bucket", "value", "n", "mean", "stddev", "zscore", "severity")
        return {(r.source, r.label, r.bucket): r for r in found.collect()}

    every, last = scored("all"), scored("last")
    ends = {s: max(k[2] for k in every if k[0] == s) for s in sources}
    assert ends["one_1h"] > ends["two_1h"] and len(last) == 4
    assert set(last) == {k for k in every if k[2] == ends[k[0]]}
    for k, r in last.items():
        assert r.n == every[k].n > 1 and r.severity == every[k].severity
        assert [r.value, r.mean, r.stddev, r.zscore] == pytest.approx([every[k].value, every[k].mean, every[k].stddev, every[k].zscore])
