"""Series in blocks of time, states that merge, quantiles by rank selection, and forests level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..operators import blocks, forest, forest_levels, quantiles, timeweight
from ..operators import detectors as d
from ..sources import store
from .base import ON_AT, as_of, events, hourly, plain
from .model_queries import _PIVOT, _matrix
from .profile_queries import SQL as PROFILE_SQL

KEYS = ["event_type"]


def w1_runs_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).where("event_type <> 'error'")
    return plain(blocks.runs(rows, ["user_id"], F.col("value") >= ON_AT, tie=["event_id"]).withColumn("minutes", F.round("minutes", 3)))


def w4_streak_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks.trailing_streak(hourly(spark, sf_dir), KEYS, x.hour_active(F.col("on_samples"), F.col("total_samples")), spans="week")
    return plain(rows.select("event_type", "bucket", F.col("streak").cast("long").alias("streak")))


def d4_left_on_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = d.left_on_streak(hourly(spark, sf_dir), KEYS, as_of(), most_active=0.6, spans="week")
    return plain(out.withColumn("streak", F.col("streak").cast("long")))


def a10_integral_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(blocks.integral(events(spark, sf_dir), KEYS, tie=["event_id"]))


def a10_merged_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours to days to months: area, time-weighted mean and count of a month equal those of its samples."""
    hours = timeweight.states(events(spark, sf_dir), KEYS, tie=["event_id"])
    months = timeweight.average(timeweight.merge(timeweight.merge(hours, KEYS, "day"), KEYS, "month"))
    return plain(months.select("event_type", F.col("span").alias("month"), "n", "area", "mean"))


def a7_merged_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rise and resets of every site's counter over all time, from the states of its days."""
    days = timeweight.states(events(spark, sf_dir), ["user_id"], spans="day", tie=["event_id"])
    out = timeweight.merge(days, ["user_id"])
    return plain(out.select("user_id", "rise", "resets", (F.col("last.v") - F.col("first.v")).alias("delta")))


def a12_selected_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quantiles.quantiles(events(spark, sf_dir), KEYS, "value", [0.5], bins=64, most=100)
    return plain(out.select("event_type", F.col("value").alias("median"), "n"))


def a14_selected_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quantiles.quantiles(events(spark, sf_dir), KEYS, "value", [forest.WARNING_AT, forest.CRITICAL_AT], bins=64, most=100)
    out = out.groupBy("event_type").agg(F.max(F.when(F.col("q") == forest.WARNING_AT, F.col("value"))).alias("warning"), F.max(F.when(F.col("q") == forest.CRITICAL_AT, F.col("value"))).alias("critical"))
    return plain(out)


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = store.work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TREE_COUNT = 20


def _nodes(matrix: DataFrame) -> DataFrame:
    return _kept(forest_levels.fit(matrix, 6, TREE_COUNT), "nodes")


def m3_level_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest's node table, fitted level by level."""
    return plain(_nodes(_matrix(spark, sf_dir)).select("tree", "node", "feature", F.round("cut", 6).alias("cut"), "size", "depth"))


def d6_level_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, thresholds and severities of an isolation forest by joins alone."""
    matrix = _matrix(spark, sf_dir)
    scores = _kept(forest_levels.score(matrix, _nodes(matrix)), "scores")
    limits = forest.thresholds(scores, F.lit("2024-01-01").cast("timestamp"))
    return plain(forest.classify(scores, limits, as_of()).select("bucket", F.round("score", 6).alias("score"), "severity"))


QUERIES = [
    w1_runs_in_blocks, w4_streak_in_blocks, d4_left_on_in_blocks, a10_integral_in_blocks, a10_merged_states, a7_merged_counters, a12_selected_median, a14_selected_quantiles,
    m3_level_forest, d6_level_scores,
]


def _share(*parts: str) -> str:
    return f"((('0x' || substr(md5({' || chr(58) || '.join(parts)}), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)"


def _forest_sql() -> str:
    seed, limit = f"'{forest_levels.SEED}'", forest_levels.depth_limit()
    out = f""", cells AS (SELECT *, [x0, x1, x2, x3, x4, x5] AS x FROM m),
d0 AS MATERIALIZED (SELECT tree, bucket, x, 0 AS node, ceil(log2(greatest(count(*) OVER (PARTITION BY tree), 2)))::INT AS lim FROM (
  SELECT tree, bucket, x FROM cells, range({TREE_COUNT}) t(tree)
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {_share(seed, "tree::VARCHAR", "strftime(bucket, '%Y-%m-%d %H:%M:%S')")}, bucket) <= {forest_levels.SUBSAMPLE}))"""
    for k in range(limit + 1):
        ranges = ", ".join(f"{{'f': {f}, 'low': min(x[{f + 1}]) OVER w, 'high': max(x[{f + 1}]) OVER w}}" for f in range(6))
        out += f""",
r{k} AS (SELECT *, count(*) OVER w AS size, list_filter([{ranges}], lambda r: r.high > r.low) AS wide FROM d{k} WINDOW w AS (PARTITION BY tree, node)),
p{k} AS (SELECT *, {k} >= lim OR size <= 1 OR len(wide) = 0 AS leaf, wide[floor({_share(seed, "tree::VARCHAR", "node::VARCHAR", "'feature'")} * len(wide))::INT + 1] AS pick FROM r{k}),
c{k} AS MATERIALIZED (SELECT tree, bucket, x, node, lim, size, CASE WHEN leaf THEN -1 ELSE pick.f END AS feature, CASE WHEN leaf THEN 0 ELSE pick.low + {_share(seed, "tree::VARCHAR", "node::VARCHAR", "'cut'")} * (pick.high - pick.low) END AS cut FROM p{k}),
d{k + 1} AS (SELECT tree, bucket, x, 2 * node + 1 + (x[feature + 1] >= cut)::INT AS node, lim FROM c{k} WHERE feature >= 0)"""
    out += ",\nnodes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT tree::INT AS tree, node::INT AS node, any_value(feature)::INT AS feature, any_value(cut)::DOUBLE AS cut, any_value(size)::INT AS size, {k}::INT AS depth FROM c{k} GROUP BY tree, node" for k in range(limit + 1)) + ")"
    path = "CASE WHEN n.size > 2 THEN 2 * (ln(n.size - 1) + 0.5772156649015329::DOUBLE) - 2 * (n.size - 1)::DOUBLE / n.size WHEN n.size = 2 THEN 1 ELSE 0 END"
    out += f""",
go AS (SELECT bucket, x, tree, 0 AS node FROM cells, range({TREE_COUNT}) t(tree)
  UNION ALL SELECT g.bucket, g.x, g.tree, 2 * g.node + 1 + (g.x[n.feature + 1] >= n.cut)::INT FROM go g JOIN nodes n ON n.tree = g.tree AND n.node = g.node WHERE n.feature >= 0),
paths AS (SELECT g.bucket, avg(n.depth + {path}) AS h FROM go g JOIN nodes n ON n.tree = g.tree AND n.node = g.node WHERE n.feature < 0 GROUP BY g.bucket),
norm AS (SELECT CASE WHEN s > 2 THEN 2 * (ln(s - 1) + 0.5772156649015329::DOUBLE) - 2 * (s - 1) / s WHEN s = 2 THEN 1 ELSE 1e-9 END AS c FROM (SELECT avg(size) AS s FROM nodes WHERE node = 0)),
scores AS (SELECT bucket, -pow(2, -h / c) AS score FROM paths, norm),
lim AS (SELECT quantile_cont(score, 0.005) AS warning, quantile_cont(score, 0.001) AS critical FROM scores)"""
    return out


SQL = {
    "w1_runs_in_blocks": PROFILE_SQL["w1_runs"],
    "w4_streak_in_blocks": PROFILE_SQL["w4_trailing_streak"],
    "d4_left_on_in_blocks": PROFILE_SQL["d4_left_on_streak"],
    "a10_integral_in_blocks": """WITH t AS (SELECT event_type, (value + lag(value) OVER o) / 2 * (epoch_us(ts) - epoch_us(lag(ts) OVER o)) / 1e6 / 3600 AS area
  FROM events WINDOW o AS (PARTITION BY event_type ORDER BY ts, event_id)) SELECT event_type, round(coalesce(sum(area), 0), 7) AS area FROM t GROUP BY 1""",
    "a10_merged_states": """WITH t AS (SELECT event_type, date_trunc('month', ts)::TIMESTAMP AS month, ts, (value + lag(value) OVER o) / 2 * (epoch_us(ts) - epoch_us(lag(ts) OVER o)) / 1e6 / 3600 AS area
  FROM events WINDOW o AS (PARTITION BY event_type, date_trunc('month', ts) ORDER BY ts, event_id))
SELECT event_type, month, count(*) AS n, round(sum(area), 7) AS area, round(sum(area) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / 3600), 7) AS mean FROM t GROUP BY 1, 2""",
    "a7_merged_counters": """WITH t AS (SELECT user_id, ts, event_id, value, lag(value) OVER o AS was FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, round(coalesce(sum(CASE WHEN value < was THEN value ELSE value - was END), 0), 7) AS rise, count(*) FILTER (value < was) AS resets,
  round(arg_max(value, (ts, event_id)) - arg_min(value, (ts, event_id)), 7) AS delta FROM t GROUP BY 1""",
    "a12_selected_median": PROFILE_SQL["a12_median"],
    "a14_selected_quantiles": "SELECT event_type, round(quantile_cont(value, 0.005), 7) AS warning, round(quantile_cont(value, 0.001), 7) AS critical FROM events GROUP BY 1",
    "m3_level_forest": f"WITH RECURSIVE {_PIVOT}{_forest_sql()} SELECT tree, node, feature, round(cut, 6) AS cut, size, depth FROM nodes WHERE (SELECT count(*) FROM m) > 0",
    "d6_level_scores": f"""WITH RECURSIVE {_PIVOT}{_forest_sql()} SELECT bucket, round(score, 6) AS score, CASE WHEN score < critical THEN 'critical' WHEN score < warning THEN 'warning' END AS severity
FROM scores, lim""",
}
