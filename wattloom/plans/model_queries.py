"""Energy, forecast, seasonal and isolation-forest queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..operators import energy as e
from ..operators import forecasts as fc
from ..operators import forest, seasonal
from ..operators import series as s
from ..sources import readings, store
from ..streaming import rollup as streaming
from .base import AS_OF_TEXT, HOURLY, as_of, events, hourly, plain

BUCKET_END = "2024-01-30 23:00:00"


def d11_energy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    made = s.counter_delta(rows.where("event_type = 'view'"), ["user_id", "day"])
    meters = s.counter_delta(rows.where("event_type IN ('click', 'purchase')"), ["event_type", "day"])
    return plain(e.energy_balance(made, meters, ["day"], F.col("event_type") == "click", F.col("event_type") == "purchase"))


def d8_pv_underperformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    actual = s.floored_sum(s.counter_delta(rows.where("event_type = 'view'"), ["user_id", "day"]), ["day"], 100.0).withColumnRenamed("kwh", "actual_kwh")
    curve = s.integral(rows.where("event_type = 'purchase'"), ["day"], tie=["event_id"])
    return plain(e.pv_underperformance(actual, curve.select("day", (F.col("area") / 100).alias("expected_kwh")), ["day"]))


def _pv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast document a day: maps from local hour to a figure."""
    rows = hourly(spark, sf_dir).where("event_type = 'view'").withColumn("day", F.to_date("bucket"))
    hour = F.date_format("bucket", "yyyy-MM-dd HH:mm:ss")
    docs = rows.groupBy("day").agg(
        F.map_from_entries(F.collect_list(F.struct(hour, "avg_value"))).alias("watts"),
        F.map_from_entries(F.collect_list(F.struct(hour, F.col("total_samples").cast("double")))).alias("watt_hours_period"),
        F.sum("avg_value").alias("_sum"),
    )
    return docs.withColumn("watt_hours_day", F.create_map(F.date_format("day", "yyyy-MM-dd"), F.col("_sum"))).drop("_sum")


def d12_pv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(fc.map_rows(_pv_documents(spark, sf_dir), "watts", "Europe/Berlin"))


def d12_pv_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fc.map_rows(_pv_documents(spark, sf_dir), "watts", "UTC").select(
        "forecast_for", F.lit("pv").alias("source"), F.lit("watts").alias("metric"), F.lit("doc").alias("model"), F.col("value").alias("forecast_value"),
        (F.col("value") - 1).alias("forecast_lower"), (F.col("value") + 1).alias("forecast_upper"), as_of().alias("created_at"),
    )
    old = rows.where(F.col("forecast_for") < F.lit("2024-01-20").cast("timestamp")).withColumn("forecast_value", F.lit(0.0))
    new = rows.where(F.col("forecast_for") >= F.lit("2024-01-10").cast("timestamp")).drop("forecast_lower", "forecast_upper")
    out = store.upsert(old, new, store.FORECAST_KEY, ["forecast_value", "created_at"])
    return plain(out.select("forecast_for", "forecast_value", "forecast_lower", "forecast_upper"))


def a19_a21_pv_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _pv_documents(spark, sf_dir)
    return plain(fc.pv_figures(docs, F.lit("2024-01-20 12:30:00").cast("timestamp"), "UTC", keep=["day"]))


def _weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hourly(spark, sf_dir).where("event_type = 'click'").withColumn("day", F.to_date("bucket"))
    cell = F.sort_array(F.collect_list(F.struct("bucket", "avg_value", F.when(F.col("on_samples") > 0, F.col("on_samples").cast("double")).alias("on"))))
    docs = rows.groupBy("day").agg(cell.alias("c"))
    return docs.select("day", F.col("c.bucket").alias("time"), F.col("c.avg_value").alias("level"), F.col("c.on").alias("busy"))


def d13_weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(fc.array_rows(_weather_documents(spark, sf_dir), "time", {"level": "mean_level", "busy": "busy_samples"}))


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of all events but the last closed bucket, by a regular grid."""
    rows = events(spark, sf_dir).where(F.col("ts") < F.lit(BUCKET_END).cast("timestamp"))
    counts = rows.groupBy(F.date_trunc("hour", "ts").alias("bucket")).agg(F.count("*").cast("double").alias("y"))
    return s.hourly_grid(counts.withColumn("uc", F.lit("activity")), ["uc"])


def m6_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(seasonal.decompose(_series(spark, sf_dir), ["uc"]).select("bucket", "y", "trend", "daily", "weekly", "residual"))


def d7_seasonal_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(seasonal.forecast(_series(spark, sf_dir), ["uc"]).drop("uc"))


def d7_seasonal_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).where(F.col("ts") >= F.lit(BUCKET_END).cast("timestamp"))
    actual = rows.groupBy(F.date_trunc("hour", "ts").alias("bucket")).agg(F.count("*").cast("double").alias("y")).withColumn("uc", F.lit("activity"))
    out = seasonal.anomalies(actual, seasonal.forecast(_series(spark, sf_dir), ["uc"]), ["uc"])
    return plain(out.select("bucket", "y", "forecast_value", "score", "severity"))


KINDS = ["click", "error", "purchase", "signup", "view"]


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = hourly(spark, sf_dir).groupBy("bucket").pivot("event_type", KINDS).agg(F.first("avg_value"))
    return forest.training_matrix(wide, KINDS, [], as_of(), "activity_iforest", hour_of_day=True)


def m1_training_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_matrix(spark, sf_dir).select("bucket", *(F.col("x")[k].alias(f"x{k}") for k in range(6))))


def m2_standard_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _matrix(spark, sf_dir)
    return plain(forest.scaled(rows, forest.scales(rows, 1)).select("bucket", *(F.col("z")[k].alias(f"z{k}") for k in range(6))))


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = store.work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _trained(spark: SparkSession, sf_dir: str, *times: str) -> tuple[DataFrame, DataFrame]:
    """Scores of all rows and the stored thresholds, after a training at each of ``times``: models are saved, loaded and scored with."""
    rows = _kept(_matrix(spark, sf_dir), "matrix")
    z = _kept(forest.scaled(rows, forest.scales(rows)), "scaled")
    scores = limits = None
    for at in times:
        path = store.work_folder(spark, "models")
        trees = _kept(forest.fit(z), "trees")
        scores = _kept(forest.score(z, trees), "scores")
        forest.save_models(trees, forest.thresholds(scores, F.lit(at).cast("timestamp"), limits), path)
        trees, limits = forest.load_models(spark, path)
    return forest.score(z, trees), limits


def d6_iforest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(forest.classify(*_trained(spark, sf_dir, "2024-01-01"), as_of()).select("model", "bucket", "score", "severity"))


def d6_iforest_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_trained(spark, sf_dir, AS_OF_TEXT)[1])


def k6_model_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored of a model that was trained twice: its rows, the last training and the first."""
    limits = _trained(spark, sf_dir, "2024-01-24", AS_OF_TEXT)[1]
    return plain(limits.select("model", "n_train", "trained_at", "first_trained_at"))


def a14_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).groupBy("event_type")
    return plain(rows.agg(F.percentile("value", F.lit(0.005)).alias("warning"), F.percentile("value", F.lit(0.001)).alias("critical")))


def a15_residual_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = seasonal.decompose(_series(spark, sf_dir), ["uc"])
    return plain(parts.groupBy("uc").agg(F.stddev_samp(F.when(~F.isnan("residual"), F.col("residual"))).alias("sigma"), F.count("*").alias("n"), F.min("bucket").alias("first_bucket")))


def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = seasonal.forecast(_series(spark, sf_dir), ["uc"])
    return out.select("forecast_for", F.lit("events_1h").alias("source"), F.lit("activity").alias("metric"), F.lit("seasonal").alias("model"), "forecast_value", "forecast_lower", "forecast_upper", as_of().alias("created_at"))


def k3_forecast_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = _forecasts(spark, sf_dir)
    old = new.withColumns({"forecast_for": F.col("forecast_for") - F.expr("INTERVAL 12 HOURS"), "forecast_value": F.lit(0.0), "forecast_lower": F.lit(-1.0), "forecast_upper": F.lit(1.0)})
    return plain(store.upsert(old, new, store.FORECAST_KEY).select("forecast_for", "forecast_value", "forecast_lower", "forecast_upper"))


def u3_forecast_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    pv = fc.map_rows(_pv_documents(spark, sf_dir), "watts", "UTC").select("forecast_for", F.lit("pv").alias("model"), F.col("value").alias("forecast_value"))
    both = _forecasts(spark, sf_dir).unionByName(pv, allowMissingColumns=True)
    return plain(both.groupBy("model").agg(F.count("*").alias("n"), F.count("forecast_lower").alias("with_bounds"), F.sum("forecast_value").alias("total")))


def s7_forecast_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored forecasts, read back by source, metric, model and time."""
    path = store.work_folder(spark, "forecasts")
    store.save(_forecasts(spark, sf_dir), path, "forecast_for")
    low, high = (F.lit(f"2024-01-31 {h}:00:00").cast("timestamp") for h in ("02", "07"))
    rows = store.forecasts_of(store.load(spark, path), "events_1h", "activity", "seasonal", low, high)
    return plain(rows.select("forecast_for", "forecast_value", "forecast_lower", "forecast_upper"))


def d13_weather_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather documents as JSON text, to rows under their stored metric names, to an upsert."""
    docs = _weather_documents(spark, sf_dir)
    text = docs.select(F.to_json(F.struct(F.struct(F.transform("time", lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm")).alias("time"), *(F.col("level").alias(f) for f in readings.WEATHER_METRICS)).alias("hourly"))).alias("j"))
    docs = text.select(F.from_json("j", readings.WEATHER_SCHEMA).alias("d")).select("d.hourly.*")
    rows = fc.array_rows(docs, "time", readings.WEATHER_METRICS).withColumn("forecast_for", x.to_utc(F.col("forecast_for"), "UTC"))
    rows = rows.select("forecast_for", F.lit("weather").alias("source"), "metric", F.lit("weather").alias("model"), F.col("value").alias("forecast_value"))
    old = rows.where(F.col("forecast_for") < F.lit("2024-01-20").cast("timestamp")).withColumn("forecast_value", F.lit(-1.0))
    new = rows.where(F.col("forecast_for") >= F.lit("2024-01-10").cast("timestamp"))
    return plain(store.upsert(old, new, store.FORECAST_KEY).select("forecast_for", "metric", "forecast_value"))


def h11_warm_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severities by value, models trained at the hour of the reading."""
    rows = events(spark, sf_dir)
    grade = x.tier(F.col("value"), 38.0, 45.0, 55.0)
    return rows.select("event_id", x.warm_up(grade, F.date_trunc("hour", "ts"), as_of(), 14).alias("severity"))


def r1_streamed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly rollup of the events as a stream: buckets that the watermark has closed."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    place = store.work_folder(spark, "stream")
    stream = streaming.hourly(streaming.source(spark, sf_dir, "events.parquet", schema), ["event_type"])
    return plain(streaming.drain(stream, f"{place}/out", f"{place}/state"))


QUERIES = [
    s7_forecast_scan, d13_weather_upsert, k3_forecast_upsert, u3_forecast_families, h11_warm_up, r1_streamed_rollup, d11_energy_balance, d8_pv_underperformance, d12_pv_rows, d12_pv_upsert, a19_a21_pv_figures, d13_weather_rows, m6_decomposition, d7_seasonal_forecast,
    d7_seasonal_anomaly, m1_training_matrix, m2_standard_scaling, d6_iforest_score, d6_iforest_thresholds, k6_model_register, a14_quantiles, a15_residual_spread,
]

_PIVOT = (
    HOURLY
    + """, wide AS (
  SELECT bucket, max(avg_value) FILTER (event_type = 'click') AS x0, max(avg_value) FILTER (event_type = 'error') AS x1, max(avg_value) FILTER (event_type = 'purchase') AS x2,
    max(avg_value) FILTER (event_type = 'signup') AS x3, max(avg_value) FILTER (event_type = 'view') AS x4, hour(bucket)::DOUBLE AS x5
  FROM hourly WHERE bucket <= TIMESTAMP '2024-01-30 23:00:00' GROUP BY bucket),
m AS (SELECT * FROM wide WHERE x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL AND x3 IS NOT NULL AND x4 IS NOT NULL)"""
)

_DECOMPOSED = """counts AS (SELECT date_trunc('hour', ts) AS bucket, count(*)::DOUBLE AS y FROM events WHERE ts < TIMESTAMP '2024-01-30 23:00:00' GROUP BY 1),
grid AS (SELECT unnest(generate_series((SELECT min(bucket) FROM counts), (SELECT max(bucket) FROM counts), INTERVAL 1 HOUR)) AS bucket),
ser AS (SELECT bucket, coalesce(y, 0) AS y, epoch(bucket)::BIGINT // 3600 AS h FROM grid LEFT JOIN counts USING (bucket)),
tr AS (SELECT *, avg(y) OVER (ORDER BY h ROWS BETWEEN 84 PRECEDING AND 84 FOLLOWING) AS trend FROM ser),
dy AS (SELECT *, avg(y - trend) OVER (PARTITION BY h % 24) - avg(y - trend) OVER () AS daily FROM tr),
wk AS (SELECT *, avg(y - trend - daily) OVER (PARTITION BY h % 168) - avg(y - trend - daily) OVER () AS weekly FROM dy),
parts AS (SELECT *, y - trend - daily - weekly AS residual FROM wk)"""

_FORECAST = (
    _DECOMPOSED
    + """, e AS (SELECT max(h) AS last_h, count(*) AS n, stddev_samp(residual) AS sigma FROM parts),
line AS (SELECT regr_slope(trend, (h - last_h)::DOUBLE) AS slope, regr_intercept(trend, (h - last_h)::DOUBLE) AS level FROM parts, e WHERE h > last_h - 168),
season AS (SELECT h % 168 AS w, any_value(daily + weekly) AS s FROM parts GROUP BY 1),
fc AS (SELECT last_h + k AS h, level + slope * k + s AS v, sigma FROM e, line, range(1, 25) r(k) JOIN season ON season.w = ((SELECT last_h FROM e) + k) % 168 WHERE n >= 336 AND sigma > 0)"""
)

SQL = {
    "k3_forecast_upsert": f"""WITH {_FORECAST}, n AS (SELECT make_timestamp(h * 3600000000) AS t, v, v - 3 * sigma AS lo, v + 3 * sigma AS hi FROM fc), o AS (SELECT t - INTERVAL 12 HOUR AS t FROM n)
SELECT coalesce(n.t, o.t) AS forecast_for, round(coalesce(v, 0), 7) AS forecast_value, round(coalesce(lo, -1), 7) AS forecast_lower, round(coalesce(hi, 1), 7) AS forecast_upper FROM n FULL JOIN o ON n.t = o.t""",
    "u3_forecast_families": f"""WITH {_FORECAST}, h AS (SELECT date_trunc('hour', ts) AS bucket, avg(value) AS v FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT 'seasonal' AS model, count(*) AS n, count(*) AS with_bounds, round(sum(v), 7) AS total FROM fc HAVING count(*) > 0 UNION ALL SELECT 'pv', count(*), 0, round(sum(v), 7) FROM h""",
    "s7_forecast_scan": f"""WITH {_FORECAST}, n AS (SELECT make_timestamp(h * 3600000000) AS forecast_for, v, sigma FROM fc)
SELECT forecast_for, round(v, 7) AS forecast_value, round(v - 3 * sigma, 7) AS forecast_lower, round(v + 3 * sigma, 7) AS forecast_upper FROM n
WHERE forecast_for BETWEEN TIMESTAMP '2024-01-31 02:00:00' AND TIMESTAMP '2024-01-31 07:00:00'""",
    "d13_weather_upsert": f"""WITH {HOURLY} SELECT bucket AS forecast_for, metric, round(CASE WHEN bucket >= TIMESTAMP '2024-01-10' THEN avg_value ELSE -1 END, 7) AS forecast_value
FROM hourly, (VALUES ('temperature'), ('cloud_cover'), ('precipitation'), ('solar_radiation'), ('wind_speed')) m(metric) WHERE event_type = 'click'""",
    "h11_warm_up": """SELECT event_id, CASE WHEN value >= 38 AND TIMESTAMP '2024-01-31' < date_trunc('hour', ts) + INTERVAL 14 DAY THEN 'info'
  WHEN value >= 55 THEN 'critical' WHEN value >= 45 THEN 'warning' WHEN value >= 38 THEN 'info' END AS severity FROM events""",
    "r1_streamed_rollup": f"""WITH {HOURLY} SELECT bucket, event_type, round(avg_value, 7) AS avg_value, round(min_value, 7) AS min_value, total_samples
FROM hourly WHERE bucket + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "d11_energy_balance": """WITH d AS (SELECT user_id, event_type, date_trunc('day', ts) AS day, ts, value FROM events),
made AS (SELECT day, sum(greatest(x, 0)) / 1000 AS g FROM (SELECT user_id, day, arg_max(value, ts) - arg_min(value, ts) AS x FROM d WHERE event_type = 'view' GROUP BY 1, 2) GROUP BY 1),
grid AS (SELECT day, max(x) FILTER (event_type = 'click') AS i, max(x) FILTER (event_type = 'purchase') AS e FROM (
  SELECT event_type, day, arg_max(value, ts) - arg_min(value, ts) AS x FROM d WHERE event_type IN ('click', 'purchase') GROUP BY 1, 2) GROUP BY 1),
b AS (SELECT coalesce(made.day, grid.day) AS day, coalesce(g, 0) AS g, coalesce(i, 0) AS i, coalesce(e, 0) AS e FROM made FULL JOIN grid ON made.day = grid.day),
c AS (SELECT *, g + i - e AS c, greatest(g - e, 0) AS u FROM b)
SELECT day, round(g, 7) AS generation_kwh, round(i, 7) AS import_kwh, round(e, 7) AS export_kwh, round(greatest(c, 0), 3) AS consumption_kwh, round(u, 3) AS direct_use_kwh,
  round(CASE WHEN g > 0 THEN greatest(least(100 * u / g, 100), 0) ELSE 0 END, 1) AS self_consumption_pct,
  round(CASE WHEN c > 0 THEN greatest(least(100 * u / c, 100), 0) ELSE 0 END, 1) AS self_sufficiency_pct FROM c""",
    "d8_pv_underperformance": """WITH a AS (SELECT day, sum(greatest(x, 0)) / 100 AS actual_kwh FROM (
  SELECT user_id, date_trunc('day', ts) AS day, arg_max(value, ts) - arg_min(value, ts) AS x FROM events WHERE event_type = 'view' GROUP BY 1, 2) GROUP BY 1),
t AS (SELECT date_trunc('day', ts) AS day, (value + lag(value) OVER o) / 2 * (epoch_us(ts) - epoch_us(lag(ts) OVER o)) / 1e6 / 3600 AS area
  FROM events WHERE event_type = 'purchase' WINDOW o AS (PARTITION BY date_trunc('day', ts) ORDER BY ts, event_id)),
x AS (SELECT day, coalesce(sum(area), 0) / 100 AS expected_kwh FROM t GROUP BY 1),
r AS (SELECT *, CASE WHEN expected_kwh >= 3 THEN actual_kwh / expected_kwh END AS ratio FROM a JOIN x USING (day))
SELECT day, round(actual_kwh, 7) AS actual_kwh, round(expected_kwh, 7) AS expected_kwh, round(ratio, 3) AS ratio,
  CASE WHEN ratio < 0.35 THEN 'critical' WHEN ratio < 0.5 THEN 'warning' WHEN ratio < 0.65 THEN 'info' END AS severity FROM r""",
    "d12_pv_rows": f"WITH {HOURLY} SELECT bucket AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' AS forecast_for, round(avg_value, 7) AS value FROM hourly WHERE event_type = 'view'",
    "d12_pv_upsert": f"""WITH {HOURLY} SELECT bucket AS forecast_for, round(CASE WHEN bucket >= TIMESTAMP '2024-01-10' THEN avg_value ELSE 0 END, 7) AS forecast_value,
  round(CASE WHEN bucket < TIMESTAMP '2024-01-20' THEN avg_value - 1 END, 7) AS forecast_lower, round(CASE WHEN bucket < TIMESTAMP '2024-01-20' THEN avg_value + 1 END, 7) AS forecast_upper
FROM hourly WHERE event_type = 'view'""",
    "a19_a21_pv_figures": f"""WITH {HOURLY}, v AS (SELECT *, date_trunc('day', bucket) AS day FROM hourly WHERE event_type = 'view')
SELECT day, round(CASE WHEN day = TIMESTAMP '2024-01-20' THEN sum(avg_value) / 1000 END, 3) AS energy_today_kwh,
  round(CASE WHEN day = TIMESTAMP '2024-01-21' THEN sum(avg_value) / 1000 END, 3) AS energy_tomorrow_kwh,
  round(coalesce(sum(total_samples) FILTER (day = TIMESTAMP '2024-01-20' AND bucket > TIMESTAMP '2024-01-20 12:30:00'), 0) / 1000, 3) AS remaining_today_kwh,
  round(coalesce(max(avg_value) FILTER (bucket = TIMESTAMP '2024-01-20 12:00:00'), 0), 7) AS power_now_w FROM v GROUP BY day""",
    "d13_weather_rows": f"""WITH {HOURLY} SELECT bucket AS forecast_for, 'mean_level' AS metric, round(avg_value, 7) AS value FROM hourly WHERE event_type = 'click'
UNION ALL SELECT bucket, 'busy_samples', on_samples FROM hourly WHERE event_type = 'click' AND on_samples > 0""",
    "m6_decomposition": f"WITH {_DECOMPOSED} SELECT bucket, y, round(trend, 7) AS trend, round(daily, 7) AS daily, round(weekly, 7) AS weekly, round(residual, 7) AS residual FROM parts",
    "d7_seasonal_forecast": f"""WITH {_FORECAST} SELECT make_timestamp(h * 3600000000) AS forecast_for, round(v, 7) AS forecast_value, round(v - 3 * sigma, 7) AS forecast_lower,
  round(v + 3 * sigma, 7) AS forecast_upper, round(sigma, 7) AS sigma FROM fc""",
    "d7_seasonal_anomaly": f"""WITH {_FORECAST}, a AS (SELECT date_trunc('hour', ts) AS bucket, count(*)::DOUBLE AS y FROM events WHERE ts >= TIMESTAMP '2024-01-30 23:00:00' GROUP BY 1),
s AS (SELECT bucket, y, v, abs(y - v) / sigma AS score FROM a JOIN fc ON bucket = make_timestamp(h * 3600000000))
SELECT bucket, y, round(v, 7) AS forecast_value, round(score, 7) AS score, CASE WHEN score >= 2.5 THEN 'critical' WHEN score >= 1.5 THEN 'warning' WHEN score >= 1 THEN 'info' END AS severity FROM s""",
    "m1_training_matrix": f"WITH {_PIVOT} SELECT bucket, {', '.join(f'round(x{k}, 7) AS x{k}' for k in range(6))} FROM m",
    "m2_standard_scaling": f"WITH {_PIVOT} SELECT bucket, {', '.join(f'round((x{k} - avg(x{k}) OVER ()) / coalesce(nullif(stddev_pop(x{k}) OVER (), 0), 1), 7) AS z{k}' for k in range(6))} FROM m",
    "k6_model_register": f"""WITH {_PIVOT} SELECT 'activity_iforest' AS model, count(*) AS n_train, TIMESTAMP '2024-01-31' AS trained_at, TIMESTAMP '2024-01-24' AS first_trained_at
FROM m HAVING count(*) >= 200""",
    "a14_quantiles": "SELECT event_type, round(quantile_cont(value, 0.005), 7) AS warning, round(quantile_cont(value, 0.001), 7) AS critical FROM events GROUP BY 1",
    "a15_residual_spread": f"WITH {_DECOMPOSED} SELECT 'activity' AS uc, round(stddev_samp(residual), 7) AS sigma, count(*) AS n, min(bucket) AS first_bucket FROM parts",
}
