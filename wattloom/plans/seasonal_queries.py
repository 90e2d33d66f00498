"""The per-series seasonal model over the driver tables, and all of it in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mstl, seasonal
from ..operators import series as s
from .base import events, plain

BUCKET_END = "2024-01-30 23:00:00"
KEYS = ["event_type"]


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of each event type up to the last closed bucket; hours without an event count 0."""
    rows = events(spark, sf_dir).where(F.col("ts") < F.lit(BUCKET_END).cast("timestamp"))
    counts = rows.groupBy("event_type", F.date_trunc("hour", "ts").alias("bucket")).agg(F.count("*").cast("double").alias("y"))
    return s.hourly_grid(counts, KEYS)


def m6_mstl_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend, daily and weekly season and remainder of the hourly counts of every event type."""
    return plain(mstl.parts(_series(spark, sf_dir), KEYS))


def d7_mstl_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(mstl.forecast(_series(spark, sf_dir), KEYS))


def d7_mstl_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last closed bucket of every event type against its forecast."""
    rows = events(spark, sf_dir).where(F.col("ts") >= F.lit(BUCKET_END).cast("timestamp"))
    actual = rows.groupBy("event_type", F.date_trunc("hour", "ts").alias("bucket")).agg(F.count("*").cast("double").alias("y"))
    out = seasonal.anomalies(actual, mstl.forecast(_series(spark, sf_dir), KEYS), KEYS)
    return plain(out.select("event_type", "bucket", "y", "forecast_value", "score", "severity"))


QUERIES = [m6_mstl_parts, d7_mstl_forecast, d7_mstl_anomaly]


def _fitted(source: str, span: int, degree: int, group: str = "g") -> str:
    """Local regression of ``source(g, i, y, n)`` at its own places; ``targets`` of a source with places beyond have their own ``at``."""
    value = "sy / sw" if degree == 0 else "CASE WHEN sw * sxx - sx * sx > 1e-9 THEN (sxx * sy - sx * sxy) / (sw * sxx - sx * sx) ELSE sy / sw END"
    return f"""(SELECT {group}, i, n, {value} AS y FROM (
  SELECT {group}, i, any_value(n) AS n, sum(w) AS sw, sum(w * x) AS sx, sum(w * x * x) AS sxx, sum(w * y) AS sy, sum(w * x * y) AS sxy FROM (
    SELECT {group}, i, n, x, y, pow(1 - pow(abs(x) / reach, 3), 3) AS w FROM (
      SELECT {", ".join(f"t.{c}" for c in group.split(", "))}, t.i, t.n, (v.i - t.i)::DOUBLE AS x, v.y, greatest(abs(low - t.i), abs(low + seen - 1 - t.i)) + 1 + greatest(0, ({span} - t.m) // 2) AS reach
      FROM (SELECT *, greatest(least(i - {span // 2}, m - seen), 0) AS low FROM (SELECT *, least({span}, m) AS seen FROM {source}_at)) t
      JOIN {source} v ON {" AND ".join(f"v.{c} = t.{c}" for c in group.split(", "))} AND v.i BETWEEN t.low AND t.low + t.seen - 1)) GROUP BY {group}, i))"""


def _steps() -> list[tuple[str, str]]:
    """The decomposition as a chain of named tables ``(g, i, y, n)``: n values of series g."""
    steps: list[tuple[str, str]] = []

    def add(name: str, sql: str) -> str:
        steps.append((name, sql))
        return name

    def at(name: str) -> None:
        add(f"{name}_at", f"(SELECT *, n AS m FROM {name})")

    rest, seasons, trend, mark = "ser", {}, "", 0
    for _ in range(mstl.ROUNDS):
        for k, p in enumerate(mstl.PERIODS):
            mark += 1
            span = mstl.season_span(k)
            if p in seasons:
                rest = add(f"back{mark}", f"(SELECT r.g, r.i, r.n, r.y + s.y AS y FROM {rest} r JOIN {seasons[p]} s USING (g, i))")
            trend = ""
            for inner in range(mstl.INNER):
                u = f"{mark}_{inner}"
                flat = add(f"flat{u}", f"(SELECT r.g, r.i, r.n, r.y - t.y AS y FROM {rest} r JOIN {trend} t USING (g, i))") if trend else rest
                sub = add(f"sub{u}", f"(SELECT g, i % {p} AS ph, i // {p} AS i, n, y, count(*) OVER (PARTITION BY g, i % {p}) AS m FROM {flat})")
                add(f"{sub}_at", f"(SELECT *, unnest(range(-1, m + 1)) AS i FROM (SELECT DISTINCT g, ph, n, m FROM {sub}))")
                cycle = add(f"cycle{u}", f"(SELECT g, ph + {p} * (i + 1) AS i, n, y FROM {_fitted(sub, span, 0, 'g, ph')})")
                for j, q in enumerate((p, p, 3)):
                    over = f"(PARTITION BY g ORDER BY i ROWS BETWEEN CURRENT ROW AND {q - 1} FOLLOWING)"
                    add(f"avg{u}_{j}", f"(SELECT g, i, n, y FROM (SELECT g, i, n, avg(y) OVER {over} AS y, count(*) OVER {over} AS c FROM {cycle if j == 0 else f'avg{u}_{j - 1}'}) WHERE c = {q})")
                at(f"avg{u}_2")
                slow = add(f"slow{u}", _fitted(f"avg{u}_2", mstl.odd(p), 1))
                season = add(f"season{u}", f"(SELECT s.g, s.i, s.n, c.y - s.y AS y FROM {slow} s JOIN {cycle} c ON c.g = s.g AND c.i = s.i + {p})")
                des = add(f"des{u}", f"(SELECT r.g, r.i, r.n, r.y - s.y AS y FROM {rest} r JOIN {season} s USING (g, i))")
                at(des)
                trend = add(f"trend{u}", _fitted(des, mstl.trend_span(p, span), 1))
            seasons[p], rest = season, des
    add("parts", f"(SELECT o.g, o.i, o.n, o.y, t.y AS trend, d.y AS daily, w.y AS weekly, z.y AS z FROM ser o JOIN {trend} t USING (g, i) JOIN {seasons[24]} d USING (g, i) JOIN {seasons[168]} w USING (g, i) JOIN {rest} z USING (g, i))")
    return steps


_PARTS = f"""counts AS (SELECT event_type AS g, date_trunc('hour', ts) AS bucket, count(*)::DOUBLE AS y FROM events WHERE ts < TIMESTAMP '{BUCKET_END}' GROUP BY ALL),
ends AS (SELECT g, min(bucket) AS a, max(bucket) AS b FROM counts GROUP BY g),
grid AS (SELECT g, a, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS bucket FROM ends),
ser AS MATERIALIZED (SELECT g, (epoch(bucket) - epoch(a))::BIGINT // 3600 AS i, coalesce(y, 0) AS y, count(*) OVER (PARTITION BY g) AS n FROM grid LEFT JOIN counts USING (g, bucket) QUALIFY n >= 336),
""" + ",\n".join(f"{name} AS MATERIALIZED {sql}" for name, sql in _steps())

_MODEL = (
    _PARTS
    + f""",
e AS (SELECT g, i, n, z - avg(z) OVER (PARTITION BY g) AS e FROM parts),
lagged AS (SELECT a.g, a.i - b.i AS k, any_value(a.n) AS n, sum(a.e * b.e) AS c FROM e a JOIN e b ON a.g = b.g AND a.i - b.i BETWEEN 0 AND (3 * sqrt(a.n) / 13)::INT + 1 GROUP BY ALL),
spread AS (SELECT g, any_value(n) AS n, sum(CASE WHEN k = 0 THEN c WHEN k <= floor(3 * sqrt(n) / 13) THEN 2 * (1 - k / (floor(3 * sqrt(n) / 13) + 1)) * c ELSE 0 END) AS s FROM lagged GROUP BY g),
sums AS (SELECT g, sum(x * x) AS q FROM (SELECT g, sum(e) OVER (PARTITION BY g ORDER BY i) AS x FROM e) GROUP BY g),
steady AS (SELECT g, CASE WHEN s > 0 AND q / (n * s) > {mstl.UNSTEADY} THEN 1 ELSE 0 END AS d FROM spread JOIN sums USING (g)),
w AS MATERIALIZED (SELECT g, d, row_number() OVER (PARTITION BY g ORDER BY i) AS t, CASE WHEN d = 1 THEN z - z0 ELSE z - m END AS w, CASE WHEN d = 1 THEN 0 ELSE m END AS m, count(*) OVER (PARTITION BY g) AS c, z
  FROM (SELECT *, lag(z) OVER (PARTITION BY g ORDER BY i) AS z0, avg(z) OVER (PARTITION BY g) AS m FROM parts JOIN steady USING (g)) WHERE d = 0 OR z0 IS NOT NULL),
r AS (SELECT g, any_value(c) AS c, list(v ORDER BY k) AS r FROM (SELECT a.g, a.t - b.t AS k, any_value(a.c) AS c, sum(a.w * b.w) / any_value(a.c) AS v FROM w a JOIN w b ON a.g = b.g AND a.t - b.t BETWEEN 0 AND {mstl.MOST_LAGS} GROUP BY ALL) GROUP BY g),
levinson AS (
  SELECT g, c, r, 0 AS p, []::DOUBLE[] AS phi, r[1] AS v FROM r
  UNION ALL
  SELECT g, c, r, p + 1, list_append(list_transform(range(1, p + 1), lambda j: phi[j] - k * phi[p + 1 - j]), k), v * (1 - k * k)
  FROM (SELECT *, (r[p + 2] - coalesce(list_sum(list_transform(range(1, p + 1), lambda j: phi[j] * r[p + 2 - j])), 0)) / v AS k FROM levinson WHERE p < {mstl.MOST_LAGS} AND v > 0)),
orders AS (SELECT g, p, phi FROM levinson WHERE v > 0 QUALIFY row_number() OVER (PARTITION BY g ORDER BY round(c * ln(v) + 2 * (p + 1) + 2.0::DOUBLE * (p + 1) * (p + 2) / (c - p - 2), 9), p) = 1),
past AS (SELECT g, any_value(d) AS d, any_value(m) AS m, any_value(c) AS c, max_by(z, t) AS last_z, any_value(p) AS p, any_value(phi) AS phi, list(w ORDER BY t) AS ws FROM w JOIN orders USING (g) GROUP BY g),
errors AS (SELECT g, stddev_samp(x) AS sigma FROM (SELECT g, unnest(list_transform(range(p + 1, c + 1), lambda t: ws[t] - coalesce(list_sum(list_transform(range(1, p + 1), lambda j: phi[j] * ws[t - j])), 0))) AS x FROM past) GROUP BY g),
ahead AS (
  SELECT g, phi, p, 0 AS h, ws[greatest(len(ws) - 9, 1):] AS ws, 0::DOUBLE AS v, [1.0::DOUBLE] AS psi FROM past
  UNION ALL
  SELECT g, phi, p, h + 1, list_append(ws, x), x, list_append(psi, coalesce(list_sum(list_transform(range(1, least(p, len(psi)) + 1), lambda j: phi[j] * psi[len(psi) + 1 - j])), 0))
  FROM (SELECT *, coalesce(list_sum(list_transform(range(1, p + 1), lambda j: phi[j] * ws[len(ws) + 1 - j])), 0) AS x FROM ahead WHERE h < 24)),
moved AS (SELECT g, h, sum(v) OVER (PARTITION BY g ORDER BY h) AS total, v, list_transform(range(1, h + 1), lambda j: CASE WHEN d = 1 THEN list_sum(psi[1:j]) ELSE psi[j] END) AS reply FROM ahead JOIN past USING (g)),
fc AS (
  SELECT g, b + h * INTERVAL 1 HOUR AS forecast_for, CASE WHEN d = 1 THEN last_z + total ELSE m + v END + dd.daily + ww.weekly AS v, sigma, sigma * sqrt(list_sum(list_transform(reply, lambda x: x * x))) AS step_error, past.p AS lags, d AS differences
  FROM moved JOIN past USING (g) JOIN errors USING (g) JOIN ends USING (g) JOIN (SELECT g, max(i) AS last_i FROM parts GROUP BY g) USING (g)
  JOIN parts dd ON dd.g = moved.g AND dd.i = last_i - 24 + 1 + (h - 1) % 24 JOIN parts ww ON ww.g = moved.g AND ww.i = last_i - 168 + 1 + (h - 1) % 168 WHERE h > 0 AND sigma > 1e-9)"""
)

SQL = {
    "m6_mstl_parts": f"""WITH {_PARTS} SELECT g AS event_type, a + i * INTERVAL 1 HOUR AS bucket, y, round(trend, 7) AS trend, round(daily, 7) AS season_24, round(weekly, 7) AS season_168,
  round(y - trend - daily - weekly, 7) AS remainder FROM parts JOIN ends USING (g)""",
    "d7_mstl_forecast": f"""WITH RECURSIVE {_MODEL} SELECT g AS event_type, forecast_for, round(v, 7) AS forecast_value, round(v - 3 * sigma, 7) AS forecast_lower, round(v + 3 * sigma, 7) AS forecast_upper,
  round(sigma, 7) AS sigma, round(step_error, 7) AS step_error, lags::INT AS lags, differences::INT AS differences FROM fc""",
    "d7_mstl_anomaly": f"""WITH RECURSIVE {_MODEL}, a AS (SELECT event_type AS g, date_trunc('hour', ts) AS forecast_for, count(*)::DOUBLE AS y FROM events WHERE ts >= TIMESTAMP '{BUCKET_END}' GROUP BY ALL),
s AS (SELECT g, forecast_for, y, v, abs(y - v) / sigma AS score FROM a JOIN fc USING (g, forecast_for))
SELECT g AS event_type, forecast_for AS bucket, y, round(v, 7) AS forecast_value, round(score, 7) AS score,
  CASE WHEN score >= 2.5 THEN 'critical' WHEN score >= 1.5 THEN 'warning' WHEN score >= 1 THEN 'info' END AS severity FROM s""",
}
