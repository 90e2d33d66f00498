"""A week of anomalies in counts, a top list and a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import SEVERITIES, severity_rank

TOP = 10


def _weeks(anomalies: DataFrame, until: Column, exclude_clears: bool) -> DataFrame:
    week = F.expr("INTERVAL 7 DAYS")
    rows = anomalies.where((F.col("time") >= until - week - week) & (F.col("time") < until))
    if exclude_clears:
        rows = rows.where(F.coalesce(F.get_json_object("payload", "$.firing"), F.lit("true")) != "false")
    return rows.withColumn("this_week", F.col("time") >= until - week)


def by_severity(anomalies: DataFrame, until: Column, exclude_clears: bool = False) -> DataFrame:
    """``severity, n_now, n_prev`` for all three severities, 0 where there is none."""
    rows = _weeks(anomalies, until, exclude_clears).groupBy("severity").agg(
        F.count_if("this_week").alias("n_now"), F.count_if(~F.col("this_week")).alias("n_prev")
    )
    all_three = anomalies.sparkSession.createDataFrame([(s,) for s in SEVERITIES], "severity string")
    return all_three.join(rows, "severity", "left").na.fill(0, ["n_now", "n_prev"])


def by_use_case(anomalies: DataFrame, until: Column, exclude_clears: bool = False) -> DataFrame:
    return _weeks(anomalies, until, exclude_clears).where("this_week").groupBy("uc").agg(F.count("*").alias("n"))


def top(anomalies: DataFrame, until: Column, n: int = TOP, exclude_clears: bool = False) -> DataFrame:
    """The worst of the week: severity, then distance of the score, ties by key."""
    rows = _weeks(anomalies, until, exclude_clears).where("this_week").drop("this_week")
    return rows.orderBy(severity_rank(F.col("severity")).desc(), F.abs("score").desc_nulls_last(), "time", "source", "metric", "detector").limit(n)


def totals(counts: DataFrame, *keep: str) -> DataFrame:
    """``total_now, total_prev, delta, arrow`` from ``by_severity``; rows that are summed already may keep columns."""
    if keep:
        rows = counts.select(F.col("n_now").alias("total_now"), F.col("n_prev").alias("total_prev"), *keep)
    else:
        rows = counts.agg(F.sum("n_now").alias("total_now"), F.sum("n_prev").alias("total_prev"))
    delta = F.col("total_now") - F.col("total_prev")
    return rows.withColumn("delta", delta).withColumn("arrow", F.when(delta > 0, "↑").when(delta < 0, "↓").otherwise("→"))


def text(anomalies: DataFrame, until: Column, n: int = TOP, exclude_clears: bool = False) -> DataFrame:
    """One row ``text``: the digest in Markdown. All counts come from one aggregation by use case; only they and the top list meet."""
    now = F.col("this_week")
    by_uc = _weeks(anomalies, until, exclude_clears).groupBy("uc").agg(
        F.count_if(now).alias("n_now"), F.count_if(~now).alias("n_prev"), *(F.count_if(now & (F.col("severity") == s)).alias(s) for s in SEVERITIES)
    )
    named = F.when(F.col("n_now") > 0, F.struct((-F.col("n_now")).alias("k"), F.col("uc")))
    figures = by_uc.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_now", "n_prev", *SEVERITIES)), F.array_sort(F.collect_list(named)).alias("ucs"))
    figures = totals(figures, "ucs", *SEVERITIES)
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    since = until - F.expr("INTERVAL 7 DAYS")
    # Headings and table heads: fixed values.
    lines = F.concat(
        F.array(
            F.concat(F.lit("# Weekly Anomaly Digest — "), day(until)), F.lit(""),
            F.concat(F.lit("Window: "), day(since), F.lit(" → "), day(until), F.lit(" (7 days)")), F.lit(""),
            F.format_string("**Total this week: %d** (%s %d vs prior week, %d)", "total_now", "arrow", F.abs("delta"), "total_prev"),
        ),
        _lines("", "## By severity", "", "| severity | count |", "|---|---:|"),
        F.array(*(F.format_string("| %s | %d |", F.lit(s), s) for s in reversed(SEVERITIES))),
        _lines("", "## By use-case", "", "| uc | count |", "|---|---:|"),
        F.transform("ucs", lambda u: F.format_string("| %s | %d |", u["uc"], -u["k"])),
        _lines("", f"## Top {n} anomalies", "", "| time | severity | uc | metric | score | actual | expected |", "|---|---|---|---|---:|---:|---:|"),
    )
    shown = lambda c: F.when(F.col(c).isNull(), "").otherwise(F.format_string("%.2f", F.round(F.round(c, 7), 2)))
    cells = (F.date_format("time", "yyyy-MM-dd HH:mm"), "severity", "uc", "metric", shown("score"), shown("actual"), shown("expected"))
    order = Window.orderBy(severity_rank(F.col("severity")).desc(), F.abs("score").desc_nulls_last(), "time", "source", "metric", "detector")
    worst = top(anomalies, until, n, exclude_clears).withColumn("k", F.row_number().over(order))
    worst = worst.select("k", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    rows = figures.select(F.lit(0).alias("k"), F.concat_ws("\n", lines).alias("line")).unionByName(worst)
    joined = F.array_sort(F.collect_list(F.struct("k", "line")))
    return rows.agg(F.concat(F.concat_ws("\n", F.transform(joined, lambda x: x["line"])), F.lit("\n")).alias("text"))


def _lines(*lines: str) -> Column:
    return F.array(*map(F.lit, lines))
