"""Isolation forests per use case and group (Liu, Ting, Zhou 2008), as tables.

A tree is fitted in one task from a subsample of at most ``SUBSAMPLE`` rows, chosen
by hash rank, so the fit does not depend on partitions. Trees and thresholds are
plain tables. To score, rows meet the trees of their own group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..shipping import ship

TREES, SUBSAMPLE, SEED = 100, 256, 42
#: Quantiles of the training scores under which a row is a warning, or critical.
WARNING_AT, CRITICAL_AT = 0.005, 0.001

TREE_SCHEMA = "model string, tree int, node int, feature int, cut double, size int, depth int"


def training_matrix(rollup: DataFrame, features: list[str], keys: list[str], as_of: Column, uc: str, days: int = 60, hour_of_day: bool = False) -> DataFrame:
    """``model, bucket, x`` (array of features) of closed buckets in the look-back with every feature present."""
    rows = rollup.where((F.col("bucket") <= F.date_trunc("hour", as_of) - F.expr("INTERVAL 1 HOUR")) & (F.col("bucket") > as_of - F.make_interval(days=F.lit(days))))
    rows = rows.na.drop(subset=features)
    cols = [F.col(f).cast("double") for f in features] + ([F.hour("bucket").cast("double")] if hour_of_day else [])
    return rows.select(x.metric_label(uc, *map(F.col, keys)).alias("model"), "bucket", F.array(*cols).alias("x"))


def scales(matrix: DataFrame, least: int = 200) -> DataFrame:
    """``model, n, mean, spread`` (arrays) of models with enough rows; a constant feature has spread 1."""
    long = matrix.select("model", F.posexplode("x").alias("at", "v")).groupBy("model", "at")
    long = long.agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.count("*").alias("n")).where(F.col("n") >= least)
    cell = F.sort_array(F.collect_list(F.struct("at", "m", F.when(F.col("s") > 0, F.col("s")).otherwise(1.0).alias("s"))))
    out = long.groupBy("model").agg(F.first("n").alias("n"), cell.alias("c"))
    return out.select("model", "n", F.col("c.m").alias("mean"), F.col("c.s").alias("spread"))


def scaled(matrix: DataFrame, scale: DataFrame) -> DataFrame:
    rows = matrix.join(scale, "model")
    z = F.zip_with(F.zip_with("x", "mean", lambda a, b: a - b), "spread", lambda a, b: a / b)
    return rows.select("model", "bucket", z.alias("z"))


def fit(z: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> DataFrame:
    """The node table. ``feature`` -1 is a leaf; the children of node k are 2k+1 and 2k+2.

    Every tree draws its rows by hash rank; the rank is pre-filtered by a hash
    threshold a few times the wanted share, so a row is copied only for trees that may
    draw it, and no full group is sorted.
    """
    ship(z.sparkSession)
    count = z.groupBy("model").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), (subsample * 2.0 + 64) / F.col("n"))
    rows = z.join(count, "model").withColumn("share", share).withColumn("row", F.xxhash64("bucket", "z", F.lit(seed)))
    h = lambda t: F.xxhash64("row", t)
    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(h(t), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    rows = rows.withColumn("tree", F.explode(drawn)).withColumn("h", h(F.col("tree")))
    rank = F.row_number().over(Window.partitionBy("model", "tree").orderBy("h", "bucket"))
    rows = rows.withColumn("k", rank).where(F.col("k") <= subsample).select("model", "tree", "z")
    return rows.groupBy("model", "tree").applyInPandas(lambda pdf: _grow(pdf, seed), TREE_SCHEMA)


def _grow(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    data, tree = np.stack(pdf["z"].to_numpy()), int(pdf["tree"].iloc[0])
    rng = np.random.default_rng([seed, tree])
    data = data[np.lexsort(data.T)]
    limit, todo, out = max(1, int(np.ceil(np.log2(max(len(data), 2))))), [(0, 0, data)], []
    while todo:
        node, depth, rows = todo.pop()
        low, high = rows.min(0), rows.max(0)
        wide = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(wide):
            out.append((node, -1, 0.0, len(rows), depth))
            continue
        f = int(rng.choice(wide))
        cut = float(rng.uniform(low[f], high[f]))
        out.append((node, f, cut, len(rows), depth))
        left = rows[:, f] < cut
        todo += [(2 * node + 1, depth + 1, rows[left]), (2 * node + 2, depth + 1, rows[~left])]
    got = pd.DataFrame(out, columns=["node", "feature", "cut", "size", "depth"])
    got.insert(0, "tree", tree)
    got.insert(0, "model", pdf["model"].iloc[0])
    return got


def average_path(n: np.ndarray) -> np.ndarray:
    """The mean path length of an unsuccessful search among n."""
    n = np.asarray(n, float)
    safe = np.maximum(n - 1, 1)
    return np.where(n > 2, 2 * (np.log(safe) + 0.5772156649015329) - 2 * safe / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def score(z: DataFrame, trees: DataFrame, group_rows: int = 100_000) -> DataFrame:
    """``model, bucket, score``: minus 2 to the power of minus the relative mean path; higher is more normal.

    Rows meet the trees of their model in groups of about ``group_rows``; the trees (a fixed
    number of small ones) go to each group of the model. Models without trees score nothing.
    """
    ship(z.sparkSession)
    known = z.join(trees.select("model").distinct(), "model", "left_semi")
    parts = known.groupBy("model").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / group_rows)).alias("parts"))
    rows = known.join(parts, "model").select("model", "bucket", "z", F.pmod(F.xxhash64("bucket", "z"), F.col("parts")).alias("part"))
    copies = rows.select(F.col("model").alias("_model"), F.col("part").alias("_part")).distinct()
    nodes = trees.join(copies, F.col("model") == F.col("_model"))
    return rows.groupBy("model", "part").cogroup(nodes.groupBy("_model", "_part")).applyInPandas(_score, "model string, bucket timestamp, score double")


def _score(rows: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
    t = _tables(nodes)
    path = _paths(t, np.stack(rows["z"].to_numpy()))
    norm = max(float(average_path(t["size"][:, 0].mean())), 1e-9)
    return pd.DataFrame({"model": rows["model"], "bucket": rows["bucket"], "score": -np.power(2.0, -path.mean(0) / norm)})


def _tables(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """Node columns as arrays of trees x nodes."""
    names, row = np.unique(nodes["tree"].to_numpy(), return_inverse=True)
    at = row, nodes["node"].to_numpy()
    shape = len(names), int(nodes["node"].max()) + 1
    out = {"feature": np.full(shape, -1), "cut": np.zeros(shape), "size": np.zeros(shape), "depth": np.zeros(shape)}
    for c in out:
        out[c][at] = nodes[c].to_numpy()
    return out


def _paths(t: dict[str, np.ndarray], data: np.ndarray) -> np.ndarray:
    which, row = np.arange(len(t["feature"]))[:, None], np.arange(len(data))
    at = np.zeros((len(t["feature"]), len(data)), int)
    while True:
        f = t["feature"][which, at]
        if (f < 0).all():
            return t["depth"][which, at] + average_path(t["size"][which, at])
        right = data[row, np.maximum(f, 0)] >= t["cut"][which, at]
        at = np.where(f < 0, at, 2 * at + 1 + right)


def thresholds(scores: DataFrame, trained_at: Column, before: DataFrame | None = None) -> DataFrame:
    """``model, warning, critical, n_train, trained_at, first_trained_at`` from the scores of the training rows.

    A model that is among the thresholds of ``before`` keeps its first training.
    """
    rows = scores.groupBy("model").agg(
        F.percentile("score", F.lit(WARNING_AT)).alias("warning"),
        F.percentile("score", F.lit(CRITICAL_AT)).alias("critical"),
        F.count("*").alias("n_train"),
    ).withColumn("trained_at", trained_at)
    if before is None:
        return rows.withColumn("first_trained_at", trained_at)
    rows = rows.join(before.select("model", "first_trained_at"), "model", "left")
    return rows.withColumn("first_trained_at", F.coalesce("first_trained_at", "trained_at"))


def save_models(trees: DataFrame, limits: DataFrame, path: str) -> None:
    """Two tables under ``path``, a folder per model; models of this training replace their own folders only."""
    for table, name in ((trees, "trees"), (limits, "thresholds")):
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(f"{path}/{name}")


def load_models(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``trees, thresholds``. Rows of models that are not there score nothing, as both are joined inner."""
    kinds = TREE_SCHEMA, "model string, warning double, critical double, n_train long, trained_at timestamp, first_trained_at timestamp"
    trees, limits = (spark.read.schema(k).parquet(f"{path}/{n}") for k, n in zip(kinds, ("trees", "thresholds"), strict=True))
    return trees, limits


def classify(scores: DataFrame, limits: DataFrame, as_of: Column, warm_up_days: int = 7, floor: str = "info", since: str = "trained_at") -> DataFrame:
    """Adds ``severity``: strictly under the model's thresholds; ``info`` while the model is young.

    ``since``: ``trained_at``, or ``first_trained_at`` for a warm-up that a new training does not start again.
    """
    rows = scores.join(limits, "model")
    found = F.when(F.col("score") < F.col("critical"), "critical").when(F.col("score") < F.col("warning"), "warning")
    return rows.withColumn("severity", x.warm_up(x.at_least(found, floor), F.col(since), as_of, warm_up_days))
