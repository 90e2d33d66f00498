"""Isolation forests fitted and scored level by level with joins and windows; no Python worker.

Fit: every tree draws its rows by hash rank. All draws come from md5 of seed, tree and row or node, so a forest is the same
everywhere, in other engines too. Rows are dealt out by tree once; a level is one window over a tree's node (256 rows at
most), which gives each feature's range, the cut by hash, and the side of each row.

Score: a row takes a place in each tree and goes down by a join with the node table a level. The node table is broadcast
if a count shows that it is small. Rows times trees pass through the joins; their mean depth is
summed before the one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .forest import SEED, SUBSAMPLE, TREES

#: A node table of at most so many rows is sent to every task.
SENT_NODES = 1_000_000


def share(*parts: Column | str | int) -> Column:
    """A number between 0 and 1 drawn by md5 of the parts."""
    text = F.concat_ws(":", *(F.lit(str(p)) if isinstance(p, int) else p if isinstance(p, Column) else F.lit(p) for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(2.0**32)


def depth_limit(n: int = SUBSAMPLE) -> int:
    return max(1, (n - 1).bit_length())


def average_path(n: Column) -> Column:
    """The mean path length of an unsuccessful search among n."""
    return F.when(n > 2, 2 * (F.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n).when(n == 2, 1.0).otherwise(0.0)


def drawn(matrix: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> DataFrame:
    """``model, tree, x``: the rows of each tree. A hash bound a few times the wanted share comes first, so no full group is sorted."""
    n = matrix.groupBy("model").agg(F.count("*").alias("_n"))
    rows = matrix.join(n, "model").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    name = F.date_format("bucket", "yyyy-MM-dd HH:mm:ss")
    rows = rows.withColumn("_h", share(seed, F.col("tree").cast("string"), name)).where(F.col("_h") < (2.0 * subsample + 64) / F.col("_n"))
    rank = F.row_number().over(Window.partitionBy("model", "tree").orderBy("_h", "bucket", "x"))
    return rows.withColumn("_k", rank).where(F.col("_k") <= subsample).select("model", "tree", "x")


def fit(matrix: DataFrame, features: int, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> DataFrame:
    """The node table ``model, tree, node, feature, cut, size, depth`` of ``matrix(model, bucket, x)``; ``feature`` -1 is a leaf, children of k are 2k+1 and 2k+2."""
    rows = drawn(matrix, trees, subsample, seed).withColumn("_node", F.lit(0))
    limit = F.ceil(F.log2(F.greatest(F.count("*").over(Window.partitionBy("model", "tree")), F.lit(2)))).cast("int")
    rows = rows.withColumn("_limit", limit).withColumn("_path", F.array().cast("array<struct<node:int,feature:int,cut:double,size:int,depth:int>>"))
    for depth in range(depth_limit(subsample) + 1):
        here = Window.partitionBy("model", "tree", "_node")
        ranges = F.array(*(F.struct(F.lit(f).alias("f"), F.min(F.col("x")[f]).over(here).alias("low"), F.max(F.col("x")[f]).over(here).alias("high")) for f in range(features)))
        rows = rows.withColumns({"_size": F.count("*").over(here).cast("int"), "_wide": F.filter(ranges, lambda r: r["high"] > r["low"])})
        tree, node = F.col("tree").cast("string"), F.col("_node").cast("string")
        ends = (F.lit(depth) >= F.col("_limit")) | (F.col("_size") <= 1) | (F.size("_wide") == 0)
        pick = F.element_at("_wide", (F.floor(share(seed, tree, node, F.lit("feature")) * F.size("_wide")) + 1).cast("int"))
        cut = pick["low"] + share(seed, tree, node, F.lit("cut")) * (pick["high"] - pick["low"])
        live = F.col("_node") >= 0
        rows = rows.withColumns({"_feature": F.when(ends, -1).otherwise(pick["f"]), "_cut": F.when(ends, 0.0).otherwise(cut)})
        made = F.struct(F.col("_node").alias("node"), F.col("_feature").alias("feature"), F.col("_cut").alias("cut"), F.col("_size").alias("size"), F.lit(depth).alias("depth"))
        rows = rows.withColumn("_path", F.when(live, F.array_append("_path", made)).otherwise(F.col("_path")))
        right = (F.element_at("x", F.col("_feature") + 1) >= F.col("_cut")).cast("int")
        step = F.when(live & (F.col("_feature") >= 0), 2 * F.col("_node") + 1 + right).otherwise(-1)
        rows = rows.withColumn("_node", step).select("model", "tree", "x", "_limit", "_path", "_node")
    nodes = rows.select("model", "tree", F.explode("_path").alias("p")).groupBy("model", "tree", "p.node").agg(F.first("p").alias("p"))
    return nodes.select("model", "tree", *(F.col(f"p.{c}").alias(c) for c in ("node", "feature", "cut", "size", "depth")))


def score(matrix: DataFrame, nodes: DataFrame) -> DataFrame:
    """``model, bucket, score`` of each row: minus 2 to the power of minus the relative mean path. ``nodes`` is a written table; models without trees score nothing."""
    facts = nodes.agg(F.count("*").alias("n"), F.max("depth").alias("deep")).first()
    if not facts.n:
        return matrix.select("model", "bucket", F.lit(0.0).alias("score")).limit(0)
    side = F.broadcast(nodes) if facts.n <= SENT_NODES else nodes
    step = side.select("model", "tree", F.col("node").alias("_node"), "feature", "cut", "size", "depth")
    roots = nodes.where("node = 0").groupBy("model").agg(F.collect_set("tree").alias("_trees"), F.greatest(average_path(F.avg("size")), F.lit(1e-9)).alias("_norm"))
    rows = matrix.select("model", "bucket", "x").withColumn("_row", F.monotonically_increasing_id()).join(roots, "model")
    rows = rows.select("model", "bucket", "_row", "x", "_norm", F.explode("_trees").alias("tree"), F.lit(0).alias("_node"), F.lit(None).cast("double").alias("_path"))
    for _ in range(facts.deep + 1):
        met = rows.join(step, ["model", "tree", "_node"], "left")
        leaf = F.col("feature") < 0
        path = F.coalesce("_path", F.when(leaf, F.col("depth") + average_path(F.col("size").cast("double"))))
        right = (F.element_at("x", F.greatest(F.col("feature"), F.lit(0)) + 1) >= F.col("cut")).cast("int")
        rows = met.select("model", "bucket", "_row", "x", "_norm", "tree", F.when(leaf | F.col("_path").isNotNull(), -1).otherwise(2 * F.col("_node") + 1 + right).alias("_node"), path.alias("_path"))
    means = rows.groupBy("model", "bucket", "_row", "_norm").agg(F.avg("_path").alias("_mean"))
    return means.select("model", "bucket", (-F.pow(F.lit(2.0), -F.col("_mean") / F.col("_norm"))).alias("score"))
