"""Mixing sources to target weights by systematic sampling. Built-in functions only.

Sources in code point order (null last) weigh 1, 2, 3 and again; they share the
size of the whole corpus by weight, none above ``cap`` times its own size, the
excess going to the others by weight. That is a common level times the weight,
cut off at the cap, and the level is the largest of ``(total - caps of the k
smallest) / (weights of the others)`` over k, sources in order of cap over weight.

Every document of a source expects ``target / source_size`` copies, at most
``cap``. Documents are laid end to end in order of size, equal sizes in a fixed
random order; the running sum of expected copies plus one random offset of the
source gives a document one copy for each whole number it crosses. In size
order the words taken stay near the target even if a few texts are very long.

The running sum is never taken over a source as one sorted group: counts by
(source, size, hash bucket) are summed over sizes, then over buckets, and only
rows of one bucket are numbered by a window. So a source with a third of all
rows, or one size shared by them, spreads over many tasks.

Defined results: null text has size 0; documents of size 0 get their copies like
others but take no words; a source without words has target 0 and no copies;
rows that repeat a doc_id are drawn as separate rows, in the order of their texts' digests and then of their other columns; a row
without doc_id has the place of its text's digest; so the mix doesn't depend on the order of rows. A very long text is a row of a large size; no rows give no rows. Other columns
pass through untouched. Sources are few: their targets are worked out by windows over one row
for each source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_names, table, written

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix-1"


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` for rows ``(source, size)``; one row per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (nth + 1).cast("int")).cast("long")
    per = per.withColumn("w", weight).withColumn("most", F.col("source_size") * cap)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    others = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    per = per.withColumn("level", left.cast("double") / others.cast("double"))
    level = F.max("level").over(everything)
    return per.withColumn("target", F.least(F.col("most").cast("double"), level * F.col("w"))).select(
        "source", "source_size", "target"
    )


def text_hash(text) -> F.Column:
    return F.md5(F.coalesce(text, F.lit("")))


def draw(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED, ties: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (with ``doc_id``, ``source``, ``size`` and ``text_hash``) plus ``source_size, target, copies``.

    Rows equal in source, size, doc_id and text are told apart by the columns ``ties``, if there are any.
    """
    keyed = docs.withColumn("_h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), "text_hash"))))
    keyed = keyed.withColumn("_b", F.substring("_h", 1, 3))
    counts = keyed.groupBy("source", "size", "_b").agg(F.count("*").alias("_n"))
    by_bucket = Window.partitionBy("source", "size").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    by_size = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("source", "size").agg(F.sum("_n").alias("_m"))
    sizes = sizes.withColumn("_below", F.coalesce(F.sum("_m").over(by_size), F.lit(0))).drop("_m")
    counts = counts.withColumn("_inside", F.coalesce(F.sum("_n").over(by_bucket), F.lit(0))).drop("_n")
    word = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit("")))), 1, 6), 16, 10).cast("long")
    goal = targets(sizes_of(docs), weights, cap).withColumn("_u", (word % 1024 + 0.5) / 1024.0)

    same_size = counts["source"].eqNullSafe(sizes["source"]) & (counts["size"] == sizes["size"])
    place = counts.join(sizes, same_size).select(
        counts["source"], counts["size"], "_b", (F.col("_inside") + F.col("_below")).alias("_before")
    )
    place = place.join(goal, place["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    place = place.toDF(*["_source" if c == "source" else "_size" if c == "size" else "_bucket" if c == "_b" else c for c in place.columns])
    at = keyed["source"].eqNullSafe(place["_source"]) & (keyed["size"] == place["_size"]) & (keyed["_b"] == place["_bucket"])
    in_bucket = Window.partitionBy("source", "size", "_b").orderBy("_h", "doc_id", "text_hash", *ties)
    ranked = keyed.withColumn("_r", F.row_number().over(in_bucket)).join(place, at)
    rank = F.col("_before") + F.col("_r")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(F.col("_u") + share * rank) - F.floor(F.col("_u") + share * (rank - 1))
    return ranked.withColumn("copies", copies.cast("long")).select(*docs.columns, "source_size", "target", "copies")


def sizes_of(docs: DataFrame) -> DataFrame:
    return docs.select("source", "size")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` once per copy, with ``copy`` (underscores in front if taken) counting from 1."""
    packed = docs.select("doc_id", "source", word_count("text").alias("size"), text_hash(F.col("text")).alias("text_hash"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]  # what has an order
    ties = [f"_row.`{c}`" for c in sorted(plain, key=str.lower) if c.lower() not in ("doc_id", "source", "text")]
    drawn = draw(packed, weights, cap, seed, tuple(ties)).where("copies > 0")
    name = free_names(["copy"], docs.columns)[0]
    return drawn.select("_row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(name))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"), text_hash(F.col("text")).alias("text_hash"))
    drawn = draw(written(docs, "sizes"))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(text, '')) AS t
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w, 3 * source_size AS most FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER b, 0))::DOUBLE
             / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level
  FROM w WINDOW b AS (ORDER BY most::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(most::DOUBLE, max(level) OVER () * w) AS target,
    (CAST('0x' || substr(md5('mix-1' || coalesce(source, '')), 1, 6) AS BIGINT) % 1024 + 0.5::DOUBLE) / 1024 AS u FROM l),
r AS (SELECT d.doc_id, d.size, t.*, row_number() OVER (
    PARTITION BY d.source ORDER BY d.size, md5(coalesce(d.doc_id::VARCHAR, 'text:' || d.t)), d.doc_id, d.t) AS r
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS f FROM r)
SELECT doc_id, size, source_size, target,
  ((floor(u + f * r) - floor(u + f * (r - 1))) * size)::BIGINT AS taken
FROM f
"""
