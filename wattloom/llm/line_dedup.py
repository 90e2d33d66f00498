"""Line deduplication by overlapping windows of three consecutive lines.

Every window of three newline-split lines is hashed (two 64-bit hashes). Of a
window that occurs more than once in the corpus, the occurrence with the
smallest (doc_id, line) stays; the lines of all later occurrences are
removed, each line once however many windows cover it. Windows of
blank lines only are left alone, so spacing is no repetition.

Repeats are found by a grouped minimum, with map-side combining, and a join
back on the hash; a line that a third of all documents share is one group row
after combining and its occurrences spread over the join by row count (AQE
splits the hot key, see the test on a line that all documents share). The texts themselves move once, to meet their removed
positions, and not at all when these are few.

Defined results: null and empty texts and texts under three lines have no
window and stay as they are; rows that repeat a doc_id count as one occurrence
and are treated alike (the texts of such rows are expected to be equal); rows without doc_id lose no line; a document
left without a word (``WORD``) has ``emptied`` true; a very long text is one row of lines at a time in a
task; no rows give no rows. Columns besides doc_id and text pass through untouched,
made columns give way to names that are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_names, join_few, leave, scratch, table, written

WINDOW = 3
MADE = ["n_lines", "n_removed", "emptied"]
WORD = r"[^\x20\x09-\x0D]"


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, pos, h1, h2`` of every window with a word; pos counts lines from 0."""
    line = F.split(F.coalesce("text", F.lit("")), "\n")
    one = F.transform(line, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), x.rlike(WORD).alias("w")))
    rows = docs.select("doc_id", one.alias("k")).where(F.size("k") >= size)
    each = F.transform(F.col("k"), lambda x, i: F.struct(i.alias("pos"), F.slice(F.col("k"), i + 1, size).alias("s")))
    rows = rows.select("doc_id", F.explode(F.slice(each, 1, F.size("k") - size + 1)).alias("x"))
    rows = rows.where(F.exists("x.s", lambda y: y["w"]))
    return rows.select("doc_id", F.col("x.pos").alias("pos"), F.xxhash64("x.s.a").alias("h1"), F.xxhash64("x.s.b").alias("h2"))


def later_windows(found: DataFrame) -> DataFrame:
    """Of each repeated window, every occurrence but the first."""
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "pos")).alias("f"), F.count("*").alias("n"))
    both = found.join(first.where("n > 1"), ["h1", "h2"])
    return both.where(~(F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("pos") == F.col("f.pos")))).select("doc_id", "pos")


def _without(line: F.Column, starts: F.Column, size: int) -> F.Column:
    """The lines that no window at ``starts`` covers. Each array is walked once, whatever its length."""
    gone = F.array_distinct(F.flatten(F.transform(starts, lambda p: F.sequence(p, p + (size - 1)))))
    left = F.array_except(F.sequence(F.lit(0), F.size(line) - 1), gone)
    flags = F.concat(F.transform(left, lambda i: F.struct(i.alias("i"), F.lit(True).alias("stays"))), F.transform(gone, lambda i: F.struct(i.alias("i"), F.lit(False).alias("stays"))))
    both = F.zip_with(line, F.array_sort(flags), lambda x, f: F.struct(x.alias("x"), f["stays"].alias("stays")))
    return F.transform(F.filter(both, lambda s: s["stays"]), lambda s: s["x"])


def dedup_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with shortened texts, plus the columns ``MADE`` (underscores in front where ``docs`` has the name)."""
    with scratch(docs.sparkSession):
        found = written(windows(docs.select("doc_id", "text"), size), "line-windows")
        starts = later_windows(found).groupBy("doc_id").agg(F.collect_set("pos").alias("_starts"))
        starts = leave(starts, "line-starts")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *rest).alias("_rest"))
    joined = join_few(packed, starts, "doc_id", F.size("_starts")).select("doc_id", "text", "_rest", "_starts")
    line = F.split(F.coalesce("text", F.lit("")), "\n")
    joined = joined.withColumn("_n", F.size(line).cast("long")).withColumn("_left", F.when(F.col("_starts").isNotNull(), _without(line, F.col("_starts"), size)))
    joined = joined.withColumn("_kept", F.array_join("_left", "\n"))
    changed = F.col("_left").isNotNull()
    made = [F.col("_n"), F.when(changed, F.col("_n") - F.size("_left")).otherwise(F.lit(0).cast("long")), changed & ~F.coalesce("_kept", F.lit("")).rlike(WORD)]
    columns = [F.coalesce("_kept", "text").alias("text") if c == "text" else F.col(c) if c == "doc_id" else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns]
    return joined.select(*columns, *(m.alias(c) for m, c in zip(made, free_names(MADE, docs.columns), strict=True)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos
  FROM documents),
w AS (
  SELECT doc_id, pos, line AS a, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c
  FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
n AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth
  FROM w WHERE c IS NOT NULL AND regexp_matches(a || b || c, '[^\x20\x09-\x0D]')),
g AS (SELECT DISTINCT doc_id, pos + k AS pos FROM n, (VALUES (0), (1), (2)) v(k) WHERE nth > 1),
m AS (SELECT l.*, g.pos IS NOT NULL AS gone FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
