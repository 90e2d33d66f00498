"""License scans by canonical digest.

A unit of text is put in canonical form (lower case; copyright lines removed;
equivalent spellings made one; everything but letters and digits made one space)
and its SHA-256 is hash-joined with the digests of known texts, which went
through the same expressions. Units are the entire document and each of its
lines, so a licence that is the document and a notice of one line are
both found; a licence is never guessed from a part of a unit.

All of it is built-in expressions in one pass. The known side is either the list
of this package (``LICENSES`` as texts, ``DIGESTS`` of long ones), a constant that is broadcast, so the
corpus is not shuffled, only the matches are; or a table of digests of any size,
joined as Spark sees fit.

Defined results: null and empty texts and units that are nothing but punctuation or
copyright lines match nothing; a document that is one line matches as text and
as line and counts both; rows that repeat a doc_id add to its counts, and rows without one count
together under a null doc_id; a very long text is put in canonical form whole; no
rows give no rows; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .license_texts import DIGESTS, LICENSES

COPYRIGHT = r"(?m)^[^a-z0-9\n]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4})|copyright[ \t]+(?:by[ \t]|the[ \t][^\n]*(?:authors|contributors|developers|project|foundation|regents|team))|\(c\)[ \t]|©)[^\n]*$"
#: Spellings that count as the same, after lower-casing.
EQUIVALENT = [("licenc", "licens"), ("sub-licens", "sublicens"), ("organis", "organiz"), ("favour", "favor"), ("whilst", "while"), ("non-commercial", "noncommercial"), ("per cent", "percent"), ("https:", "http:")]


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    for a, b in EQUIVALENT:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def digests(texts: DataFrame) -> DataFrame:
    """``license_id, digest`` of known texts ``(license_id, text)``: a table for ``scan``."""
    lines = F.filter(F.transform(F.split("text", "\n"), canonical), lambda x: x != "")
    return texts.select("license_id", F.sha2(F.concat_ws(" ", lines), 256).alias("digest")).distinct()


def known_digests(spark: SparkSession) -> DataFrame:
    """The licences and notices of this package."""
    texts = digests(spark.createDataFrame(LICENSES, "license_id string, text string"))
    return F.broadcast(texts.unionByName(spark.createDataFrame(DIGESTS, "license_id string, digest string")))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id, license_id, n_lines, whole`` for every licence a document carries; known: ``license_id, digest``, else those of this package."""
    known = known_digests(docs.sparkSession) if known is None else known.select("license_id", "digest").distinct()
    lines = docs.where("text IS NOT NULL").select("doc_id", F.transform(F.split("text", "\n"), canonical).alias("lines"))
    full = F.filter("lines", lambda x: x != "")  # no rule reaches over a line end, so lines put together are the whole text's form
    unit = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.concat_ws(" ", full).alias("c"))), F.transform(full, lambda x: F.struct(F.lit(False).alias("whole"), x.alias("c"))))
    units = lines.select("doc_id", F.explode(unit).alias("u")).select("doc_id", "u.whole", "u.c")
    units = units.where("c <> ''").select("doc_id", "whole", F.sha2("c", 256).alias("digest"))
    found = units.join(known, "digest")
    count = F.sum(F.when(F.col("whole"), 0).otherwise(1))
    return found.groupBy("doc_id", "license_id").agg(count.alias("n_lines"), F.max("whole").alias("whole"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql_canonical(text: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"regexp_replace(lower({text}), {quote(COPYRIGHT)}, '', 'g')"
    for a, b in EQUIVALENT:
        out = f"replace({out}, {quote(a)}, {quote(b)})"
    return f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def oracle() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values, long = (", ".join(f"({quote(a)}, {quote(b)})" for a, b in rows) for rows in (LICENSES, DIGESTS))
    return f"""
WITH known AS (SELECT DISTINCT license_id, sha256({_sql_canonical("t")}) AS digest FROM (VALUES {values}) v(license_id, t)
  UNION SELECT * FROM (VALUES {long}) w(license_id, digest)),
units AS (
  SELECT doc_id, TRUE AS whole, text AS t FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, FALSE, unnest(string_split(text, chr(10))) FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, whole, {_sql_canonical("t")} AS c FROM units)
SELECT doc_id, license_id, count(*) FILTER (NOT whole)::BIGINT AS n_lines, bool_or(whole) AS whole
FROM c JOIN known ON sha256(c) = digest WHERE c <> '' GROUP BY doc_id, license_id
"""
