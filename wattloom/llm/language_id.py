"""Language identification by compression with per-language zstandard dictionaries.

A raw-content dictionary per language is cut from a bounded sample of labelled
texts. A text belongs to the language whose dictionary codes it in
the fewest bytes, lower-cased and behind a line end as in the dictionary; equal
sizes go to the language with more sample texts, then by name. Level 6 matters:
lower levels index a dictionary too sparsely to tell short texts apart.

The sample, by hash: at most ``SAMPLE_TEXTS`` texts of a language, short ones too, which share
``SAMPLE_CHARS`` characters: each gives a piece of at most its share, from a place drawn by hash; so
a language with few texts gives longer pieces. Texts to be told are coded whole.

Defined results: null texts and texts without a letter are ``und`` with score
0, and teach nothing; a margin under ``MARGIN`` of the best size, or under two bytes, sets
``rejected`` (the best guess stays in ``lang_pred``); with no labelled rows
every text is ``und``. A labelled row without doc_id is learnt from like any other, and
``held_out`` is false for it; rows that repeat a doc_id get a row each and may be learnt from each; equal texts have equal
results; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship, table

#: Labelled texts of a language that make its dictionary, and the characters that they share.
SAMPLE_TEXTS = 150
SAMPLE_CHARS = 60_000
LEVEL = 6
MARGIN = 0.02

_letter = regex.compile(r"\p{L}")


def dictionaries(labelled: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> list[tuple[str, bytes]]:
    """``(language, raw content)`` from at most ``texts`` rows of ``(doc_id, text, lang)`` a language."""
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text")
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "doc_id", "text")
    rows = usable.withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= texts)
    rows = rows.withColumn("piece", F.floor(chars / F.count("*").over(Window.partitionBy("lang"))).cast("int"))  # at most ``texts`` rows a language
    piece = F.col("piece")
    at = F.greatest(F.lit(1), F.pmod(F.xxhash64("doc_id", F.lit(7)), F.greatest(F.length("text") - piece, F.lit(1))).cast("int"))
    found: dict[str, list[str]] = {}
    for r in rows.select("lang", F.substring("text", at, piece).alias("t"), "nth").orderBy("lang", "nth").collect():
        found.setdefault(r.lang, []).append(r.t.lower())
    return [(lang, "\n".join(parts).encode()) for lang, parts in sorted(found.items(), key=lambda x: (-len(x[1]), x[0]))]


def coders(known: list[tuple[str, bytes]], level: int = LEVEL) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, content in known:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


def classify(text: str | None, names: list[str], made: list[zstandard.ZstdCompressor]) -> tuple[str, float, bool]:
    if not text or not names or not _letter.search(text):
        return "und", 0.0, True
    low = ("\n" + text.lower()).encode()
    sizes = np.array([len(c.compress(low)) for c in made], float)
    best = int(np.argmin(sizes))
    gap = np.partition(sizes, 1)[1] - sizes[best] if len(sizes) > 1 else np.inf
    weight = np.exp(-(sizes - sizes[best]) / (2 + 0.01 * sizes[best]))
    return names[best], float(1 / weight.sum()), bool(gap < max(2, MARGIN * sizes[best]))


def identify(docs: DataFrame, labelled: DataFrame, level: int = LEVEL) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs(doc_id, text)``."""
    ship(docs.sparkSession)
    known = dictionaries(labelled)
    spread = docs.sparkSession.sparkContext.broadcast(known)  # SAMPLE_CHARS for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, made = [n for n, _ in spread.value], coders(spread.value, level)
        for batch in batches:
            rows = [classify(t, names, made) for t in batch.column(1).to_pylist()]
            lang, score, rejected = zip(*rows, strict=True) if rows else ((), (), ())
            cols = [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 4).eqNullSafe(2)
    out = identify(docs, docs.where(~held_out))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
