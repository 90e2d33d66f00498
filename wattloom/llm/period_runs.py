"""Periodic runs of words: stretches that repeat with a smallest period at least four times, and texts without the repeats.

Periods are searched by octave, ``b <= q < 2 b`` for each power of two ``b``, in tiles of a few ``b`` words:

1. A task that holds a text numbers its words and names every block of ``b`` words by doubling. The words that are equal at
   distance q, in a run of period q, are at least ``3 b`` in a row, so around some multiple of ``b``
   both neighbouring blocks come again at distance q. Only such boundaries make tiles: they are exploded
   as rows that overlap by ``2 b`` words before and ``4 b`` after their first and last boundary.
2. Tiles are dealt out anew, whatever text they are of. A Z-function to the right and one to the left of
   a boundary tell exactly how far the words stay equal at each distance of the octave. A distance whose block is itself a
   repetition is no smallest period and is left out there.
3. The fragments are shuffled by document and period and stitched where they overlap; a run may span any
   number of tiles. The runs of a document, bounded by its length, meet its text once more.

Names by doubling are 64-bit hashes and only choose boundaries; equality is decided on the words. Equal blocks
have equal names, so none is missed.

Defined results: a null text is the empty one: no runs, digests of nothing; so is one with fewer words
than ``LEAST``. A very long text is many tiles. Rows that repeat a doc_id and its text have equal results, rows that share a
doc_id only have their own; rows without doc_id are told apart by their text. Ties of the greatest exponent go to the
smallest start, then period; exponents are compared as doubles, which tell all fractions apart in texts
under 90 million words. No rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_few, ship, table, written
from .textops import chunks, mix

#: A run has at least so many periods and so many words.
TIMES = 4
LEAST = 6
#: Boundaries that follow one another share a tile of about so many words.
TILE_WORDS = 1 << 15

_TILE = pa.schema([("key", pa.string()), ("octave", pa.int32()), ("low", pa.int64()), ("first", pa.int64()), ("count", pa.int32()), ("words", pa.binary())])
_FRAGMENT = pa.schema([("key", pa.string()), ("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
_WORDS = r"[^\x20\x09-\x0D]+"


def words_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of bytes other than space and 0x09-0x0D, which is where bytes are split."""
    return text.split() if text else []


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


def boundaries(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each octave, the ``j`` whose blocks before and after word ``j b`` both come again at one distance of the octave."""
    n, b, octave = len(ids), 1, 0
    if n < LEAST:
        return
    name = mix(ids.astype(np.uint64) + np.uint64(1))
    while TIMES * b <= n:
        left = len(name) - b
        rows = -(-left // b)
        after = np.zeros(rows * b, name.dtype)
        after[:left] = name[b:]
        again = after.reshape(rows, b) == name[: rows * b : b, None]
        again.reshape(-1)[left:] = False
        found = np.flatnonzero((again[:-1] & again[1:]).any(axis=1)) + 1
        if len(found):
            yield octave, found
        name = name[:-b] * np.uint64(0x9E3779B97F4A7C15) + name[b:]
        name ^= name >> np.uint64(29)
        b, octave = 2 * b, octave + 1


def tiles_of(ids: np.ndarray) -> Iterator[tuple[int, int, int, int, bytes]]:
    """``octave, low, first, count, words``: the words from ``low`` on around ``count`` boundaries from ``first b`` on."""
    for octave, found in boundaries(ids):
        b = 1 << octave
        most = max(1, TILE_WORDS // b)
        cuts = [0, *(np.flatnonzero(np.diff(found) > 1) + 1).tolist(), len(found)]
        for a, z in pairwise(cuts):
            for k in range(a, z, most):
                first, count = int(found[k]), min(most, z - k)
                low = max(0, (first - 2) * b)
                yield octave, low, first, count, ids[low : (first + count + 3) * b].tobytes()


def z_function(seq: list[int], upto: int) -> list[int]:
    """How long the sequence agrees with itself from each of the places under ``upto`` on."""
    n = len(seq)
    z = [n, *[0] * (min(upto, n) - 1)] if n else []
    a = e = 0
    for i in range(1, len(z)):
        k = min(z[i - a], e - i) if i < e else 0
        while i + k < n and seq[k] == seq[i + k]:
            k += 1
        z[i] = k
        if i + k > e:
            a, e = i, i + k
    return z


def prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*out, n] if n > 1 else out


def solve(octave: int, low: int, first: int, count: int, words: list[int]) -> list[tuple[int, int, int]]:
    """``period, start, stop`` of the places in a tile whose word comes again a period later, around its boundaries."""
    b, out, open_ = 1 << octave, [], {}
    for j in range(first, first + count):
        at = j * b - low
        right = z_function(words[at : at + 4 * b], 2 * b)
        periods = [q for q in range(b, len(right)) if right[q] >= b]
        if not periods:
            continue
        back = max(0, at - 2 * b)
        before, around = words[back:at][::-1], words[back : at + 2 * b][::-1]
        left = z_function([*before, -1, *around], 4 * b + 1 + len(before))
        for q in periods:
            place = len(before) + 1 + len(around) - len(before) - q  # of the word before the boundary, q words later
            if place <= len(before) or left[place] < b or any(right[q // r] >= q - q // r for r in prime_factors(q)):
                continue
            start, stop = low + at - min(left[place], 2 * b), low + at + min(right[q], 2 * b)
            if q in open_ and start <= open_[q][1]:
                open_[q][1] = stop
            else:
                if q in open_:
                    out.append((q, *open_[q]))
                open_[q] = [start, stop]
    return out + [(q, *span) for q, span in open_.items()]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        keys, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
        rows, held = [], 0
        for key, text in zip(keys, texts, strict=True):
            for tile in tiles_of(numbered(words_of(text))):
                rows.append((key, *tile))
                held += len(tile[-1])
                if held > 1 << 22:
                    yield _batch(rows, _TILE)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, _TILE)


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for k in range(batch.num_rows):
            key, octave, low, first, count, words = (c[k].as_py() for c in batch.columns)
            out += [(key, *f) for f in solve(octave, low, first, count, np.frombuffer(words, np.int32).tolist())]
        if out:
            yield _batch(out, _FRAGMENT)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _key() -> Column:
    """Tells documents apart: doc_id and text. Rows equal in both are one document."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex(F.xxhash64("text")))


def period_runs(docs: DataFrame) -> DataFrame:
    """``key, start, length, period`` of every run in ``docs(key, text)``; rows with one key are one document."""
    ship(docs.sparkSession)
    tiles = docs.select("key", "text").mapInArrow(_tiles, "key string, octave int, low long, first long, count int, words binary")
    dealt = tiles.withColumn("_from", F.spark_partition_id()).repartition("key", "octave", "low", "_from").drop("_from")  # repeated rows are spread too
    found = dealt.mapInArrow(_fragments, "key string, period long, start long, stop long").distinct()
    order = Window.partitionBy("key", "period").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = found.withColumn("_new", F.when(F.col("start") <= reach, 0).otherwise(1))
    parts = parts.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parts.groupBy("key", "period", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("_stop"))
    length = F.col("_stop") - F.col("start") + F.col("period")
    runs = whole.select("key", "start", length.alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))


def by_document(runs: DataFrame) -> DataFrame:
    """A row per key: ``n_runs``, the ``best`` run and all of them in order."""
    best = F.max(F.struct((F.col("length") / F.col("period")).alias("e"), (-F.col("start")).alias("s"), (-F.col("period")).alias("p"), F.col("length").alias("n")))
    return runs.groupBy("key").agg(F.count("*").alias("n_runs"), best.alias("best"), F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def collapse(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """For every row of ``docs(doc_id, text)``: its runs' figures and digest, and the digest of the text without repeats.

    ``with_text`` adds ``runs`` and ``collapsed``, the words that stay joined by one space. A word goes if
    it is in a run and after that run's first period.
    """
    keyed = docs.select("doc_id", "text").withColumn("key", _key())
    runs = written(by_document(period_runs(keyed)), "period-runs")
    met = join_few(keyed, runs, "key", 3 * F.col("n_runs") + 5)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    met = met.select(
        "doc_id",
        "text",
        F.coalesce("n_runs", F.lit(0)).alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.n div -best.p").alias("exponent_milli"),
        F.sha2(F.coalesce(F.array_join(lines, ""), F.lit("")), 256).alias("runs_sha256"),
        *(F.col(f"runs.{c}").alias(f"_{c}s") for c in ("start", "period", "length")),
    )
    made = "doc_id {}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string".format(dict(docs.dtypes)["doc_id"])
    if with_text:
        made += ", starts array<long>, periods array<long>, lengths array<long>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = []
            for text, *spans in zip(*(batch.column(k).cast(pa.binary()).to_pylist() if k == 1 else batch.column(k).to_pylist() for k in (1, 8, 9, 10)), strict=True):
                words = words_of(text)
                if spans[0]:
                    gone = np.zeros(len(words), bool)
                    for start, period, length in zip(*spans, strict=True):
                        gone[start + period : start + length] = True
                    words = [words[k] for k in np.flatnonzero(~gone)]
                texts.append(b" ".join(words))
            cols = [batch.column(0), *batch.columns[2:8], pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
            names = ["doc_id", *batch.schema.names[2:8], "collapsed_sha256"]
            if with_text:
                cols += [*batch.columns[8:11], pa.array(texts, pa.binary()).cast(pa.string())]
                names += ["starts", "periods", "lengths", "collapsed"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return met.mapInArrow(run, made)


def damaged(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: one text in ten, by the crc32 of its doc_id, goes on from some word with a repetition. Null ids damage nothing."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeat(w: Column) -> Column:
        n = F.size(w)
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.element_at(w, (a + (i - a) % p + 1).cast("int"))))

    once = F.array(F.regexp_extract_all("text", F.lit(f"({_WORDS})"), F.lit(1)))  # bound as w, so it is made once a row
    text = F.when(h % 10 == 0, F.array_join(F.element_at(F.transform(once, repeat), 1), " ")).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(damaged(table(spark, sf_dir, "documents")))
