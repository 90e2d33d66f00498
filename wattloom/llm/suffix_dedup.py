"""Removal of repeated byte strings by per-shard suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else
in the corpus goes. Strings are judged on the input, so all copies go.

Suffix arrays need the strings to be compared in one place. Each window of
LENGTH bytes is owned by the smallest hash among its ``GRAM``-byte substrings;
equal windows have equal owners, so it is enough to compare windows of one
owner. A maximal run of windows with one owner is a segment.

1. One pass over the texts gives the segments as (owner, digest, place); no bytes
   move. Owners with one segment, not repetitive in itself, are done: nothing of
   theirs repeats. So is an owner whose segments are all equal: all of it goes.
2. Of the others, one segment of each digest is fetched and dealt into shards of
   about ``SHARD_BYTES``. A shard sorts its suffixes by Larsson-Sadakane
   refinement in numpy (groups split by the rank a doubling distance ahead, only
   unresolved suffixes touched), and takes common prefixes in the manner of
   Kasai: a prefix is counted only where the bytes before differ, elsewhere it is
   one shorter than at the position before. Windows with a neighbour of LENGTH
   common bytes repeat.
3. An owner with too many bytes for a shard is cut into several. Its shards
   deal 128-bit fingerprints of their windows by fingerprint range; in
   every range each shard's sorted list is looked up in those of the others by
   binary search. So one phrase in a third of all documents spreads over tasks.
4. Covered ranges are merged per document and meet the texts once.

What decides: equal segments (same owner, length and 64-bit digest) repeat each other whole, so
one of them stands for all; an owner whose segments are all equal is decided by that alone.
Every other repeat is found by suffix order within a shard, or by 128-bit
fingerprints and binary search between the shards of a cut owner. Equal segments are not sorted a
second time, since that would sort every copied text's bytes about five times over (segments overlap).

Defined results: null text is the empty string; texts under LENGTH bytes lose
nothing and help no other; rows with equal text repeat each other, with equal, different or no
doc_id; rows of one doc_id with different texts are different documents, and rows without doc_id
count and lose bytes like others, since a document's key is its doc_id with a hash of its text;
a text above ``PIECE_BYTES`` is cut into pieces that overlap by a string; no rows give no rows;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textops as tx
from .common import join_few, leave, scratch, ship, table, written

LENGTH = 200
GRAM = 64
SHARD_BYTES = 1 << 20
PIECE_BYTES = 1 << 22
_PLACE_BITS = np.uint64(24)


def least_in_windows(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every ``size`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= size:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = size - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``text, start, size, owner, digest, twice`` of all segments; start counts from the text's first byte."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    sums = tx.prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    h = tx.span_hash(sums, at, at + gram)
    place = at.astype(np.uint64)
    mask = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    top = h & ~mask
    width = length - gram + 1
    first = (least_in_windows(top | place, width) & mask).astype(np.int64)
    last = (mask - (least_in_windows(top | (mask - place), width) & mask)).astype(np.int64)
    owner = h[first]
    doc = np.searchsorted(off, np.arange(n), side="right") - 1
    whole = np.arange(n) + length <= off[doc + 1]
    cut = np.ones(n, bool)
    cut[1:] = (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], n)
    twice = np.maximum.reduceat((first != last).astype(np.int8), begin).astype(bool) | (end - begin > width)
    full = whole[begin]
    begin, end, twice = begin[full], end[full], twice[full]
    stop = end + length - 1
    return doc[begin], begin - off[doc[begin]], stop - begin, owner[begin], tx.span_hash(sums, begin, stop), twice


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray, int]]:
    """Keys (columns but the second, the text), bytes, offsets and first place of chunks; a text over PIECE_BYTES comes in overlapping pieces."""
    for batch in tx.chunks(batches):
        data, off = tx.text_bytes(batch.column(1))
        ids = [batch.column(0), *batch.columns[2:]]
        if len(data) <= PIECE_BYTES:
            yield ids, data, off, 0
            continue
        for k in range(batch.num_rows):
            text = data[off[k] : off[k + 1]]
            for a in range(0, max(1, len(text) - LENGTH + 1), PIECE_BYTES):
                part = text[a : a + PIECE_BYTES + LENGTH - 1]
                yield [c.slice(k, 1) for c in ids], part, np.array([0, len(part)]), a


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, data, off, base in _pieces(batches):
        doc, start, size, owner, digest, twice = segments(data, off)
        cols = [c.take(pa.array(doc)) for c in ids] + [pa.array(start + base), pa.array(size)]
        cols += [pa.array(owner.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(twice)]
        yield pa.RecordBatch.from_arrays(cols, names=["key", "h", "start", "size", "owner", "digest", "twice"])


def suffix_array(text: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Suffixes of many strings laid end to end in order; ``end[i]``: where the string of byte i stops.

    A string's end sorts before any byte and ends differ by place, so no comparison crosses strings.
    """
    n = len(text)
    left = end - np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        ahead = np.zeros(n, np.uint64)
        ahead[: max(n - k, 0)] = text[k:]
        ahead[left <= k] = 0
        key = (key << np.uint64(8)) | ahead
    sa = np.argsort(key)
    key = key[sa]
    head = np.append(True, key[1:] != key[:-1])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))

    def split(rows: np.ndarray, second: np.ndarray) -> np.ndarray:
        if not len(rows):
            return rows
        order = np.lexsort((second, rank[rows]))
        rows, second = rows[order], second[order]
        group = rank[rows]
        new_group = np.append(True, group[1:] != group[:-1])
        count = np.arange(len(rows))
        place = group + count - np.maximum.accumulate(np.where(new_group, count, 0))
        head = new_group | np.append(True, second[1:] != second[:-1])
        rank[rows] = np.maximum.accumulate(np.where(head, place, 0))
        sa[place] = rows
        alone = head & np.append(head[1:], True)
        return rows[~alone]

    rows = sa[~(head & np.append(head[1:], True))]
    rows = split(rows, np.where(left[rows] <= 8, left[rows] * n + rows, 9 * n))
    step = 8
    while len(rows):
        rows = split(rows, rank[rows + step])
        step *= 2
    return sa


def common_prefixes(text: np.ndarray, end: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position: length of the common prefix with the suffix before it in order, and that suffix."""
    n = len(text)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    prior = np.maximum(before, 1) - 1
    opens = np.ones(n, bool)
    opens[1:] = end[1:] != end[:-1]
    known = (before < 0) | opens | opens[np.maximum(before, 0)]
    known[1:] |= text[:-1] != text[prior[1:]]
    i = np.flatnonzero(known & (before >= 0))
    j = before[i]
    most = np.minimum(end[i] - i, end[j] - j)
    same = np.zeros(n, np.int64)
    length = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    while len(live):
        live = live[length[live] < most[live]]
        size = 1 if len(live) > 50_000 else 64
        ahead = length[live][:, None] + np.arange(size)
        inside = ahead < most[live][:, None]
        a, b = i[live][:, None] + ahead, j[live][:, None] + ahead
        equal = inside & (text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)])
        whole = equal.all(1)
        length[live] += np.where(whole, size, np.argmin(equal, 1))
        live = live[whole]
    same[i] = length
    source = np.maximum.accumulate(np.where(known, place, 0))
    return np.where(before < 0, 0, same[source] - (place - source)), before


def repeated_windows(text: np.ndarray, end: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which positions start a string of ``length`` bytes that starts elsewhere in these strings too."""
    sa = suffix_array(text, end)
    prefix, before = common_prefixes(text, end, sa)
    out = prefix >= length
    out[before[out]] = True
    return out


def _runs(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges covered by strings at sorted ``starts``."""
    if not len(starts):
        return starts, starts
    new = np.append(True, starts[1:] > starts[:-1] + length)
    return starts[new], starts[np.append(new[1:], True)] + length


_COVER = "owner long, digest long, from_byte long, to_byte long, ats array<long>, f1 array<long>, f2 array<long>, shard long"
_COVER_ARROW = pa.schema([("owner", pa.int64()), ("digest", pa.int64()), ("from_byte", pa.int64()), ("to_byte", pa.int64()), ("ats", pa.list_(pa.int64())), ("f1", pa.list_(pa.int64())), ("f2", pa.list_(pa.int64())), ("shard", pa.int64())])


def _shard(rows: pa.Table) -> pa.Table:
    """Covered ranges inside each segment of a shard; for cut owners also fingerprints of its distinct windows."""
    raw = rows.column("bytes").to_pylist()
    owner, digest, cut, n = (rows.column(c).to_numpy() for c in ("owner", "digest", "cut", "n"))
    size = np.array([len(b) for b in raw])
    stop = np.cumsum(size)
    text = np.frombuffer(b"".join(raw), np.uint8)
    hit = repeated_windows(text, np.repeat(stop, size))
    out = []
    for k in range(len(raw)):
        a = stop[k] - size[k]
        covered = (np.array([0]), size[k : k + 1]) if n[k] > 1 else _runs(np.flatnonzero(hit[a : stop[k] - LENGTH + 1]), LENGTH)
        out += [(owner[k], digest[k], x, y, None, None, None, None) for x, y in zip(*covered, strict=True)]
    across = np.flatnonzero(cut > 1)
    if len(across):
        segment = np.repeat(across, size[across] - LENGTH + 1)
        start = (stop - size)[segment]
        at = np.arange(len(segment)) - np.searchsorted(segment, segment)
        sums, p = tx.prefix_hash(text), start + at
        half = tx.span_hash(sums, p, p + LENGTH // 2), tx.span_hash(sums, p + LENGTH // 2, p + LENGTH)
        f1, f2 = tx.mix(half[0] + np.uint64(3) * half[1]), tx.mix(half[0] * np.uint64(5) ^ half[1])
        _, one = np.unique(f1, return_index=True)  # windows that repeat in here are covered; one of each tells the others
        send = ~hit[p]
        send[one] = True
        shard = rows.column("shard")[0].as_py()
        for k in across:
            mine = _slice(segment, send, k)
            if len(mine):
                out.append((owner[k], digest[k], None, None, at[mine], f1[mine].view(np.int64), f2[mine].view(np.int64), shard))
    columns = list(zip(*out, strict=True)) or [[]] * 8
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _COVER_ARROW, strict=True)], schema=_COVER_ARROW)


def _slice(segment: np.ndarray, send: np.ndarray, k: int) -> np.ndarray:
    a, b = np.searchsorted(segment, [k, k + 1])
    return a + np.flatnonzero(send[a:b])


def _merge(rows: pa.Table) -> pa.Table:
    """Of one fingerprint range: windows whose fingerprint a binary search finds outside their own shard's list."""
    f1, f2, shard = (rows.column(c).to_numpy() for c in ("f1", "f2", "shard"))
    order = np.lexsort((f2, f1))
    f1, f2 = f1[order], f2[order]
    number = np.cumsum(np.append(0, (f1[1:] != f1[:-1]) | (f2[1:] != f2[:-1])))  # equal fingerprints, equal number
    value = np.empty(len(order), np.int64)
    value[order] = number
    count = lambda own, among: np.searchsorted(among, own, "right") - np.searchsorted(among, own, "left")
    by_shard = np.lexsort((value, shard))
    cuts = np.flatnonzero(np.append(True, np.diff(shard[by_shard]) != 0))
    hit = []
    for a, b in zip(cuts, np.append(cuts[1:], len(by_shard)), strict=True):
        own = value[by_shard[a:b]]
        hit.append(by_shard[a:b][count(own, number) > count(own, own)])
    return rows.select(["owner", "digest", "at"]).take(pa.array(np.concatenate(hit)))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_bytes, n_removed, n_spans, sha, kept = [], [], [], [], []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw = (text or "").encode()
            at, parts, runs = 0, [], 0
            for r in ranges or ():
                parts.append(raw[at : r["from_byte"]])
                at, runs = r["to_byte"], runs + 1
            parts.append(raw[at:])
            left = b"".join(parts)
            n_bytes.append(len(raw))
            n_removed.append(len(raw) - len(left))
            n_spans.append(runs)
            sha.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        cols = [batch.column(0), *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)), pa.array(sha, pa.string()), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a key of two longs for each document: its doc_id (or a hash of the text) and a hash of the text."""
    return docs.select("doc_id", "text", F.coalesce("doc_id", F.xxhash64(F.lit(1), "text")).alias("key"), F.xxhash64("text").alias("h"))


def covered_ranges(texts: DataFrame) -> DataFrame:
    """``key, h, ranges`` for rows of ``keyed``: the merged byte ranges to remove, in order, of documents that lose any."""
    with scratch(texts.sparkSession):
        return leave(_ranges(texts.select("key", "text", "h")), "ranges")


def _ranges(texts: DataFrame) -> DataFrame:
    found = written(texts.mapInArrow(_segment_rows, "key long, h long, start long, size long, owner long, digest long, twice boolean"), "segments")
    owners = found.groupBy("owner").agg(F.count("*").alias("c"), F.max("twice").alias("t")).where("c > 1 OR t").select("owner")
    found = written(found.join(owners, "owner").select("key", "h", "start", "size", "owner", "digest", "twice"), "repeated")
    kinds = found.groupBy("owner", "digest").agg(
        F.count("*").alias("n"), F.max("size").alias("size"), F.max("twice").alias("twice"), F.min(F.struct("key", "h", "start")).alias("at")
    )
    kinds = written(kinds, "kinds")
    totals = kinds.groupBy("owner").agg(F.count("*").alias("k"), F.sum("size").alias("bytes"), F.max("twice").alias("t"))
    plain = kinds.join(totals.where("k = 1 AND NOT t").select("owner"), "owner").where("n > 1")
    plain = plain.select("owner", "digest", F.lit(0).cast("long").alias("from_byte"), F.col("size").alias("to_byte"))
    mixed = kinds.join(totals.where("k > 1 OR t").select("owner", F.ceil(F.col("bytes") / (SHARD_BYTES // 2)).alias("cut")), "owner")
    mixed = written(mixed.select("owner", "digest", "n", "size", "cut", "at.key", "at.h", "at.start"), "mixed")

    total = mixed.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    wanted = mixed.groupBy("key", "h").agg(F.collect_list(F.struct("owner", "digest", "n", "cut", "start", "size")).alias("wanted"))
    with_text = texts.join(written(wanted, "wanted").hint("shuffle_merge"), ["key", "h"]).select("text", "wanted")
    schema = "owner long, digest long, n long, cut long, bytes binary"
    pieces = with_text.mapInArrow(_fetch, schema).dropDuplicates(["owner", "digest"])
    salt = F.pmod(F.xxhash64("digest"), F.col("cut"))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("owner", salt), F.lit(shards)))
    cover = written(dealt.groupBy("shard").applyInArrow(_shard, _COVER), "cover")
    local = cover.where("from_byte IS NOT NULL").select("owner", "digest", "from_byte", "to_byte")

    prints = cover.where("f1 IS NOT NULL")
    spread = max(1, -(-(prints.agg(F.sum(F.size("f1"))).first()[0] or 0) // (1 << 17)))
    each = prints.select("owner", "digest", "shard", F.explode(F.arrays_zip("ats", "f1", "f2")).alias("f"))
    each = each.select("owner", "digest", "shard", F.col("f.ats").alias("at"), "f.f1", "f.f2")
    across = each.groupBy(F.pmod("f1", F.lit(spread)).alias("part")).applyInArrow(_merge, "owner long, digest long, at long")
    across = across.select("owner", "digest", F.col("at").alias("from_byte"), (F.col("at") + LENGTH).alias("to_byte"))

    ranges = found.join(plain.unionByName(local).unionByName(_islands(across, "owner", "digest")), ["owner", "digest"])
    ranges = ranges.select("key", "h", (F.col("start") + F.col("from_byte")).alias("from_byte"), (F.col("start") + F.col("to_byte")).alias("to_byte"))
    merged = _islands(ranges, "key", "h")
    return merged.groupBy("key", "h").agg(F.sort_array(F.collect_list(F.struct("from_byte", "to_byte"))).alias("ranges"))


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = (text or "").encode()
            rows = [w | {"bytes": raw[w["start"] : w["start"] + w["size"]]} for w in wanted]
            yield pa.RecordBatch.from_pylist(
                rows, schema=pa.schema([("owner", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("cut", pa.int64()), ("bytes", pa.binary())])
            )


def _islands(ranges: DataFrame, *keys: str) -> DataFrame:
    """Overlapping or touching ranges of one key merged."""
    by = Window.partitionBy(*keys).orderBy("from_byte", "to_byte")
    reach = F.max("to_byte").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach >= F.col("from_byte"), 0).otherwise(1)
    run = ranges.withColumn("new", new).withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    out = run.groupBy(*keys, "run").agg(F.min("from_byte").alias("from_byte"), F.max("to_byte").alias("to_byte"))
    return out.drop("run")


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (binary) for every row of ``docs(doc_id, text)``."""
    ship(docs.sparkSession)
    rows = join_few(keyed(docs), covered_ranges(keyed(docs)), ["key", "h"], F.size("ranges") * 2)
    return rows.select("doc_id", "text", "ranges").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).drop("kept")
