"""Whole-batch text statistics in numpy.

Texts arrive as Arrow columns inside Spark tasks. Everything here works on the
UTF-8 bytes of many texts at once, in chunks of about half a megabyte, so that
memory per task stays bounded however many rows a batch has.

A word is a maximal run of bytes other than space and 0x09-0x0D, as the
pattern ``[^\\x20\\x09-\\x0D]+`` finds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: One random 64-bit value for each byte, fixed by the seed.
CODES = np.random.RandomState(20240131).randint(0, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_CODES = CODES[LOWER]

_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, CHUNK_BYTES) + 1, base, np.uint64)
        step[0] = 1
        _powers[base] = have = np.cumprod(step)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
            yield batch.slice(at, min(to, batch.num_rows) - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end and the n + 1 offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(off), np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def spans(off: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs where ``gap`` is false, never across texts: starts, ends, text index."""
    n = len(gap)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(off, SPACE[data])


def lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All newline-split lines, empty ones too; a text of no bytes has one empty line."""
    cut = np.flatnonzero(data == 10)
    of = np.searchsorted(off, cut, side="right") - 1
    starts = np.concatenate([off[:-1], cut + 1])
    doc = np.concatenate([np.arange(len(off) - 1), of])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    ends = np.empty_like(starts)
    last = np.append(doc[1:] != doc[:-1], True)[: len(doc)]
    ends[:-1] = starts[1:] - 1
    ends[last] = off[doc[last] + 1]
    return starts, ends, doc


def prefix_hash(data: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
    """Running polynomial sums from which ``span_hash`` reads the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * _power(_BASE, len(data))[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    back = _power(pow(_BASE, -1, 2**64), len(sums))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def window_hash(values: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` consecutive values."""
    n = max(0, len(values) - size + 1)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + values[k : k + n]
    return mix(out)


def per_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of byte-level ``values`` in each text."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[off[1:]] - sums[off[:-1]]


def repeated(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: does its hash occur twice or more in its text; is it a later occurrence."""
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, bool)
    keys = mix(hashes + doc.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[1:] = keys[order][1:] == keys[order][:-1]
    twice = again.copy()
    twice[:-1] |= again[1:]
    out, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    out[order], later[order] = twice, again
    return out, later
