"""Quality classifier: random-indexing word vectors, pooled, and a small network.

Every token (a run of letters, of digits or of other marks) owns a sparse random
index vector drawn from its hash. The vector of a word is the sum of the index
vectors of its neighbours, two to each side, over the whole corpus (Sahlgren, "An
introduction to random indexing", 2005). Words share ``BUCKETS`` rows by hash,
so the sums are one fixed table: each task adds up its own in integers and Spark
sums the rows of all tasks, which gives the same table whatever the order.

A document is the mean of its unit word vectors with three more pooled numbers
(the share of neighbours with equal vectors, how concentrated the words are, the
log length). A two-layer numpy network is fitted on a bounded sample of
labelled rows, and a temperature on a part of it that the fit has not seen.

Defined results: null and empty texts pool to zeros and are scored as such;
without both classes in the labels every score is the base rate (0.5 if there
are none); a doc_id that repeats among the labels counts once, with its largest label; rows that
repeat a doc_id are scored row by row, and learnt from by one row; a null doc_id is scored
like any other, is not held out and not learnt from; a very long text is read whole, as a chunk of
its own; equal texts have equal scores; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as tx
from .common import learnable, ship, table
from .quality_rules import labelled

SAMPLE_ROWS = 8_000
BUCKETS = 8_192
DIMENSIONS = 64
NEAR = 2
MARKS_PER_INDEX = 2
HIDDEN = 32
EPOCHS = 60
GOOD_AT = 0.3

_CLASS = np.full(256, 3, np.uint8)
_CLASS[tx.SPACE] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """64-bit hashes of all tokens and their text index; the number of texts."""
    data, off = tx.text_bytes(texts)
    kind = _CLASS[data]
    turn = np.ones(len(data) + 1, bool)
    turn[1:-1] = kind[1:] != kind[:-1]
    turn[off] = True
    at = np.flatnonzero(turn)
    starts, ends = at[:-1], at[1:]
    full = (ends > starts) & (kind[np.minimum(starts, max(len(kind) - 1, 0))] > 0) if len(kind) else np.zeros(0, bool)
    starts, ends = (starts[full], ends[full]) if len(kind) else (starts[:0], ends[:0])
    doc = np.searchsorted(off, starts, side="right") - 1
    return tx.span_hash(tx.prefix_hash(data), starts, ends), doc, len(off) - 1


def _accumulate(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets * DIMENSIONS, np.int64)
    for batch in tx.chunks(batches):
        h, doc, _ = tokens(batch.column(0))
        row = (h % buckets).astype(np.int64) * DIMENSIONS
        marks = [((h >> np.uint64(20 + 8 * k)) % DIMENSIONS).astype(np.int64) for k in range(MARKS_PER_INDEX)]
        signs = [1 - 2 * ((h >> np.uint64(50 + k)) & np.uint64(1)).astype(np.int64) for k in range(MARKS_PER_INDEX)]
        up, down = [], []
        for step in range(1, NEAR + 1):
            same = doc[step:] == doc[:-step]
            for mark, sign in zip(marks, signs, strict=True):
                for me, other in ((slice(step, None), slice(None, -step)), (slice(None, -step), slice(step, None))):
                    cell, positive = (row[me] + mark[other])[same], sign[other][same] > 0
                    up.append(cell[positive])
                    down.append(cell[~positive])
        for cells, sign in ((up, 1), (down, -1)):
            total += sign * np.bincount(np.concatenate(cells), minlength=len(total))
    rows = total.reshape(buckets, DIMENSIONS)
    used = np.flatnonzero(rows.any(1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), *(pa.array(np.ascontiguousarray(rows[used, k])) for k in range(DIMENSIONS))],
        names=["bucket", *(f"v{k}" for k in range(DIMENSIONS))],
    )


def word_vectors(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """``buckets`` x DIMENSIONS unit vectors from all texts of ``docs``: a table of fixed size."""
    schema = ", ".join(["bucket long", *(f"v{k} long" for k in range(DIMENSIONS))])
    parts = docs.select("text").mapInArrow(lambda it: _accumulate(it, buckets), schema)
    rows = parts.groupBy("bucket").agg(*(F.sum(f"v{k}").alias(f"v{k}") for k in range(DIMENSIONS))).toPandas()
    vectors = np.zeros((buckets, DIMENSIONS))
    vectors[rows["bucket"].to_numpy(int)] = rows[[f"v{k}" for k in range(DIMENSIONS)]].to_numpy(float)
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(size, 1)).astype(np.float32)


def pool(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row of DIMENSIONS + 3 features for each text."""
    h, doc, n = tokens(texts)
    bucket = (h % len(vectors)).astype(np.int64)
    count = np.bincount(doc, minlength=n)
    safe = np.maximum(count, 1)
    out = np.zeros((n, vectors.shape[1] + 3), np.float32)
    cells, times = np.unique(doc * len(vectors) + bucket, return_counts=True)
    of, share = cells // len(vectors), (times / safe[cells // len(vectors)]).astype(np.float32)
    for a in range(0, len(cells), 1 << 15):
        part = slice(a, a + (1 << 15))
        cut = np.flatnonzero(np.append(True, of[part][1:] != of[part][:-1]))
        out[of[part][cut], :-3] += np.add.reduceat(vectors[cells[part] % len(vectors)] * share[part, None], cut, axis=0)
    out[:, -2] = np.sqrt(np.bincount(of, share * share, n))
    if len(doc) > 1:
        equal = (bucket[1:] == bucket[:-1]) & (doc[1:] == doc[:-1])
        out[:, -3] = np.bincount(doc[1:][equal], minlength=n) / safe
    out[:, -1] = np.log1p(count)
    return out


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
    """Two layers by Adam on four fifths of the rows, a temperature on the rest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    fit, rest = order[len(y) // 5 :], order[: len(y) // 5]
    mean, spread = x[fit].mean(0), x[fit].std(0) + 1e-3
    z = ((x - mean) / spread).astype(np.float64)
    p = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    for _ in range(EPOCHS):
        mixed = rng.permutation(fit)
        for at in range(0, len(mixed), 128):
            rows = mixed[at : at + 128]
            hidden = np.tanh(z[rows] @ p[0] + p[1])
            err = (1 / (1 + np.exp(-(hidden @ p[2] + p[3]))) - y[rows]) / len(rows)
            back = np.outer(err, p[2]) * (1 - hidden**2)
            grads = [z[rows].T @ back + 1e-4 * p[0], back.sum(0), hidden.T @ err + 1e-4 * p[2], err.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(grads):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] -= 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = {"mean": mean, "spread": spread, "w1": p[0], "b1": p[1], "w2": p[2], "b2": p[3], "heat": np.array(1.0)}
    if len(rest):
        logit = _logit(net, x[rest])
        heats = np.geomspace(0.25, 8, 41)
        loss = [np.logaddexp(0, np.where(y[rest] > 0, -logit, logit) / t).mean() for t in heats]
        net["heat"] = np.array(heats[int(np.argmin(loss))])
    return net


def _logit(net: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.tanh(((x - net["mean"]) / net["spread"]) @ net["w1"] + net["b1"]) @ net["w2"] + net["b2"]


def score(net: dict[str, np.ndarray] | float, x: np.ndarray) -> np.ndarray:
    if isinstance(net, float):
        return np.full(len(x), net)
    return 1 / (1 + np.exp(-np.clip(_logit(net, x) / net["heat"], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, spread, sample: int = SAMPLE_ROWS) -> dict[str, np.ndarray] | float:
    """The network from at most ``sample`` documents labelled in ``labels(doc_id, quality)``, chosen by hash."""
    rows = learnable(docs, labels, "quality", sample).select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            x = pool(batch.column(2), spread.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))],
                names=["doc_id", "quality", "x"],
            )

    got = rows.mapInArrow(run, "doc_id long, quality int, x array<float>").toPandas().sort_values("doc_id", kind="stable")
    y = got["quality"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    return fit_network(np.stack(got["x"].to_numpy()), y)


def classify(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, score`` for every row of ``docs(doc_id, text)``; ``buckets``: rows of the table of word vectors."""
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    spread = context.broadcast(word_vectors(docs, buckets))
    net = context.broadcast(fit(docs, labels, spread))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            p = score(net.value, pool(batch.column(1), spread.value)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classify(table(spark, sf_dir, "documents"), labelled(spark, sf_dir))
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 5).eqNullSafe(0)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD_AT).cast("int").alias("predicted"))
