"""Quality rules: gradient-boosted trees over document statistics.

One Arrow pass computes the statistics of every whole text in numpy. The trees
(logistic loss, histogram splits) are fitted on the driver from a bounded sample
of labelled statistics, at most ``SAMPLE_ROWS`` rows; features listed in
``MONOTONE`` may move the score one way only: a split is refused if its child
values are out of order, and the bound between them is handed down to both
subtrees. The fitted forest is flattened to node arrays of fixed size
(``TREES`` x 2^(DEPTH+1)) and scores a batch a level at a time.

A base rule comes first: fewer than 50 words, or more than half of the words in
three-word windows found twice or more, fails a text whatever the trees say.

Defined results: null and empty texts have no word and fail the base rule; without any
labelled row, or only one class, the base rule alone decides; a doc_id that repeats among the
labels counts once, with its largest label; rows that repeat a doc_id are scored row by row,
and learnt from by one row; a null doc_id is scored like any other and not learnt from;
a very long text is read whole, as a chunk of its own; no rows give no rows; equal texts have
equal scores; other columns are ignored, or passed through when named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as tx
from .common import free_names, learnable, ship, table

SAMPLE_ROWS = 10_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.2
LEAST_IN_LEAF = 20
KEEP_AT = 0.5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share", "mark_share", "words_a_line", "same_neighbour_share", "bare_symbol_share"]
#: -1: more of it never raises the score; 1: more of it never lowers it.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "same_neighbour_share": -1, "bare_symbol_share": -1}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[list(b"!?;:()[]{}\"'=+_~^@/\\")] = True


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Integer columns ``BASE`` and float columns ``FEATURES`` for each text."""
    data, off = tx.text_bytes(texts)
    n_texts = len(off) - 1
    count = lambda doc, flag=None: np.bincount(doc if flag is None else doc[flag], minlength=n_texts)
    starts, ends, doc = tx.words(data, off)
    sums = tx.prefix_hash(data)
    word = tx.span_hash(sums, starts, ends)
    n_words = count(doc)

    three = np.zeros(len(word), bool)
    if len(word) > 2:
        inside = doc[2:] == doc[:-2]
        twice = np.zeros(len(word) - 2, bool)
        twice[inside], _ = tx.repeated(doc[:-2][inside], tx.window_hash(word, 3)[inside])
        for k in range(3):
            three[k : len(word) - 2 + k] |= twice
    _, again = tx.repeated(doc, word)
    next_same = np.zeros(len(word), bool)
    if len(word) > 1:
        next_same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])

    l_starts, l_ends, l_doc = tx.lines(data, off)
    at = np.searchsorted(starts, l_starts)
    full = at < np.searchsorted(starts, l_ends)
    l_starts, l_ends, l_doc = l_starts[full], l_ends[full], l_doc[full]
    _, line_again = tx.repeated(l_doc, tx.span_hash(sums, l_starts, l_ends))

    solid = ~tx.SPACE[data]
    chars = tx.per_text(solid & ((data & 0xC0) != 0x80), off)
    symbols = tx.per_text(_SYMBOL[data], off)
    symbol_sums = np.append(0, np.cumsum(_SYMBOL[data]))
    bare = (symbol_sums[ends] - symbol_sums[starts]) * 2 > ends - starts
    base = np.stack([n_words, chars, symbols, count(l_doc, line_again), count(doc, three)], 1).astype(np.int64)
    w, c, ln = np.maximum(n_words, 1), np.maximum(chars, 1), np.maximum(count(l_doc), 1)
    features = np.stack(
        [
            np.log1p(n_words), chars / w, symbols / c, base[:, 3] / ln, base[:, 4] / w, 1 - count(doc, again) / w,
            tx.per_text(_UPPER[data], off) / c, tx.per_text(_DIGIT[data], off) / c, tx.per_text(_MARK[data], off) / c,
            n_words / ln, count(doc, next_same) / w, count(doc, bare) / w,
        ],
        1,
    )
    return base, features


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int]) -> dict[str, np.ndarray]:
    """A boosted forest as node arrays: ``feature`` (-1: leaf), ``cut``, ``value``, each TREES x nodes, and ``start``."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(x.shape[1])], 1)
    nodes = 2 ** (DEPTH + 1) - 1
    feature, cut, value = np.full((TREES, nodes), -1), np.zeros((TREES, nodes)), np.zeros((TREES, nodes))
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    margin = np.full(len(y), start)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), int)
        low, high = np.full(nodes, -np.inf), np.full(nodes, np.inf)
        for node in range(nodes):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            value[t, node] = np.clip(gs / (hs + 1), low[node], high[node])
            if 2 * node + 2 >= nodes or len(rows) < 2 * LEAST_IN_LEAF:
                continue
            best = (1e-4, -1, 0, 0.0, 0.0)
            for f, sign in enumerate(signs):
                if not len(cuts[f]):
                    continue
                b = binned[rows, f]
                size = len(cuts[f]) + 1
                gl, hl, nl = (np.cumsum(np.bincount(b, v, size))[:-1] for v in (g[rows], h[rows], np.ones(len(rows))))
                vl = np.clip(gl / (hl + 1), low[node], high[node])
                vr = np.clip((gs - gl) / (hs - hl + 1), low[node], high[node])
                gain = (gl * vl - (hl + 1) * vl * vl / 2) + ((gs - gl) * vr - (hs - hl + 1) * vr * vr / 2)
                gain -= gs * value[t, node] - (hs + 1) * value[t, node] ** 2 / 2
                gain[(nl < LEAST_IN_LEAF) | (len(rows) - nl < LEAST_IN_LEAF) | (sign * (vr - vl) < 0)] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], f, k, vl[k], vr[k])
            _, f, k, vl, vr = best
            if f < 0:
                continue
            feature[t, node], cut[t, node] = f, cuts[f][k]
            left, right = 2 * node + 1, 2 * node + 2
            at[rows] = np.where(binned[rows, f] <= k, left, right)
            low[[left, right]], high[[left, right]] = low[node], high[node]
            if signs[f]:
                lower, upper = (left, right) if signs[f] > 0 else (right, left)
                high[lower] = low[upper] = (vl + vr) / 2
        margin += RATE * value[t, at]
    return {"feature": feature, "cut": cut, "value": RATE * value, "start": np.array(start)}


def score_trees(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Probability of the good class for each row of features."""
    tree, row = np.arange(len(forest["feature"]))[:, None], np.arange(len(x))
    at = np.zeros((len(tree), len(x)), int)
    for _ in range(DEPTH):
        f = forest["feature"][tree, at]
        right = x[row, np.maximum(f, 0)] > forest["cut"][tree, at]
        at = np.where(f < 0, at, 2 * at + 1 + right)
    return 1 / (1 + np.exp(-(forest["start"] + forest["value"][tree, at].sum(0))))


_STATS = ", ".join(["doc_id long, quality int", *(f"{c} long" for c in BASE), *(f"{c} double" for c in FEATURES)])


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tx.chunks(batches):
        base, x = statistics(batch.column(1))
        cols = [batch.column(0), batch.column(2), *(pa.array(c) for c in base.T), *(pa.array(c) for c in x.T)]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "quality", *BASE, *FEATURES])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> dict[str, np.ndarray] | None:
    """The forest from at most ``sample`` documents labelled in ``labels(doc_id, quality)``, chosen by hash; None without both classes."""
    got = learnable(docs, labels, "quality", sample).select("doc_id", "text", "quality").mapInArrow(_stats, _STATS).toPandas().sort_values("doc_id")
    y = got["quality"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    return fit_trees(got[FEATURES].to_numpy(float), y, [MONOTONE.get(f, 0) for f in FEATURES])


def judge(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``columns`` of it passed through, ``BASE``, ``base_failed``, ``score`` and ``kept``.

    A made column whose name is among ``columns`` gets underscores in front until it is free.
    """
    ship(docs.sparkSession)
    columns = columns or ["doc_id"]
    forest = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    kinds = dict(docs.dtypes)
    carried = docs.select(*dict.fromkeys([*columns, "text"]))
    names = carried.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            base, x = statistics(batch.column(names.index("text")))
            failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
            p = score_trees(forest.value, x) if forest.value else np.ones(len(x))
            cols = [batch.column(names.index(c)) for c in columns] + [pa.array(c) for c in base.T]
            cols += [pa.array(failed), pa.array(p), pa.array(~failed & (p >= KEEP_AT))]
            yield pa.RecordBatch.from_arrays(cols, names=[*columns, *made])

    made = free_names([*BASE, "base_failed", "score", "kept"], columns)
    types = ["long"] * len(BASE) + ["boolean", "double", "boolean"]
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in columns] + [f"{c} {k}" for c, k in zip(made, types, strict=True)])
    return carried.mapInArrow(run, schema)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that may be learnt from; the rest is held out."""
    return table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), labelled(spark, sf_dir))
