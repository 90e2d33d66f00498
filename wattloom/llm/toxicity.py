"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM over labelled sentences.

A sentence is split into windows of ``WINDOW`` words, so that an insult is no
small part of what is compared. The kernel of two windows is the gap-weighted
subsequence kernel (Lodhi et al., "Text classification using string kernels",
2002) of length four within six letters: every four letters in order that span
at most six count ``DECAY ** gaps``, so an inserted or missing letter leaves
most of the common subsequences in place. Words are lower-cased and lose
everything but letters (``i-d.i_o t`` reads as one word, as do single letters in
a row); one mark stands between words and counts as a letter, so subsequences
reach over words. Subsequences are hashed to ``2 ** TABLE_BITS`` features, and the
kernel is divided by both windows' lengths in subsequences.

Labels are on texts: every window of a clean text is clean, some of a toxic text
are toxic. Which ones is learnt along (multiple-instance learning, Andrews et
al., "Support vector machines for multiple-instance learning", 2003). The first
guess scores a window by how much more often its subsequences are in other
toxic texts than in clean ones, counted by Spark over all sampled texts. In every
round the windows of toxic texts that score above all but ``CLEAN_ABOVE`` of the
clean ones, and the best one of each text, are the toxic rows, and a
squared-hinge SVM is fitted by Newton steps to them and the clean rows, in the space that
``K(landmarks)^-1/2`` maps a window to. Landmarks are drawn from both classes, each by its
distance from those before. Each row comes along with an altered spelling of itself, in both
classes. The decision is a sum of kernels with landmarks, hence linear in the
subsequences, and is folded into one table of their weights: scoring needs no
landmark and gives the same number. A text's score is a logistic curve, fitted on
labelled texts, of its margins at some ranks from the top and how many of its windows pass some margins.

Bounded samples: ``SAMPLE_TEXTS`` labelled texts and, of their windows, ``TEXT_ROWS`` a text and ``SAMPLE_ROWS`` a class for the
SVM, all chosen by hash (within a toxic text by the first guess).

Defined results: null texts and texts without letters are scored at the lowest margin and no
words; without both classes among the labels every score is the base rate (0 if
there are none); a doc_id that repeats among the labels counts once, toxic if any
of its labels is; rows that repeat a doc_id are scored row by row, and learnt from by one row; a null
doc_id is scored like any other, is not held out and not learnt from; very long texts are read whole, a
text at a time beyond a chunk; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as tx
from .common import learnable, scratch, ship, table, written

#: Labelled texts that the curve is fitted on; windows of each class and landmarks of each class for the SVM.
SAMPLE_TEXTS = 8_000
SAMPLE_ROWS = 6_000
LANDMARKS = 256
WINDOW = 2
TEXT_ROWS = 16
ROUNDS = 3
RIDGE = 0.2
GROUP = 4_096
#: Features that meet the landmarks at a time: their values fit the processor's cache.
CELLS = 256
#: The share of clean windows above which a window of a toxic text counts as toxic.
CLEAN_ABOVE = 0.0005
DECAY = 0.6
SPAN = 6
TABLE_BITS = 18
LOWEST, HIGHEST = -3.0, 3.0
STEPS = (-0.5, 0.0, 0.5, 1.0)
RANKS = (1, 2, 3, 4, 6, 8)
FEATURES = 1 + len(RANKS) + len(STEPS)

_LETTER = np.array([chr(c).isalpha() for c in range(0x3000)])
_SPACE = [9, 10, 11, 12, 13, 32]
_MARK = 32
_SHAPES = [(a, b, c, DECAY ** (c - 3)) for a, b, c in combinations(range(1, SPAN), 3)]
_AT = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_TOP = np.uint64(64 - TABLE_BITS)


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A stream of all words' letters, each word behind a mark, begin and end in it of every window, and the window's text index.

    A window includes the mark after its last word; a sentence of fewer than WINDOW words is one window.
    """
    low = [(t or "").lower() for t in texts.to_pylist()]
    text = np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32)
    off = np.append(0, np.cumsum([len(t) for t in low]))
    starts, ends, doc = tx.spans(off, np.isin(text, _SPACE))
    keep = np.flatnonzero(_LETTER[np.minimum(text, len(_LETTER) - 1)] | (text >= len(_LETTER)))
    word = np.searchsorted(starts, keep, side="right") - 1
    if not len(word):
        return np.zeros(0, np.uint32), *(np.zeros(0, np.int64),) * 3
    breaks = np.append(0, np.cumsum(text == 10))
    new = np.ones(len(starts), bool)
    new[1:] = (doc[1:] != doc[:-1]) | np.isin(text[ends[:-1] - 1], [33, 46, 63]) | (breaks[starts[1:]] > breaks[ends[:-1]])
    sentence = np.cumsum(new)
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    of, sentence, size = doc[word[first]], sentence[word[first]], np.diff(np.append(first, len(word)))
    head = np.ones(len(first), bool)
    head[1:] = ~((size[1:] == 1) & (size[:-1] == 1) & (of[1:] == of[:-1]))
    at, of, sentence = np.append(first[head], len(word)), of[head], sentence[head]
    n = len(of)
    place = at + np.arange(n + 1)
    stream = np.full(len(keep) + n + 1, _MARK, np.uint32)
    stream[np.arange(len(keep)) + np.repeat(np.arange(1, n + 1), np.diff(at))] = text[keep]
    opens = np.append(True, sentence[1:] != sentence[:-1])
    last = np.append(np.flatnonzero(opens)[1:], n) - 1
    final = np.repeat(last, np.diff(np.append(-1, last)))
    to = np.arange(n) + WINDOW - 1
    use = np.flatnonzero((to <= final) | opens)
    return stream, place[use], place[np.minimum(to, final)[use] + 1] + 1, of[use]


def hashed(stream: np.ndarray) -> Iterator[tuple[np.ndarray, int, float]]:
    """For each shape of subsequence: the feature at every place of the stream where it fits, its reach and its weight."""
    s = stream.astype(np.uint64)
    letters = [s * k for k in _AT]
    for a, b, c, w in _SHAPES:
        n = max(len(s) - c, 0)
        h = letters[0][:n] + letters[1][a : a + n]
        h += letters[2][b : b + n]
        h += letters[3][c : c + n]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        yield (h >> _TOP).astype(np.int64), c, w


def length_norm(size: np.ndarray) -> np.ndarray:
    """A window's length in weighted subsequences, from its letters and marks."""
    total = sum(w * w * np.maximum(size - c, 0) for _, _, c, w in _SHAPES)
    return np.sqrt(np.maximum(total, 1e-9))


def margins(stream: np.ndarray, begin: np.ndarray, end: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """The SVM's decision for each window, from the folded table."""
    total = np.zeros(len(begin))
    for feature, c, w in hashed(stream):
        sums = np.zeros(len(feature) + 1)
        np.cumsum(weights[feature], out=sums[1:])
        total += w * (sums[np.minimum(np.maximum(end - c, begin), len(feature))] - sums[np.minimum(begin, len(feature))])
    return np.where(end - begin > 3, bias + total / length_norm(end - begin), LOWEST)


def text_features(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """The margins of the windows at RANKS from the top, log counts of windows above each of STEPS and of all windows."""
    n = len(texts)
    stream, begin, end, doc = windows(texts)
    out = np.zeros((n, FEATURES))
    out[:, : len(RANKS)] = LOWEST
    if len(doc):
        margin = np.clip(margins(stream, begin, end, weights, bias), LOWEST, HIGHEST)
        order = np.lexsort((-margin, doc))
        first = np.searchsorted(doc, np.arange(n + 1))
        for k, rank in enumerate(RANKS):
            has = first[1:] - first[:-1] >= rank
            out[has, k] = margin[order[first[:-1][has] + rank - 1]]
        for k, step in enumerate(STEPS):
            out[:, len(RANKS) + k] = np.log1p(np.bincount(doc, margin > step, n))
        out[:, -1] = np.log1p(np.bincount(doc, minlength=n))
    return out


def altered(row: str) -> str:
    """The window with one inner letter of every longer word doubled, or missing from five letters on."""
    out = []
    for k, word in enumerate(row.split(" ")):
        n = len(word)
        at = 1 + (7 * n + 3 * k + ord(word[0])) % (n - 2) if n > 3 else 0
        out.append(word if n <= 3 else word[:at] + word[at] + word[at:] if (n + ord(word[-1])) % 2 or n < 5 else word[:at] + word[at + 1 :])
    return " ".join(out)


class Rows:
    """Sparse normalised features of many windows, sorted by row: ``row, column, value``."""

    def __init__(self, rows: list[str]):
        self.n = len(rows)
        parts = [self._cells(rows[a : a + GROUP], a) for a in range(0, len(rows), GROUP)]
        self.row, self.column, self.value = (np.concatenate(x) for x in zip(*parts, strict=True))

    @staticmethod
    def _cells(rows: list[str], base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(r) for r in rows], np.int64)
        end = np.cumsum(size)
        stream, begin = np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32), end - size
        norm = length_norm(size)
        key, value = [], []
        for feature, c, w in hashed(stream):
            count = np.maximum(size - c, 0)
            of = np.repeat(np.arange(len(rows)), count)
            place = begin[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            key.append(of * (1 << TABLE_BITS) + feature[place])
            value.append(w / norm[of])
        cells, which = np.unique(np.concatenate(key), return_inverse=True)
        value = np.bincount(which, np.concatenate(value), len(cells)).astype(np.float32)
        return (cells >> TABLE_BITS).astype(np.int32) + np.int32(base), (cells & ((1 << TABLE_BITS) - 1)).astype(np.int32), value

    def spread(self, among: np.ndarray, n: int) -> np.ndarray:
        """At most ``n`` of the given rows as landmarks, each drawn by how far the rows are from those drawn before (incomplete Cholesky)."""
        place = np.full(self.n, -1)
        place[among] = np.arange(len(among))
        mine = place[self.row] >= 0
        row, column, value = place[self.row[mine]], self.column[mine], self.value[mine]
        far = np.bincount(row, value * value, len(among))
        least, drawn, factor = 1e-6 * far.max(), [], np.zeros((len(among), n))
        buffer, rng = np.zeros(1 << TABLE_BITS), np.random.default_rng(3)
        for k in range(min(n, len(among))):
            if far.max() <= least:
                break
            i = int(np.searchsorted(np.cumsum(far), rng.random() * far.sum()))
            own = row == i
            buffer[column[own]] = value[own]
            line = np.bincount(row, buffer[column] * value, len(among)) - factor @ factor[i]
            buffer[column[own]] = 0
            factor[:, k] = line / np.sqrt(max(far[i], least))
            far = np.maximum(far - factor[:, k] ** 2, 0)
            drawn.append(among[i])
        return np.array(drawn)

    def kernel(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Kernel of all rows with the rows ``marks``; the features of those and their dense values."""
        place = np.full(self.n, -1)
        place[marks] = np.arange(len(marks))
        mine = place[self.row] >= 0
        ids = np.unique(self.column[mine])
        dense = np.zeros((len(ids), len(marks)), np.float32)
        at = np.minimum(np.searchsorted(ids, self.column), len(ids) - 1)
        known = ids[at] == self.column
        dense[at[mine], place[self.row[mine]]] = self.value[mine]
        seen = np.flatnonzero(known)
        out = np.zeros((self.n, len(marks)), np.float32)
        for a in range(0, len(seen), CELLS):
            part = seen[a : a + CELLS]
            row = self.row[part]
            cut = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            out[row[cut]] += np.add.reduceat(dense[at[part]] * self.value[part, None], cut, axis=0)
        return out, ids, dense


def pick(score: np.ndarray, toxic: np.ndarray, bag: np.ndarray) -> np.ndarray:
    """The rows of toxic texts that are taken for toxic: above nearly all clean rows, or the best of their text."""
    chosen = toxic & (score > np.quantile(score[~toxic], 1 - CLEAN_ABOVE))
    order = np.lexsort((score, bag))
    best = order[np.append(bag[order][1:] != bag[order][:-1], True)]
    chosen[best[toxic[best]]] = True
    return chosen


def fit_rows(raw: list[str], toxic: np.ndarray, bag: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, float]:
    """The folded table of subsequence weights and the bias, from windows, whether their text is toxic, their text and a first score."""
    n = len(raw)
    rows = Rows(raw + [altered(r) for r in raw])
    label = np.tile(toxic, 2)
    chosen = pick(guess, toxic, bag)
    marks = np.concatenate([rows.spread(np.flatnonzero(chosen), LANDMARKS), rows.spread(np.flatnonzero(~toxic), LANDMARKS)])
    kernel, ids, dense = rows.kernel(marks)
    values, vectors = np.linalg.eigh(kernel[marks].astype(float))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    kernel = kernel @ root.astype(np.float32)
    for _ in range(ROUNDS):
        use = np.flatnonzero(np.tile(chosen | ~toxic, 2))
        coef = squared_hinge(kernel, use, np.where(label[use], 1.0, -1.0))
        chosen = pick(kernel[:n] @ coef[:-1] + coef[-1], toxic, bag)
    weights = np.zeros(1 << TABLE_BITS)
    weights[ids] = dense @ (root @ coef[:-1])
    return weights, float(coef[-1])


def squared_hinge(x: np.ndarray, use: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A linear SVM with squared hinge loss by Newton steps on the rows ``use`` of ``x``, the constant last; both classes weigh the same."""
    cost = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    coef = np.zeros(x.shape[1] + 1)
    ridge = np.eye(len(coef)) * RIDGE
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        square, target = ridge.copy(), np.zeros(len(coef))
        for a in range(0, len(use), GROUP):
            part = slice(a, a + GROUP)
            z = np.hstack([x[use[part]].astype(float), np.ones((len(use[part]), 1))])
            active = y[part] * (z @ coef) < 1
            z, weighted = z[active], z[active] * cost[part][active, None]
            square += weighted.T @ z
            target += weighted.T @ y[part][active]
        new = np.linalg.solve(square, target)
        if np.abs(new - coef).max() < 1e-7:
            break
        coef = new
    return coef


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic regression on text features, the last one constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    coef = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(coef))
        coef = coef + np.clip(np.linalg.solve(hess, x.T @ (y - p) - 1e-2 * coef), -2, 2)
    return coef


def curve(coef: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ coef[:-1] + coef[-1], -30, 30)))


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean texts of the task each subsequence is."""
    counts = np.zeros((2, 1 << TABLE_BITS), np.int64)
    for batch in tx.chunks(batches):
        label = np.asarray(batch.column(2))
        for k in range(batch.num_rows):
            stream, begin, _, _ = windows(batch.column(1).slice(k, 1))
            if len(begin):
                seen = np.zeros(1 << TABLE_BITS, bool)
                for feature, _, _ in hashed(stream):
                    seen[feature] = True
                counts[int(label[k])] += seen
    used = np.flatnonzero(counts.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[1, used]), pa.array(counts[0, used])], names=["feature", "t", "c"])


def evidence(t: np.ndarray, c: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Signed squared distance of two shares, in standard errors: how much a subsequence in t toxic and c clean texts speaks for toxic."""
    t, c = np.maximum(t, 0), np.maximum(c, 0)
    both = np.clip((t + c) / (n_toxic + n_clean), 1e-9, 1 - 1e-9)
    z = (t / n_toxic - c / n_clean) / np.sqrt(both * (1 - both) * (1 / n_toxic + 1 / n_clean))
    return z * np.abs(z)


def _window_rows(batches: Iterator[pa.RecordBatch], guess: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``doc_id, toxic, row, guess, h`` of TEXT_ROWS windows of each labelled text: those of the best guess if it is toxic, random ones if it is clean.

    ``guess`` has the weights for clean and for toxic texts, each without the text's own share.
    """
    for batch in tx.chunks(batches):
        for label in (0, 1):
            part = batch.filter(pa.array(np.asarray(batch.column(2)) == label))
            stream, begin, end, doc = windows(part.column(1))
            if not len(doc):
                continue
            score = margins(stream, begin, end, guess[label], 0.0)
            raw, ids = stream.tobytes().decode("utf-32-le"), np.asarray(part.column(0))
            h = tx.mix(tx.mix(ids[doc].view(np.uint64)) + (begin - begin[np.searchsorted(doc, doc)]).astype(np.uint64))
            order = np.lexsort((h, -score if label else h, doc))
            use = order[np.arange(len(doc)) - np.searchsorted(doc, doc) < TEXT_ROWS]
            rows = pa.array([raw[a:b] for a, b in zip(begin[use], end[use], strict=True)], pa.string())
            at = pa.array(doc[use])
            cols = [part.column(0).take(at), part.column(2).take(at), rows, pa.array(score[use]), pa.array(h[use].view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "toxic", "row", "guess", "h"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_TEXTS, rows: int = SAMPLE_ROWS):
    """``(table, bias, coefficients)`` from labelled texts, or the base rate."""
    texts = written(learnable(docs, labels, "toxic", sample).select("doc_id", "text", "toxic"), "toxic-texts")
    n, n_bad = texts.agg(F.count("*"), F.sum("toxic")).first()
    if not n_bad or n_bad == n:
        return float((n_bad or 0) / max(n, 1))
    seen = texts.mapInArrow(_presence, "feature long, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).toPandas()
    t, c = np.zeros((2, 1 << TABLE_BITS))
    t[seen["feature"]], c[seen["feature"]] = seen["t"], seen["c"]
    guess = docs.sparkSession.sparkContext.broadcast(np.stack([evidence(t, c - 1, n_bad, n - n_bad), evidence(t - 1, c, n_bad, n - n_bad)]))
    every = written(texts.mapInArrow(lambda it: _window_rows(it, guess.value), "doc_id long, toxic int, row string, guess double, h long"), "toxic-windows")
    some = [every.where(F.col("toxic") == k).orderBy("h", "doc_id", "row").limit(rows) for k in (1, 0)]
    got = some[0].unionByName(some[1]).toPandas()
    toxic = got["toxic"].to_numpy() == 1
    if toxic.all() or not toxic.any():
        return float(n_bad / n)
    weights, bias = fit_rows(list(got["row"]), toxic, np.unique(got["doc_id"], return_inverse=True)[1], got["guess"].to_numpy())
    spread = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            x = text_features(batch.column(1), *spread.value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T.copy()), batch.column(2), batch.column(0)], names=[*names, "toxic", "doc_id"])

    names = [f"x{k}" for k in range(FEATURES)]
    schema = ", ".join([f"{c} double" for c in names] + ["toxic int", "doc_id long"])
    got = texts.mapInArrow(run, schema).toPandas().sort_values(["doc_id", *names])
    return *spread.value, fit_curve(got[names].to_numpy(float), got["toxic"].to_numpy(float))


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` for every row of ``docs(doc_id, text)``."""
    ship(docs.sparkSession)
    with scratch(docs.sparkSession):
        model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            if isinstance(model.value, float):
                p = np.full(batch.num_rows, model.value)
            else:
                weights, bias, coef = model.value
                p = curve(coef, text_features(batch.column(1), weights, bias))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 5).eqNullSafe(0)
    out = detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
