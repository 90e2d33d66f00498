"""Benchmark decontamination: a BM25 index of test items, searched by every training passage with block-max WAND.

The index is over the test items; the passages of the corpus are the queries. A
term is a run of ``TERM_WORDS`` words, since single words of a short item are in
every other passage and would make each of them a candidate.
Impacts are divided by the score an item gives itself, so a passage that holds
a whole item scores 1 whatever the item's length, and one threshold
serves all items. Passages are windows of two strides of words, one
stride apart; the stride of an item is its own length rounded up to a power of two, ``LEAST_STRIDE`` at
least, so every occurrence of an item lies whole in some passage, and the passages that it is
looked for in do not depend on other items.

The corpus is read once, whatever the number of items. A table of at most ``2 ** CELL_BITS`` bytes holds for every
term and stride the largest share of its score that the term gives an item, rounded up; a term sits in two cells and
counts with the smaller one. A passage whose terms' shares stay under the threshold cannot retrieve anything and is
left out; a fuller table lets more passages through and loses none. The rest are the candidates, written once if
there is more than one pass of the index over them.

Search is exact. For all candidates of a batch numpy sums the largest impact of each term in each block of items
that its posting list touches; this is the block-max bound, and a passage without a block at the threshold retrieves
nothing. The rest go through the document-at-a-time WAND loop, which skips items and blocks by the
same bounds. Retrieved items are then verified: enough of the item's question
and of its answer (its last sentence) has to stand in the passage as runs of
``GRAM`` words; a part under four times GRAM words is cut into shorter runs, down to single
words, so that one changed word never takes all of them. An answer of at most ``SHORT_ANSWER``
words may be missing if the question is nearly whole.

The index is cut by stride and into shards of at most ``SHARD_ITEMS`` items and ``SHARD_WORDS`` runs (a longer item is a shard of its own), which
bounds its lists; impacts and block maxima are kept per posting list only. ``SHARDS_A_PASS`` shards, chosen by hash and therefore
that many in the mean, go over the candidates of their stride at a time; the items, never the
corpus, go through the driver, a pass at a time, and a pass is released before the next one
begins. Document frequencies and the mean length
are those of all items, counted on Spark, so a score does not depend on the cuts.

Defined results: null or empty texts and items without a word match nothing; an item under TERM_WORDS words matches the texts
that consist of the same words and nothing else, as inside longer texts it would be in every other passage;
items with equal text each report; a document reports an item once, with its
best passage; rows that repeat a doc_id report once, rows without one together with a null
doc_id; an item without item_id reports a null item_id unless an item with one has its text;
no items, no rows; very long texts are searched whole, passage by passage. ``clean`` judges each row by its own text,
whatever its doc_id, and keeps rows of null or empty text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textops as tx
from .common import few, leave, scratch, ship, table, written

THRESHOLD = 0.5
QUESTION_SHARE = 0.5
ANSWER_SHARE = 0.5
NEARLY_WHOLE = 0.8
GRAM = 5
SHORT_ANSWER = 2 * GRAM
TERM_WORDS = 3
LEAST_STRIDE = 64
SHARD_ITEMS = 512
SHARD_WORDS = 200_000
SHARDS_A_PASS = 16
CELL_BITS = 26
BLOCK = 8
K1, B = 1.2, 0.75

_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: What the levels of the table of ceilings stand for: nothing, then steps of a sixteenth of an octave up to 1.
_CEILING = np.append(0.0, np.exp2((np.arange(1, 256) - 255) / 16))
_sentence_end = regex.compile(r"[.!?\n]+\s*(?=\S)")


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased runs of letters and digits, and their text index."""
    starts, ends, doc = tx.spans(off, _GAP[data])
    return tx.span_hash(tx.prefix_hash(data, tx.LOWER_CODES), starts, ends), doc


def text_terms(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return terms(data, np.array([0, len(data)]))[0]


def grams(words: np.ndarray) -> tuple[np.ndarray, int]:
    """The distinct runs of GRAM words, or of a quarter of the words if that is fewer, and the length of a run."""
    size = max(1, min(GRAM, len(words) // 4))
    return np.unique(tx.window_hash(words, size)), size


def passages(words: np.ndarray, doc: np.ndarray, n_docs: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of two strides, one stride apart, that cover every text: text index, start, end."""
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    strides = -(-np.diff(first) // stride)
    many = np.maximum(strides - 1, np.minimum(strides, 1))
    of = np.repeat(np.arange(n_docs), many)
    start = first[of] + (np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)) * stride
    return of, start, np.minimum(start + 2 * stride, first[of + 1])


def spread_out(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges, one after the other, and the range of each."""
    size = np.maximum(end - start, 0)
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) + np.repeat(start - (np.cumsum(size) - size), size), of


def cells(runs: np.ndarray, stride: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of each term in the table of ceilings."""
    mixed = tx.mix(runs + np.uint64(stride * 2 + 1) * np.uint64(0xA24BAED4963EE407))
    return (mixed >> np.uint64(64 - bits)).astype(np.int64), (mixed & np.uint64((1 << bits) - 1)).astype(np.int64)


class Postings:
    """Posting lists end to end; ``lists[t]`` are the ``(item, impact)`` of a term."""

    def __init__(self, start: np.ndarray, item: np.ndarray, impact: np.ndarray):
        self.start, self.item, self.impact = start, item, impact

    def __getitem__(self, term: int) -> list[tuple[int, float]]:
        at = slice(self.start[term], self.start[term + 1])
        return list(zip(self.item[at].tolist(), self.impact[at].tolist(), strict=True))


class Shard:
    """Inverted index of a bounded number of items, with block maxima for each posting list.

    ``whole``: number and mean length of all items and the frequency of terms that two or more of them have;
    without it, these items are all. Items under TERM_WORDS words are kept by their words in ``exact``.
    """

    def __init__(self, items: list[tuple[int, str]], whole: tuple[int, float, dict[int, int]] | None = None):
        self.ids, self.question, self.answer, self.short, bags = [], [], [], [], []
        self.exact: dict[bytes, list[int]] = {}
        for item, text in items:
            words = text_terms(text or "")
            if len(words) < TERM_WORDS:
                if len(words):
                    self.exact.setdefault(words.tobytes(), []).append(item)
                continue
            cuts = [m.end() for m in _sentence_end.finditer(text)]
            tail = text_terms(text[cuts[-1] :]) if cuts else words[-GRAM:]
            head = words[: len(words) - len(tail)] if len(tail) < len(words) else words
            self.ids.append(item)
            self.question.append(grams(head))
            self.answer.append(grams(tail if len(tail) else words))
            self.short.append(len(tail) <= SHORT_ANSWER)
            bags.append(np.unique(tx.window_hash(words, TERM_WORDS), return_counts=True))
        n = len(bags)
        item = np.repeat(np.arange(n), [len(w) for w, _ in bags])
        every = np.concatenate([w for w, _ in bags]) if n else np.zeros(0, np.uint64)
        c = np.concatenate([c for _, c in bags]) if n else np.zeros(0)
        length = np.bincount(item, c, minlength=n)
        self.vocabulary, term, df = np.unique(every, return_inverse=True, return_counts=True)
        total, mean = n, length.mean() if n else 1.0
        if whole is not None:
            total, mean = whole[:2]
            df = np.array([whole[2].get(w, 1) for w in self.vocabulary.view(np.int64).tolist()])
        idf = np.log1p((total - df + 0.5) / (df + 0.5))
        impact = idf[term] * c * (K1 + 1) / (c + K1 * (1 - B + B * length[item] / mean))
        impact /= np.bincount(item, impact, minlength=n)[item]

        order = np.lexsort((item, term))
        term, item, impact = term[order], item[order], impact[order]
        each = np.arange(len(self.vocabulary) + 1)
        self.postings = Postings(np.searchsorted(term, each), item, impact)
        block = item // BLOCK
        heads = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(block, prepend=-1))
        self.block = block[heads]
        self.block_most = np.maximum.reduceat(impact, heads) * (1 + 1e-6) if len(heads) else impact
        self.block_start = np.searchsorted(term[heads], each)
        self.most = (np.maximum.reduceat(self.block_most, self.block_start[:-1]) if len(heads) else impact).tolist()

    def _blocks(self, term: int) -> dict[int, float]:
        at = slice(self.block_start[term], self.block_start[term + 1])
        return dict(zip(self.block[at].tolist(), self.block_most[at].tolist(), strict=True))

    def wand(self, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """All items that score ``threshold`` or more for the distinct terms of ``query``."""
        lists = [[0, t, self.postings[t]] for t in query.tolist()]
        most_in = {t: self._blocks(t) for t in query.tolist()}
        found = []
        while lists:
            lists.sort(key=lambda x: x[2][x[0]][0])
            bound, pivot = 0.0, -1
            for k, (_, t, _p) in enumerate(lists):
                bound += self.most[t]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[pivot][2][lists[pivot][0]][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][2][lists[pivot + 1][0]][0] == item:
                pivot += 1
            block = item // BLOCK
            ahead = lists[: pivot + 1]
            if sum(most_in[x[1]].get(block, 0.0) for x in ahead) < threshold:
                to = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    to = min(to, lists[pivot + 1][2][lists[pivot + 1][0]][0])
            elif ahead[0][2][ahead[0][0]][0] == item:
                score = sum(x[2][x[0]][1] for x in ahead)
                if score >= threshold - 1e-9:
                    found.append((item, score))
                to = item + 1
            else:
                to = item
            for x in ahead:
                p, at = x[2], x[0]
                while at < len(p) and p[at][0] < to:
                    at += 1
                x[0] = at
            lists = [x for x in lists if x[0] < len(x[2])]
        return found

    def search(self, words: np.ndarray, doc: np.ndarray, n_docs: int, stride: int, threshold: float) -> Iterator[tuple]:
        """``(document, item, score, question share, answer share)`` for every passage and verified item of ``n_docs`` texts."""
        of, start, end = passages(words, doc, n_docs, stride)
        at, place = spread_out(start, end)
        for p, *found in self.retrieve(words[at], place, threshold):
            yield int(of[p]), *found

    def retrieve(self, words: np.ndarray, place: np.ndarray, threshold: float) -> Iterator[tuple]:
        """``(passage, item, score, question share, answer share)``; ``place``: the passage of each word, ascending."""
        if not len(self.vocabulary) or len(words) < TERM_WORDS:
            return
        runs = tx.window_hash(words, TERM_WORDS)
        term = np.minimum(np.searchsorted(self.vocabulary, runs), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[term] == runs)
        hit = hit[place[hit] == place[hit + TERM_WORDS - 1]]
        pairs = np.unique(place[hit] * len(self.vocabulary) + term[hit])
        of, term = pairs // len(self.vocabulary), pairs % len(self.vocabulary)
        at, pair = spread_out(self.block_start[term], self.block_start[term + 1])
        n_blocks = len(self.ids) // BLOCK + 1
        spot, which = np.unique(of[pair] * n_blocks + self.block[at], return_inverse=True)
        bound = np.bincount(which, self.block_most[at], minlength=len(spot))
        for p in np.unique(spot[bound >= threshold] // n_blocks).tolist():
            lo, hi = np.searchsorted(of, [p, p + 1])
            found = self.wand(term[lo:hi], threshold)
            passage = words[slice(*np.searchsorted(place, [p, p + 1]))] if found else None
            for item, score in found:
                question, answer = (float(np.isin(g, tx.window_hash(passage, n)).mean()) for g, n in (self.question[item], self.answer[item]))
                if question >= QUESTION_SHARE and answer >= ANSWER_SHARE or self.short[item] and question >= NEARLY_WHOLE:
                    yield p, self.ids[item], score, question, answer


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every item that has a word, with the number of its terms, the distinct ones and their counts."""
    for batch in batches:
        words = [text_terms(t or "") for t in batch.column(1).to_pylist()]
        use = pa.array([k for k, w in enumerate(words) if len(w)], pa.int64())
        runs = [tx.window_hash(w, TERM_WORDS) for w in words if len(w)]
        bags = [np.unique(r.view(np.int64), return_counts=True) for r in runs]
        longs = pa.list_(pa.int64())
        cols = [pa.array([len(r) for r in runs], pa.int64()), pa.array([t for t, _ in bags], longs), pa.array([c for _, c in bags], longs)]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(use), batch.column(1).take(use), *cols], names=["item_id", "text", "n", "terms", "counts"])


def _ceilings(bags: DataFrame, common: DataFrame, n: int, mean: float, bits: int) -> np.ndarray:
    """The table of ceilings: per cell the level of the largest share that a term of the cell has of an item's score."""
    each = bags.where("n > 0").withColumn("item", F.struct("item_id", F.md5("text")))
    each = each.select("item", "stride", "n", F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("item", "stride", "n", F.col("x.terms").alias("term"), F.col("x.counts").alias("c"))
    df = F.coalesce("df", F.lit(1))
    raw = F.log1p((F.lit(n) - df + 0.5) / (df + 0.5)) * F.col("c") * (K1 + 1) / (F.col("c") + K1 * (1 - B + B * F.col("n") / F.lit(mean)))
    share = F.col("raw") / F.sum("raw").over(Window.partitionBy("item"))
    shares = each.join(common, "term", "left").withColumn("raw", raw).withColumn("share", share).groupBy("stride", "term").agg(F.max("share").alias("share"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stride, term, share = (np.asarray(c) for c in batch.columns)
            level = np.clip(255 - np.floor(-16 * np.log2(share * (1 + 1e-6))), 1, 255).astype(np.int16)
            for width in np.unique(stride).tolist():
                mine = stride == width
                both = np.concatenate(cells(term[mine].view(np.uint64), width, bits))
                yield pa.RecordBatch.from_arrays([pa.array(both), pa.array(np.tile(level[mine], 2))], names=["cell", "level"])

    rows = shares.select("stride", "term", "share").mapInArrow(place, "cell long, level short").groupBy("cell").agg(F.max("level").alias("level")).toArrow()
    levels = np.zeros(1 << bits, np.uint8)
    levels[np.asarray(rows["cell"])] = np.asarray(rows["level"])
    return levels


def _candidates(docs: DataFrame, ceilings: Broadcast, bits: int, strides: list[int], threshold: float) -> DataFrame:
    """``doc_id, stride, words`` of every passage that may retrieve an item; stride 0: a whole text under TERM_WORDS words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.chunks(batches):
            words, doc = terms(*tx.text_bytes(batch.column(1)))
            runs = tx.window_hash(words, TERM_WORDS)
            inside = doc[: len(runs)] == doc[len(doc) - len(runs) :]
            for stride in strides:
                if stride:
                    one, other = cells(runs, stride, bits)
                    share = np.where(inside, _CEILING[np.minimum(ceilings.value[one], ceilings.value[other])], 0.0)
                    of, start, end = passages(words, doc, batch.num_rows, stride)
                    last = np.maximum(end - (TERM_WORDS - 1), start)
                    sums = np.append(0.0, np.cumsum(share))
                    sums = np.append(sums, np.full(max(0, len(words) + 1 - len(sums)), sums[-1]))
                    # first with repeats, which is cheap, then each term once
                    may = np.flatnonzero(sums[last] - sums[start] >= threshold - 1e-6)
                    at, k = spread_out(start[may], last[may])
                    at, k = at[share[at] > 0], k[share[at] > 0]
                    order = np.lexsort((runs[at], k))
                    at, k = at[order], k[order]
                    new = np.append(True, (runs[at][1:] != runs[at][:-1]) | (k[1:] != k[:-1]))[: len(k)]
                    use = may[np.bincount(k[new], share[at[new]], minlength=len(may)) >= threshold - 1e-6]
                else:
                    of = np.arange(batch.num_rows)
                    start, end = np.searchsorted(doc, of), np.searchsorted(doc, of, side="right")
                    use = np.flatnonzero((end > start) & (end - start < TERM_WORDS))
                if len(use):
                    texts = pa.array([words[a:b].tobytes() for a, b in zip(start[use].tolist(), end[use].tolist(), strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of[use])), pa.array(np.full(len(use), stride, np.int32)), texts], names=["doc_id", "stride", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {_kind(docs)}, stride int, words binary")


def _kind(docs: DataFrame) -> str:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return "long" if kind in ("int", "bigint") else kind


def _pass(candidates: DataFrame, spread: Broadcast, threshold: float) -> DataFrame:
    """Verified matches of some shards; the best figures per document and item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            words = np.frombuffer(b"".join(texts), np.uint64)
            place = np.repeat(np.arange(len(texts)), [len(t) // 8 for t in texts])
            rows = []
            for shard in spread.value:
                rows += shard.retrieve(words, place, threshold)
                if shard.exact:
                    rows += [(p, item, 1.0, 1.0, 1.0) for p, t in enumerate(texts) for item in shard.exact.get(t, [])]
            cols = [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int64())]
            cols += [pa.array([r[c] for r in rows], pa.float64()) for c in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "score", "question_share", "answer_share"])

    found = candidates.select("doc_id", "words").mapInArrow(run, f"doc_id {_kind(candidates)}, {_MATCH}")
    return found.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("score", "question_share", "answer_share")))


_MATCH = "item_id long, score double, question_share double, answer_share double"


def _shards(rows: list[tuple[int, str, int]], whole: tuple[int, float, dict[int, int]]) -> list[Shard]:
    """Shards of ``(item_id, text, terms)`` in the given order, bounded by items and by terms."""
    shards, part, size = [], [], 0
    for item, text, n in rows:
        if part and (len(part) >= SHARD_ITEMS or size + n > SHARD_WORDS):
            shards.append(Shard(part, whole))
            part, size = [], 0
        part.append((item, text))
        size += n
    return [*shards, Shard(part, whole)] if part else shards


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, score, question_share, answer_share`` of all verified matches of ``items(item_id, text)``."""
    spark = docs.sparkSession
    ship(spark)
    with scratch(spark):
        items = items.where("text IS NOT NULL").select("item_id", "text").distinct()
        named = items.where("item_id IS NOT NULL")
        order = named.unionByName(items.where("item_id IS NULL").join(named.select("text"), "text", "left_anti").select("item_id", "text"))
        bags = order.mapInArrow(_bags, "item_id long, text string, n long, terms array<long>, counts array<long>")
        stride = F.greatest(F.lit(LEAST_STRIDE), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") + (TERM_WORDS - 1)))).cast("int"))
        bags = written(bags.withColumn("stride", F.when(F.col("n") > 0, stride).otherwise(0)).withColumn("h", F.xxhash64("item_id", "text")), "items")
        n, mean, n_terms = bags.where("n > 0").agg(F.count("*"), F.avg("n"), F.sum(F.size("terms"))).first()
        common = written(bags.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).where("df > 1"), "terms")
        classes = sorted(bags.groupBy("stride").agg(F.count("*").alias("items"), F.sum("n").alias("n")).collect())
        if not classes:
            return spark.createDataFrame([], f"doc_id {_kind(docs)}, {_MATCH}")
        bits = min(CELL_BITS, max(10, int(8 * (n_terms or 0)).bit_length()))
        ceilings = _ceilings(bags, common, n, mean, bits) if n else np.zeros(1 << bits, np.uint8)
        found = _candidates(docs, spark.sparkContext.broadcast(ceilings), bits, [r.stride for r in classes], threshold)
        shares = []
        for r in classes:
            cuts = max(-(-r["items"] // (SHARD_ITEMS * SHARDS_A_PASS)), -(-r["n"] // (SHARD_WORDS * SHARDS_A_PASS)))
            shares += [(r.stride, bags.where(F.col("stride") == r.stride).where(F.pmod("h", F.lit(cuts)) == k)) for k in range(cuts)]
        # written before it is scored: a task then holds one Python worker, not two in a chain, which would stay in memory for later stages
        found = written(found, "passages")
        passes = []
        for width, share in shares:
            rows = [tuple(r) for r in share.select("item_id", "text", "n").orderBy("item_id", "text").collect()]
            known = common.join(share.select(F.explode("terms").alias("term")), "term", "left_semi")
            spread = spark.sparkContext.broadcast(_shards(rows, (n, mean or 1.0, {r.term: r.df for r in known.collect()})))
            # this pass is done before the next one's items are collected
            passes.append(leave(_pass(found.where(F.col("stride") == width), spread, threshold), "leaks"))
            spread.destroy()
    return reduce(DataFrame.unionByName, passes)


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text holds a test item; rows and items without an id too."""
    digest = F.md5("text")
    with scratch(docs.sparkSession):
        hit = contaminated(docs.select(digest.alias("doc_id"), "text"), items, threshold)
        hit = leave(hit.select(F.col("doc_id").alias("_digest")).distinct(), "contaminated")
    return docs.join(few(hit), digest == F.col("_digest"), "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
