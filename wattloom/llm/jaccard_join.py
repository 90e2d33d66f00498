"""Exact near-duplicate join on word shingles by vertical partitioning.

Two documents link when the Jaccard similarity of their sets of distinct
five-word shingles is at least 80 per cent. The method cuts a global shingle
order into fragments, counts the partial overlap of a pair in every fragment
on its own and sums the counts per pair (Rong et al., "Fast and scalable
distributed set similarity joins", 2017).

Plan, all of it joins and grouped aggregates on Spark:

1. One pass over the texts gives each document its set size, a 128-bit digest
   of the set and the first part of the set in hash order. Documents with equal
   sets form one class, stood for by its smallest doc_id.
2. If two sets are similar, their first ``p + l - 1`` shingles in any fixed
   order have ``l`` in common. A document with fewer than ``l`` shared shingles
   there links with nothing; the others are candidates.
3. Shingles of candidates get their frequency among candidates, and
   the global order: rarest first, by power-of-two frequency class, then hash;
   cuts between classes and inside them are the fragments. Shingles of one
   candidate only cannot overlap; they come first and count in the size only.
4. Similar pairs meet at their first common shingle, with enough of both sets
   left behind it in the order (prefix and positional filter); ``left`` counts it.
   They are found in two rounds. First every document of a shingle meets one hub,
   the document with the largest part left; so groups of near copies join with
   a number of pairs linear in the group. Then all pairs whose documents are
   still in different components and that both sizes allow meet (``other_pairs``). Pairs inside one component need no look
   where only components are asked for; ``similar_pairs`` looks at all. No cap is set anywhere.
5. Each pair's overlap is summed over fragments and compared exactly.

Defined results: null and empty texts have no shingles and link with nothing;
texts of one to four words are one shingle; equal texts are one class; very long texts are sets like
others, a text at a time in a task; rows
that repeat a doc_id get a row each. A row without doc_id, and one whose doc_id has other texts too, is a
document of its own that links by its text; its component is the smallest doc_id that it reaches, NULL if there is none but NULLs.
No rows give no rows. Columns other than the key and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textops as tx
from .common import components, drop, few, keep_ids, leave, scratch, ship, table, written

SHINGLE_WORDS = 5
PERCENT = 80
STEPS_A_DOUBLING = 12
#: Up to so many larger sets of a shingle and size class meet its leaders one by one; from more on components meet first. Results are the same.
MEET_DIRECTLY = 64


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    data, off = tx.text_bytes(texts)
    starts, ends, doc = tx.words(data, off)
    word = tx.span_hash(tx.prefix_hash(data, tx.LOWER_CODES), starts, ends)
    grams = tx.window_hash(word, size)
    first = np.searchsorted(doc, np.arange(len(off)))
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            sets.append(np.unique(grams[a : b - size + 1]))
        else:
            sets.append(tx.window_hash(word[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return sets


def sketch(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """doc_id, set size, set digest, number of shared shingles needed and the first shingles in hash order."""
    for batch in tx.chunks(batches):
        sets = shingle_sets(batch.column(1))
        n = np.array([len(s) for s in sets], np.int64)
        ahead = n - (n * percent + 99) // 100 + 1
        need = np.maximum(1, n // 20)
        take = np.minimum(n, ahead + need - 1)
        need = np.where(take < ahead + need - 1, np.maximum(1, take - ahead + 1), need)
        digest = [(int(tx.mix(s).sum()), int(tx.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum())) for s in sets]
        first = np.concatenate([s[:k] for s, k in zip(sets, take, strict=True)] or [np.zeros(0, np.uint64)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n),
                pa.array(np.array([d[0] for d in digest], np.uint64).view(np.int64)),
                pa.array(np.array([d[1] for d in digest], np.uint64).view(np.int64)),
                pa.array(need),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(take)), pa.int32()), pa.array(first.view(np.int64))),
            ],
            names=["doc_id", "n", "d1", "d2", "need", "first"],
        )


def all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tx.chunks(batches):
        sets = shingle_sets(batch.column(1))
        n = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets).view(np.int64)
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(sets)), n)))
        yield pa.RecordBatch.from_arrays([ids, pa.array(np.repeat(n, n)), pa.array(flat)], names=["doc", "n", "shingle"])


def _overlap_needed(a: str, b: str, percent: int) -> str:
    """The least intersection for which percent is reached, from both set sizes."""
    return f"ceil({percent} * ({a} + {b}) / {100 + percent}.0D)"


def verify(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b, na, nb)`` that reach the similarity: partial overlaps by fragment, summed per pair."""
    left = segments.select(F.col("doc").alias("a"), "fragment", F.col("part").alias("pa"))
    right = segments.select(F.col("doc").alias("b"), "fragment", F.col("part").alias("pb"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"])
    partial = partial.select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).alias("k"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("k").alias("overlap"))
    return total.where(F.col("overlap") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text, ...)``."""
    with scratch(docs.sparkSession):
        keyed = _keyed(docs)
        if keyed is not None:
            found = _components(keyed.select(F.col("_row").alias("doc_id"), "text"), percent).withColumnsRenamed({"doc_id": "_row", "component_id": "_group"})
            rows = written(found.join(keyed.select("_row", "doc_id").distinct(), "_row"), "found")
            least = rows.groupBy("_group").agg(F.min("doc_id").alias("component_id"))
            return leave(rows.join(least, "_group").select("doc_id", "n_shingles", "component_id"), "components")
        return leave(_components(docs, percent), "components")


def _components(docs: DataFrame, percent: int) -> DataFrame:
    """``near_duplicates`` of rows whose doc_id is not NULL and has one text."""
    with scratch(docs.sparkSession):
        sketches, classes = _classes(docs, percent)
        segments, heads = _prefixes(docs, sketches, classes, percent)
        hubs = heads.groupBy("shingle").agg(
            F.max_by(F.struct(F.col("doc").alias("hub"), F.col("n").alias("hn"), F.col("left").alias("hleft")), F.col("left") / F.col("n")).alias("h"),
            F.count("*").alias("c"),
        )
        star = heads.join(hubs.where("c > 1").select("shingle", "h.*"), "shingle").where("doc <> hub").where(_possible(percent))
        # the hub is the right side, whose parts are read once a fragment and not once a pair
        pairs = star.select(F.col("doc").alias("a"), F.col("hub").alias("b"), F.col("n").alias("na"), F.col("hn").alias("nb")).distinct()
        links = written(verify(pairs, segments, percent), "links")
        cross = other_pairs(heads, components(links), percent)
        found = components(links.unionByName(verify(cross, segments, percent)))
        of_class = classes.join(found, classes.rep == found.node, "left")
        of_class = of_class.select("n", "d1", "d2", F.coalesce("component_id", "rep").alias("component_id"))
        out = sketches.select("doc_id", "n", "d1", "d2").join(of_class, ["n", "d1", "d2"], "left")
        return leave(out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")), "components")


def similar_pairs(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The join itself: all pairs ``(a, b)`` of different sets that link, each set named by its smallest doc_id, and membership ``(doc_id, rep)``.

    Its size is that of the result, which within a group of near copies grows with the square of the group.
    """
    with scratch(docs.sparkSession):
        sketches, classes = _classes(docs, percent)
        segments, heads = _prefixes(docs, sketches, classes, percent)
        alone = heads.select(F.col("doc").alias("node"), F.col("doc").alias("component_id")).distinct()
        pairs = leave(verify(other_pairs(heads, alone, percent), segments, percent), "pairs")
        members = leave(sketches.join(classes, ["n", "d1", "d2"]).select("doc_id", "rep"), "members")
    return pairs, members


def _classes(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """A sketch of every row, and the classes of equal sets with their smallest doc_id."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text").mapInArrow(lambda it: sketch(it, percent), "doc_id long, n long, d1 long, d2 long, need long, first array<long>")
    sketches = written(rows, "sketches")
    return sketches, sketches.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"))


def _prefixes(docs: DataFrame, sketches: DataFrame, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of the candidates: the parts of their sets by fragment, and the shingles at which a link can be met first."""
    first = sketches.where("n > 0").select("doc_id", "need", F.explode("first").alias("shingle"))
    shared = first.groupBy("shingle").count().where("count > 1").select("shingle")
    hopeful = first.join(shared, "shingle").groupBy("doc_id").agg(F.count("*").alias("k"), F.min("need").alias("need"))
    ids = hopeful.where("k >= need").select(F.col("doc_id").alias("rep")).join(classes, "rep", "left_semi")
    ids = written(ids.select(F.col("rep").alias("doc_id")).distinct(), "candidates")

    rows = keep_ids(docs.select("doc_id", "text"), ids, "doc_id").mapInArrow(all_shingles, "doc long, n long, shingle long")
    order = rows.groupBy("shingle").agg(F.count("*").alias("f")).where("f > 1")
    half = (F.col("shingle") >= 0).cast("int")
    order = order.select("shingle", (F.floor(F.log2("f")).cast("int") * 2 + half).alias("fragment"))
    segments = rows.join(order, "shingle").groupBy("doc", "n", "fragment")
    segments = written(segments.agg(F.sort_array(F.collect_set("shingle")).alias("part")), "segments")

    of_doc = Window.partitionBy("doc", "n")
    placed = segments.withColumn("m", F.sum(F.size("part")).over(of_doc))
    placed = placed.withColumn(
        "before", F.coalesce(F.sum(F.size("part")).over(of_doc.orderBy("fragment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    placed = placed.where(f"m * 100 >= n * {percent}").select("doc", "n", "m", "before", F.posexplode("part").alias("at", "shingle"))
    heads = placed.select("doc", "n", "shingle", (F.col("m") - F.col("before") - F.col("at")).alias("left"))
    return segments, written(heads.where(f"left >= ceil(n * {percent} / 100)"), "heads")


def _possible(percent: int) -> str:
    return f"least(left, hleft) >= {_overlap_needed('n', 'hn', percent)}"


def other_pairs(heads: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b, na, nb)`` of documents in different components ``found(node, component_id)`` that can link.

    What a document has left at a shingle bounds the size of a partner there, to at most ``left * (100 + percent) / percent - n``.
    So the smaller set of a pair, the leader, must bear a partner of its own size, and the larger one goes
    only to the size classes, ``STEPS_A_DOUBLING`` to a doubling, of leaders that it bears. Many documents that share a
    template and cannot link, since too little is left at its shingles, then form no pair at all.
    """
    joined = heads.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component_id", F.coalesce("component_id", "doc"))
    most = F.floor(F.col("left") * (100 + percent) / percent - F.col("n")).cast("long")
    joined = written(joined.withColumn("most", most), "heads-of-components")
    met = meetings(joined, percent)
    met = met.where("component_id <> hc AND (n < hn OR n = hn AND doc < hub)").where(_possible(percent))
    return met.select(F.col("doc").alias("a"), F.col("hub").alias("b"), F.col("n").alias("na"), F.col("hn").alias("nb")).distinct()


def meetings(joined: DataFrame, percent: int) -> DataFrame:
    """Leaders and larger sets that meet at a shingle and size class; of ``joined(doc, n, shingle, left, component_id, most)``.

    At a shingle with many documents of a size class the components meet first, by their smallest set and the largest
    part left, and only documents of two that differ and can link are brought together. So a group of near copies next to
    one document of another component meets that one and not itself.
    """
    place = lambda n: F.floor(F.log2(n) * STEPS_A_DOUBLING).cast("int")
    mixed = joined.groupBy("shingle").agg(F.min("component_id").alias("x"), F.max("component_id").alias("y"))
    rest = joined.join(mixed.where("x <> y").select("shingle"), "shingle", "left_semi")
    leaders = rest.where("most >= n").withColumn("size", place("n"))
    least = F.greatest(F.lit(1), F.ceil(F.col("n") * percent / 100))
    upto = F.least("n", "most")
    larger = rest.where(upto >= least).withColumn("size", F.explode(F.sequence(place(least), place(upto))))
    larger = larger.toDF(*[{"doc": "hub", "n": "hn", "left": "hleft", "component_id": "hc", "most": "hmost"}.get(c, c) for c in larger.columns])
    at = ["shingle", "size"]
    many = written(larger.groupBy(*at).agg(F.count("*").alias("c")).where(F.col("c") > MEET_DIRECTLY).select(*at), "crowded")
    if many.isEmpty():
        return leaders.join(larger, at)
    met = leaders.join(few(many), at, "left_anti").join(larger.join(few(many), at, "left_anti"), at)
    leaders, larger = leaders.join(few(many), at, "left_semi"), larger.join(few(many), at, "left_semi")
    of_leaders = leaders.groupBy(*at, "component_id").agg(F.min("n").alias("n"), F.max("left").alias("left"))
    of_larger = larger.groupBy(*at, "hc").agg(F.min("hn").alias("hn"), F.max("hleft").alias("hleft"))
    both = of_leaders.join(of_larger, at).where("component_id <> hc").where(_possible(percent)).select(*at, "component_id", "hc")
    crowded = leaders.join(both, [*at, "component_id"]).join(larger, [*at, "hc"])
    return met.unionByName(crowded.select(*met.columns))


def _keyed(docs: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = written) -> DataFrame | None:
    """``docs`` with ``_row``, a key of their own for rows without doc_id or whose doc_id has several texts, behind the usual ids.

    None if all rows have an id of one text. Rows equal in doc_id and text share a key. ``keep`` writes the ids of several texts, which the result reads.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"))
    odd = texts.groupBy("doc_id").agg((F.min("h") != F.max("h")).alias("several")).where("several OR doc_id IS NULL")
    odd = written(odd.select("doc_id"), "odd")
    if odd.isEmpty():
        return None
    several = keep(odd.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_of")), "several")
    own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    keyed = docs.join(few(several), F.col("doc_id") == F.col("_of"), "left")
    return keyed.withColumn("_row", F.when(F.col("doc_id").isNull() | F.col("_of").isNotNull(), own).otherwise(F.col("doc_id")))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of every component: the one with the smallest doc_id.

    Rows that repeat a doc_id and its text are one document, of which one row stays: the one that is first as JSON. A row without doc_id, or
    whose doc_id has several texts, has a key of its own from doc_id and text, behind the usual ids.
    """
    with scratch(docs.sparkSession):
        keyed = _keyed(docs, leave)
        keyed = docs.withColumn("_row", F.col("doc_id")) if keyed is None else keyed
        found = _components(keyed.select(F.col("_row").alias("doc_id"), "text"), percent)
        gone = leave(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_row")).distinct(), "gone")
        again = leave(found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_row")), "again")
    kept = keyed.join(gone, "_row", "left_anti")
    if again.isEmpty():
        drop(again)
        return kept.select(*docs.columns)
    once, twice = kept.join(few(again), "_row", "left_anti"), kept.join(few(again), "_row", "left_semi")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = twice.groupBy("_row").agg(F.min_by(whole, F.to_json(whole, {"ignoreNullFields": "false"})).alias("_first"))
    return once.select(*docs.columns).unionByName(one.select("_first.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
