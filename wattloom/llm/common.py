"""Spark plumbing shared by the corpus operators: table access and cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import shipping

#: A join side of at most this many values is sent to every task; a larger one
#: is joined by a shuffle of both sides.
BROADCAST_IDS = 1_000_000

#: Texts are long: so many rows, and not Spark's 10,000, make an Arrow batch unless the session says otherwise.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """What Python tasks need: this package on the executors and, unless the user has set a number, Arrow batches that fit beside the heap."""
    shipping.ship(spark)
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where it is unset: a folder of our own in local mode, an error on a cluster."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='wattloom-')}"
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def free_names(wanted: list[str], taken: list[str]) -> list[str]:
    """Names for made columns: an underscore in front, and more, where a name is taken (Spark compares without case)."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


_scratch: list[list[str]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared work folder and read it back: lineage ends here."""
    ship(df.sparkSession)
    path = f"{work_dir(df.sparkSession)}/wattloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if _scratch:
        _scratch[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of written tables that nothing reads any more."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop(table: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    folders = {path.rsplit("/", 1)[0] for path in table.inputFiles()}
    drop_folders(table.sparkSession, sorted(folders))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end: what leaves the block has to be written after it, or by ``leave``."""
    _scratch.append([])
    try:
        yield
    finally:
        drop_folders(spark, _scratch.pop())


def leave(df: DataFrame, name: str) -> DataFrame:
    """``written``, kept when the ``scratch`` block around it ends (it belongs to the next outer block, if any)."""
    inner = _scratch.pop() if _scratch else None
    try:
        return written(df, name)
    finally:
        if inner is not None:
            _scratch.append(inner)


def learnable(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` labelled documents, chosen by hash, one row for each doc_id.

    A doc_id with several labels has the largest; one with several texts, the first in order.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    chosen = F.broadcast(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))  # at most ``most`` rows
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    first = F.min(F.struct(F.xxhash64("text"), "text"))["text"]
    return rows.groupBy("doc_id").agg(first.alias("text"), F.max("_label").alias(label))


def few(side: DataFrame, weight: F.Column | None = None) -> DataFrame:
    """``side`` (a written table), marked for broadcast only if a count shows it to be small."""
    n = side.agg(F.sum(F.lit(1) if weight is None else weight + 4)).first()[0] or 0
    return F.broadcast(side) if n <= BROADCAST_IDS else side


def keep_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is among ``ids`` (a written table of one column, no repeats)."""
    return rows.join(few(ids), key, "left_semi")


def join_few(rows: DataFrame, side: DataFrame, key: str | list[str], weight: F.Column) -> DataFrame:
    """Left join with a written table that has a row per ``key``; weight: values in a row."""
    return rows.join(few(side, weight), key, "left")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected ``links(a, b)``: rows ``(node, component_id)``.

    Alternates the large-star and small-star steps (Kiveris et al., "Connected
    components in MapReduce and beyond", 2014) until the edge set stops
    changing. A step is a grouped minimum and a join, both on Spark; every step
    is written, so lost executors repeat one step only. Nodes without a link do
    not appear.
    """

    def fingerprint(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    spark = links.sparkSession
    with scratch(spark):
        edges = leave(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = fingerprint(edges)
    while seen[0]:
        before = edges
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        with scratch(spark):
            large = written(large.where("a <> b").distinct(), name)
            least = large.groupBy("a").agg(F.min("b").alias("m"))
            small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            edges = leave(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), name)
        drop(before)
        now = fingerprint(edges)
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component_id"))).distinct()
