"""Tables of days kept in versions: written once, complete or not there, read at the newest one that counts.

A version is a folder ``version=<n>/day=<d>`` that Spark's committer has finished. A reader takes each day from its newest finished
version, so a writer that dies, or is still writing, changes nothing for it; a version that is finished is never written again.
What the driver lists are folders: one a version and day, until ``vacuum`` removes those that no reader takes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):  # noqa: ANN202  a Hadoop path and its file system
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names in a folder that start with ``prefix``, without it; none if there is no such folder."""
    where, fs = _fs(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(n[len(prefix) :] for n in names if n.startswith(prefix))


def finished(spark: SparkSession, path: str) -> bool:
    where, fs = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(where)


def write_once(table: DataFrame, path: str, by: str | None = None) -> bool:
    """Write a folder unless it is finished already; what a dead writer left is replaced. Whether anything was written.

    ``by``: a column of folders; a table without one is a short list (a plan, a batch's messages) and becomes one file.
    """
    if finished(table.sparkSession, path):
        return False
    table = table.hint("rebalance", F.col(by)) if by else table.coalesce(1)  # few files a day, large days in several tasks
    writer = table.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return True


def mark(spark: SparkSession, path: str) -> None:
    """An empty file: there at once or not at all."""
    where, fs = _fs(spark, path)
    if not fs.exists(where):
        fs.create(where, True).close()


def write_days(table: DataFrame, path: str, time: str, version: int) -> bool:
    """One version of the days that ``table`` has rows of, by the day of ``time``."""
    return write_once(table.withColumn("day", F.to_date(time)), f"{path}/version={version}", "day")


def numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Finished folders ``name=<n>``, in order."""
    return sorted(int(n) for n in children(spark, path, f"{name}=") if finished(spark, f"{path}/{name}={n}"))


def newest(spark: SparkSession, path: str, upto: int | None = None) -> dict[str, int]:
    """The newest finished version of each day, none above ``upto``."""
    out: dict[str, int] = {}
    for v in numbers(spark, path, "version"):
        if upto is None or v <= upto:
            out |= dict.fromkeys(children(spark, f"{path}/version={v}", "day="), v)
    return out


def read(spark: SparkSession, path: str, schema: StructType, upto: int | None = None, first: str | None = None, last: str | None = None, days: list[dt.date] | None = None) -> DataFrame:
    """Each day's newest version; only folders of the wanted days are read."""
    only = None if days is None else {str(d) for d in days}
    found = {d: v for d, v in newest(spark, path, upto).items() if (first is None or d >= first) and (last is None or d <= last) and (only is None or d in only)}
    if not found:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/version={v}/day={d}" for d, v in sorted(found.items())]
    return spark.read.schema(schema).parquet(*folders)


def vacuum(spark: SparkSession, path: str, upto: int | None = None) -> int:
    """Remove day folders that a newer version up to ``upto`` has taken the place of; how many. Readers that began before may fail, so call it seldom."""
    keep, gone = newest(spark, path, upto), 0
    for v in numbers(spark, path, "version"):
        for d in children(spark, f"{path}/version={v}", "day="):
            if v < keep.get(d, v):
                where, fs = _fs(spark, f"{path}/version={v}/day={d}")
                fs.delete(where, True)
                gone += 1
    return gone
