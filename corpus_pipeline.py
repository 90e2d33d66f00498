"""A training-data pipeline of five stages over the documents table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` writes every stage's result as Parquet in
the shared work folder, hands the reread table to the next one and deletes it once
that one is written.

Defined results: a row of null or empty text fails the quality rules and goes; nulls in other columns, ties and columns with
clashing names pass; rows that repeat a doc_id and its text leave one row at the join; rows without doc_id are judged by
their text; an empty table stays empty. The operators state the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import decontamination, jaccard_join, line_dedup, quality_rules, source_mixing
from wattloom.llm.common import drop, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules.judge(docs, quality_rules.labelled(spark, sf_dir), docs.columns)
    return judged.where(F.col(judged.columns[-1])).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of repeated line windows; those left without a word go."""
    out = line_dedup.dedup_lines(docs)
    out = out.where(~F.col(out.columns[-1])).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one with the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each copy taken, numbered by ``copy``."""
    return source_mixing.mixed(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram jaccard join", near_copies),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix),
]

#: The first stage is a fitted forest, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            drop(before)
        before = docs
    return docs
