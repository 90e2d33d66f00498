"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

from wattloom.llm import (
    decontamination,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    quality_classifier,
    quality_rules,
    source_mixing,
    suffix_dedup,
    toxicity,
)

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards watch from a distant hill. "
CLASHES = ["n", "doc", "shingle", "size", "target", "copies", "copy", "kept", "score", "pos", "n_lines", "n_words", "_h", "_starts", "owner", "words", "toxic", "quality", "level", "w"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (None, PROSE * 3, "en", "b"), (None, None, None, None),
        (4, PROSE * 4, "en", "b"), (4, PROSE * 4, "en", "b"), (5, PROSE * 4, "de", None), (6, PROSE * 4 + "ending", "en", "c"),
        (7, " ".join(f"word{i}" for i in range(60_000)), "en", "c"), (8, "x" * 50_000, "fr", "a"), (9, "!!! ??? \U0001f600 é\x00z", "fr", "a"), (10, "one two three", "es", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(c) for c in CLASHES}).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 1, 0), (8, 0, 1), (10, 0, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PROSE), (1, PROSE), (2, None), (3, ""), (4, "one two"), (None, PROSE), (5, PROSE)], "item_id long, text string").withColumn("doc_id", F.lit("clash"))


def run_all(docs, labels, items):
    return {
        "rules": quality_rules.judge(docs, labels),
        "rules, all columns": quality_rules.judge(docs, labels, docs.columns),
        "jaccard": jaccard_join.near_duplicates(docs),
        "jaccard, rows": jaccard_join.keep_one(docs),
        "toxicity": toxicity.detect(docs, labels),
        "language": language_id.identify(docs, docs),
        "leaks": decontamination.contaminated(docs, items),
        "leaks, rows": decontamination.clean(docs, items),
        "licences": license_scan.scan(docs),
        "suffixes": suffix_dedup.dedup(docs),
        "mix": source_mixing.mixed(docs),
        "classifier": quality_classifier.classify(docs, labels),
        "lines": line_dedup.dedup_lines(docs),
    }


def test_hard_rows(docs, labels, items):
    got = {k: v.collect() for k, v in run_all(docs, labels, items).items()}
    n = docs.count()
    for k in ("rules", "rules, all columns", "jaccard", "toxicity", "language", "suffixes", "classifier", "lines"):
        assert len(got[k]) == n, k
    jac = {(r.doc_id, r.n_shingles, r.component_id) for r in got["jaccard"]}
    assert {(1, 0, 1), (2, 0, 2), (10, 1, 10)} <= jac
    assert {r.component_id for r in got["jaccard"] if r.doc_id in (4, 5, 6)} == {4}
    assert all(0 <= r.score <= 1 for k in ("toxicity", "classifier", "language") for r in got[k])
    assert {r.lang_pred for r in got["language"] if r.doc_id in (1, 2, 3)} == {"und"}
    assert {(r.doc_id, r.item_id) for r in got["leaks"] if r.doc_id} == {(d, i) for d in (4, 5, 6) for i in (1, 5)}
    assert {r.doc_id for r in got["leaks, rows"]}.isdisjoint({4, 5, 6})
    assert not got["licences"]
    assert not any(r.kept for r in got["rules"] if r.doc_id in (1, 2, 3, 10))
    gone = {r.doc_id: (r.n_bytes, r.n_removed) for r in got["suffixes"] if r.doc_id}
    assert gone[1] == (0, 0) and gone[8] == (50_000, 50_000) and gone[7][1] == 0 and gone[4][0] == gone[4][1]
    assert {r.doc_id for r in got["lines"] if r.n_removed} == set()
    assert set(CLASHES) <= set(got["lines"][0].asDict()) and got["mix"][0]["copies"] == "copies"


def test_empty_tables(spark, docs, labels, items):
    for k, v in run_all(docs.limit(0), labels.limit(0), items.limit(0)).items():
        assert v.collect() == [], k


def test_nothing_to_learn_from(docs, labels, items):
    got = {k: v.collect() for k, v in run_all(docs.drop("lang").withColumn("lang", F.lit(None).cast("string")), labels.limit(0), items.limit(0)).items()}
    assert {r.lang_pred for r in got["language"]} == {"und"}
    assert {r.score for r in got["toxicity"]} == {0.0} and {r.score for r in got["classifier"]} == {0.5}
    assert len(got["leaks, rows"]) == docs.count()
