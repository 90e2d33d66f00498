"""Benchmark decontamination: items of any length, an index of many shards, one read of the corpus, nothing left behind."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.llm import decontamination, line_dedup
from wattloom.llm.common import work_dir

MATCH = "item_id long, text string"


def some(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n))


@pytest.fixture(scope="module")
def long_items(spark):
    rng = random.Random(11)
    items = {k: f"{some(rng, n)}. {some(rng, 12)}." for k, n in enumerate([5, 20, 20, 60, 150, 150, 700, 3000, 9000])}
    docs = {k: f"{some(rng, 200)} {text} {some(rng, 200)}" for k, text in items.items()} | {100 + k: some(rng, 400) for k in range(20)}
    docs |= {200: items[3] + " " + some(rng, 50) + " " + items[8], 201: items[7][: len(items[7]) // 3]}
    return spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(items.items()), MATCH)


def test_items_under_three_words_match_whole_texts(spark):
    docs = spark.createDataFrame([(1, "Two words!"), (2, "two words more"), (3, " two\nWORDS"), (4, "two"), (5, None), (6, ""), (None, "two words")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "two words"), (2, "two"), (3, "..."), (4, "Two, words.")], MATCH)
    want = {(d, i) for d in (1, 3, None) for i in (1, 4)} | {(4, 2)}
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()} == want
    longer = items.union(spark.createDataFrame([(9, "a longer item of several words that is nowhere")], MATCH))
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, longer).collect()} == want
    assert {r.doc_id for r in decontamination.clean(docs, items).collect()} == {2, 5, 6}


def test_many_shards_read_the_corpus_once(spark, long_items, monkeypatch):
    docs, items = long_items
    want = sorted(map(tuple, decontamination.contaminated(docs, items).collect()))
    assert {r[:2] for r in want} == {(k, k) for k in range(9)} | {(200, 3), (200, 8)}
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 100)
    monkeypatch.setattr(decontamination, "SHARDS_A_PASS", 1)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    got = sorted(map(tuple, decontamination.contaminated(docs.mapInArrow(count, docs.schema), items).collect()))
    assert [r[:2] for r in got] == [r[:2] for r in want] and np.allclose(got, want)
    assert read.value == docs.count()


def test_a_crowded_table_of_ceilings_loses_nothing(spark, long_items, monkeypatch):
    docs, items = long_items
    want = sorted(map(tuple, decontamination.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontamination, "CELL_BITS", 4)
    assert np.allclose(sorted(map(tuple, decontamination.contaminated(docs, items).collect())), want)


def test_ceilings_leave_ordinary_texts_out(spark, long_items, monkeypatch):
    docs, items = long_items
    seen = []
    plain = decontamination._candidates
    monkeypatch.setattr(decontamination, "_candidates", lambda *a: seen.append(plain(*a)) or seen[-1])
    decontamination.contaminated(docs, items)
    assert {r.doc_id for r in seen[0].select("doc_id").collect()} <= {*range(9), 200, 201}


def test_only_the_table_that_is_read_stays(spark, long_items):
    docs, items = long_items
    folder = work_dir(spark).removeprefix("file://") + "/wattloom"
    decontamination.contaminated(docs, items).collect()
    before = set(os.listdir(folder))
    decontamination.contaminated(docs, items).collect()
    decontamination.clean(docs, items).collect()
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before} <= {"leaks", "contaminated"}
    before = set(os.listdir(folder))
    lines = line_dedup.dedup_lines(docs.withColumn("text", F.lit("a\nb\nc\nd")))
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before} == {"line-starts"}
    assert lines.where("n_removed = 4").count() == docs.count() - 1


def test_passages_are_stored_before_they_are_scored(spark, long_items, monkeypatch):
    """With one pass too: finding passages and scoring them in one stage took two Python workers a task."""
    docs, items = long_items
    plans = []
    plain = decontamination._pass
    monkeypatch.setattr(decontamination, "_pass", lambda found, *a: plans.append(found._jdf.queryExecution().executedPlan().toString()) or plain(found, *a))
    got = decontamination.contaminated(docs, items.where("item_id = 5"))
    assert [(r.doc_id, r.item_id) for r in got.collect()] == [(5, 5)]
    assert len(plans) == 1 and "MapInArrow" not in plans[0]
