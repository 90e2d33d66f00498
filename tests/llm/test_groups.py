"""Groups of copies, rows without an id or with a repeated one: comparisons stay linear, results do not depend on the order of rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import components_by_force, shingles
from wattloom.llm import jaccard_join, source_mixing
from wattloom.llm.common import written


def viral(n, seed=1):
    """Near copies of a text of 300 words, one cut to 228, and a second group on the first half of the text."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for k in range(n):
        copy = list(base)
        copy[rng.randrange(300)] = f"x{k}"
        rows.append((k, " ".join(copy)))
    return [*rows, (n, " ".join(base[:228]))]


def compared(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketches, classes = jaccard_join._classes(docs, 80)
    segments, heads = jaccard_join._prefixes(docs, sketches, classes, 80)
    ids = [r[0] for r in rows]
    one = spark.createDataFrame([(i, 0 if i < ids[-1] else ids[-1]) for i in ids], "node long, component_id long")
    most = F.floor(F.col("left") * 180 / 80 - F.col("n")).cast("long")
    joined = written(heads.join(one.withColumnRenamed("node", "doc"), "doc").withColumn("most", most), "heads-of-components")
    return jaccard_join.meetings(joined, 80).count()


def test_a_shortened_copy_does_not_make_the_group_meet_itself(spark):
    small, large = compared(spark, viral(150)), compared(spark, viral(600))
    assert large <= 5 * max(small, 150) and large < 600 * 300


@pytest.mark.parametrize("directly", [jaccard_join.MEET_DIRECTLY, 0, 3])
def test_crowded_shingles_lose_no_link(spark, monkeypatch, directly):
    monkeypatch.setattr(jaccard_join, "MEET_DIRECTLY", directly)
    rng, rows = random.Random(7), {}
    for g in range(4):
        base = [f"w{rng.randrange(500)}" for _ in range(60)]
        for _ in range(14):
            copy = list(base)[: rng.choice([60, 60, 52, 47])]
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(999)}"
            rows[len(rows) + 1] = " ".join(copy if g else ["same"] * 8 + copy)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    assert got == components_by_force({i: shingles(t) for i, t in rows.items()})


def test_rows_without_an_id_link_and_are_named_by_the_smallest(spark):
    rng = random.Random(3)
    some = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    a, b, c = some(100), some(100), some(100)
    bridge = a[:]
    left, right = ["l"] * 8 + a[8:], a[:-8] + ["r"] * 8  # each near the bridge, not near each other
    assert 100 * len(shingles(" ".join(left)) & shingles(" ".join(right))) < 80 * len(shingles(" ".join(left)) | shingles(" ".join(right)))
    rows = [(None, " ".join(bridge)), (6, " ".join(left)), (5, " ".join(right)), (None, " ".join(b)), (None, " ".join(b[:-1])), (None, None), (8, None)]
    rows += [(9, " ".join(c)), (9, " ".join(some(50))), (10, " ".join(c[1:])), (9, " ".join(c)), (11, "one two")]
    want = [(None, 96, 5), (6, 92, 5), (5, 92, 5), (None, 96, None), (None, 95, None), (None, 0, None), (8, 0, 8), (9, 96, 9), (9, 46, 9), (10, 95, 9), (9, 96, 9), (11, 1, 11)]
    for k in range(3):
        shuffled = random.Random(k).sample(rows, len(rows))
        got = jaccard_join.near_duplicates(spark.createDataFrame(shuffled, "doc_id long, text string").repartition(3)).collect()
        sizes = {(i, t): len(shingles(t or "")) for i, t in rows}
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(((i, sizes[i, t], w[2]) for (i, t), w in zip(rows, want, strict=True)), key=str)


def test_the_kept_row_of_repeated_rows_is_defined(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text, "b", "en"), (1, text, "a", "fr"), (1, text, None, "de"), (None, text + " x", "a", "en"), (None, text + " y", "a", "en"), (2, "other " * 3, "z", None), (2, "other " * 3, "y", None)]
    kept = set()
    for k in range(4):
        df = spark.createDataFrame(random.Random(k).sample(rows, len(rows)), "doc_id long, text string, source string, lang string").repartition(4)
        kept.add(tuple(sorted(map(str, jaccard_join.keep_one(df.withColumn("tags", F.create_map(F.lit("k"), "source"))).collect()))))
    assert len(kept) == 1 and len(next(iter(kept))) == 2


def test_the_mix_does_not_depend_on_the_order_of_rows(spark):
    rows = [(None, f"text {k} " + "w " * (k % 3), "s", f"l{k % 5}") for k in range(40)] + [(7, f"same id {k}", "t", "en") for k in range(20)] + [(8, "equal", "t", f"l{k}") for k in range(9)]
    mixes = set()
    for k in range(3):
        df = spark.createDataFrame(random.Random(k).sample(rows, len(rows)), "doc_id long, text string, source string, lang string").repartition(1 + 2 * k)
        mixes.add(tuple(sorted(map(str, source_mixing.mixed(df, weights=(3, 1)).collect()))))
    assert len(mixes) == 1
    # rows without an id spread over hash buckets by their text
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").where("doc_id IS NULL")
    buckets = df.select(F.substring(F.md5(F.concat(F.lit("text:"), source_mixing.text_hash(F.col("text")))), 1, 3)).distinct().count()
    assert buckets > 20
