"""Periodic runs against a search of every period of every text."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from wattloom.llm import period_runs
from wattloom.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_force(w):
    """All ``(start, length, period)``: each stretch is tried with each period, smallest first."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and w[e] == w[e + q]:
                e += 1
            if e - i + q >= max(6, 4 * q):
                out.setdefault((i, e - i + q), q)
            i = e
    return sorted((s, n_, q) for (s, n_), q in out.items())


def expected(text, words=None):
    w = WORD.findall(text or "") if words is None else words
    runs = sorted(runs_by_force(w), key=lambda r: (r[0], r[2]))
    gone = set()
    for s, n, q in runs:
        gone |= set(range(s + q, s + n))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def figures(r):
    return (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


def made_text(rng):
    words = []
    for _ in range(rng.randrange(1, 6)):
        alphabet = rng.choice(["ab", "abc", "abcdefghijklmnop"])
        block = [rng.choice(alphabet) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 31, 64]))]
        times = rng.choice([1, 2, 4, 5, 9])
        words += (block * times + block[: rng.randrange(len(block) + 1)])[: rng.randrange(1, 600)]
        if rng.random() < 0.3 and words:
            words[rng.randrange(len(words))] = "x"
    return " ".join(words)


@pytest.mark.parametrize("tile", [1 << 15, 1, 40])
def test_random_texts(monkeypatch, tile):
    """Small tiles cut runs into many fragments; here they are stitched by hand."""
    monkeypatch.setattr(period_runs, "TILE_WORDS", tile)
    rng = random.Random(tile)
    for _ in range(400):
        w = made_text(rng).split()
        spans = {}
        for octave, low, first, count, words in period_runs.tiles_of(period_runs.numbered([x.encode() for x in w])):
            for q, s, e in period_runs.solve(octave, low, first, count, period_runs.np.frombuffer(words, "int32").tolist()):
                spans.setdefault(q, []).append((s, e))
        got = []
        for q, parts in spans.items():
            parts.sort()
            merged = []
            for s, e in parts:
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(e, merged[-1][1])
                else:
                    merged.append([s, e])
            got += [(s, e - s + q, q) for s, e in merged if e - s + q >= max(6, 4 * q)]
        assert sorted(got) == runs_by_force(w)


@pytest.mark.parametrize("tile", [1 << 15, 7])
def test_texts_through_spark(spark, monkeypatch, tile):
    monkeypatch.setattr(period_runs, "TILE_WORDS", tile)
    rng = random.Random(5)
    rows = {k: made_text(rng) for k in range(150)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    got = period_runs.collapse(docs, with_text=True).collect()
    assert {r.doc_id: figures(r) for r in got} == {k: expected(t) for k, t in rows.items()}
    for r in got:
        assert hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256
        assert len(r.starts or []) == r.n_runs


def damaged_by_force(doc_id, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_whole_table(spark):
    sf = f"{DATA}/sf0.001"
    want = {r.doc_id: expected(None, damaged_by_force(r.doc_id, r.text)) for r in table(spark, sf, "documents").collect()}
    got = {r.doc_id: figures(r) for r in period_runs.query(spark, sf).collect()}
    assert got == want and sum(r[0] > 0 for r in got.values()) > 5


def test_hard_rows(spark):
    long = "the same words again " * 60_000
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a " * 9), (None, None), (None, "b " * 9), (4, "a " * 6), (4, "a " * 6), (4, "a " * 5), (5, "a b " * 4 + "a"), (6, long), (7, "é\x00 " * 7), (8, "a a a a a a b b b b b b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("key", "start", "period", "runs", "n_runs", "words")})
    got = period_runs.collapse(docs).collect()
    assert len(got) == len(rows)
    want = [(i, *((1, 0, 240_000, 4, 60_000_000) if i == 6 else expected(t)[:5])) for i, t in rows]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, *figures(r)[:5])) for r in got)
    assert next(r.collapsed_sha256 for r in got if r.doc_id == 6) == hashlib.sha256(b"the same words again").hexdigest()
    assert {figures(r)[0] for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert period_runs.collapse(docs.limit(0)).collect() == []


def test_many_copies_without_id_and_no_damage(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x y " * 30).alias("text"))
    assert {figures(r) for r in period_runs.collapse(period_runs.damaged(docs)).collect()} == {expected("x y " * 30)}
