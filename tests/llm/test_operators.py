"""Operators against brute force, SQL and held-out rows."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tests.compare import connect, same
from tests.conftest import DATA
from wattloom.llm import decontamination, jaccard_join, line_dedup, quality_rules, registry, source_mixing, suffix_dedup, toxicity
from wattloom.llm.common import components, table

TINY, SMALL = f"{DATA}/sf0.001", f"{DATA}/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    same(registry.queries()[name](spark, TINY), connect(TINY), registry.oracle_sql()[name])


def texts(spark, sf):
    return {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def components_by_force(sets, percent=80):
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}


def near_copies(seed, n=240):
    """Groups of edited copies, chains, short texts, shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    out = {}
    while len(out) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 20, 60, 150]))]
        if rng.random() < 0.3:
            base = passage + base
        for _ in range(rng.choice([1, 1, 2, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out[len(out) + 1] = " ".join(copy)
            base = copy if rng.random() < 0.3 else base
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_against_force(spark, seed):
    rows = near_copies(seed)
    got = jaccard_join.near_duplicates(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    sets = {i: shingles(t) for i, t in rows.items()}
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.component_id for r in got} == components_by_force(sets)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 100 + k) for k in range(1, 20)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {100 + k: 100 for k in range(20)} | {200: 200, 201: 200}


def removed_by_force(rows, length=200):
    raw = {i: (t or "").encode() for i, t in rows.items()}
    count = collections.Counter(b[k : k + length] for b in raw.values() for k in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        covered = np.zeros(len(b) + 2, bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                covered[k + 1 : k + length + 1] = True
        keep = bytes(x for x, c in zip(b, covered[1:-1], strict=True) if not c)
        out[i] = (len(b), len(b) - len(keep), int((covered[1:] & ~covered[:-1]).sum()), hashlib.sha256(keep).hexdigest())
    return out


@pytest.mark.parametrize("shard", [1 << 20, 1 << 11])
def test_suffix_dedup_against_force(spark, monkeypatch, shard):
    """The small shard size cuts owners into several shards, so windows meet across shards."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    common, exact, short = letters(260), letters(200), letters(199)
    rows = {k: letters(rng.choice([50, 300, 900])) for k in range(1, 25)}
    rows |= {30 + k: letters(rng.randrange(300)) + common + letters(rng.randrange(300)) for k in range(12)}
    rows |= {50: "x" + exact + "y", 51: exact, 52: "p" + short + "q", 53: short, 54: "ab " * 200, 55: "ab " * 90, 56: None, 57: "", 58: common + common[:250]}
    got = suffix_dedup.dedup(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == removed_by_force(rows)


@pytest.mark.parametrize("shard", [1 << 20, 1 << 11])
def test_suffix_dedup_counts_rows_without_id(spark, monkeypatch, shard):
    """Rows without doc_id that hold whole and partial segments of others, and strings that repeat only there."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    common, other, third = letters(700), letters(500), letters(400)
    named = {1: letters(80) + common[:500] + letters(90), 2: letters(50) + common[100:] + letters(60), 3: letters(70) + common, 4: common}
    named |= {5: letters(100) + other[:300], 6: letters(300), 7: "ab " * 150, 8: third[30:330]}
    nameless = [common, common, letters(40) + other + letters(40), "ab " * 150, third, None, letters(300)]
    rows = [*named.items(), *((None, t) for t in nameless)]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = removed_by_force(named | {f"nameless {k}": t for k, t in enumerate(nameless)})
    found = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    assert found == sorted((i if i in named else 0, *w) for i, w in want.items())


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(5)
    for _ in range(60):
        parts = [bytes(rng.integers(97, 99, rng.integers(1, 40)).astype(np.uint8)) for _ in range(rng.integers(1, 6))]
        parts += parts[:1]
        text, end = np.frombuffer(b"".join(parts), np.uint8), np.repeat(np.cumsum([len(p) for p in parts]), [len(p) for p in parts])
        raw = text.tobytes()
        suffix = lambda i: raw[i : end[i]]  # noqa: E731, B023
        sa = suffix_dedup.suffix_array(text, end)
        assert [suffix(i) for i in sa] == sorted(map(suffix, range(len(raw))))
        prefix, before = suffix_dedup.common_prefixes(text, end, sa)
        for x, y in zip(sa[:-1], sa[1:], strict=True):
            assert prefix[y] == len(os.path.commonprefix([suffix(x), suffix(y)])) and before[y] == x


def base_by_force(text):
    w = WORD.findall(text or "")
    seen = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
    full = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(full) - len(set(full)), len(covered)


def test_quality_rules_against_force(spark):
    rows = texts(spark, TINY)
    got = quality_rules.query(spark, TINY).collect()
    assert {r.doc_id: tuple(r[c] for c in quality_rules.BASE) for r in got} == {i: base_by_force(t) for i, t in rows.items()}
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_trees_are_monotonic():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality_rules.FEATURES)))
    y = (x[:, 2] + 0.5 * np.sin(9 * x[:, 4]) + rng.normal(0, 0.3, 3000) < 0.6).astype(float)
    signs = [quality_rules.MONOTONE.get(f, 0) for f in quality_rules.FEATURES]
    forest = quality_rules.fit_trees(x, y, signs)
    for f, sign in enumerate(signs):
        if sign:
            probe = np.repeat(x[:50], 40, 0)
            probe[:, f] = np.tile(np.linspace(0, 1, 40), 50)
            steps = np.diff(quality_rules.score_trees(forest, probe).reshape(50, 40), axis=1)
            assert (sign * steps >= -1e-12).all()
    p = quality_rules.score_trees(forest, x)
    assert ((p > 0.5) == y).mean() > 0.75


def held_out(spark, name, label):
    import zlib

    truth = {r.doc_id: r[label] for r in table(spark, SMALL, "labels").collect()}
    return [(r, truth[r.doc_id]) for r in registry.queries()[name](spark, SMALL).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and truth.get(r.doc_id) is not None]


@pytest.mark.parametrize(("name", "label", "least"), [("op3_toxicity", "toxic", 0.9), ("op9_quality_classifier", "quality", 0.95)])
def test_held_out_labels(spark, name, label, least):
    rows = held_out(spark, name, label)
    assert len(rows) > 50
    assert np.mean([r.predicted == y for r, y in rows]) >= least


def test_quality_rules_keep_good_rows(spark):
    rows = [(r, y) for r, y in held_out(spark, "op1_quality_rules", "quality") if not r.base_failed]
    assert np.mean([r.kept == (y == 1) for r, y in rows]) > 0.95


def test_language_of_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in table(spark, SMALL, "documents").collect()}
    rows = [r for r in registry.queries()["op4_language_id"](spark, SMALL).collect() if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.97


def test_toxic_words_with_gaps_and_insertions(spark):
    rng = random.Random(2)
    filler = ["".join(rng.choice("aeiournst") for _ in range(rng.choice([3, 4, 6, 8]))) for _ in range(300)]
    rows, labels = [], []
    for k in range(600):
        w = [rng.choice(filler) for _ in range(20)]
        if k % 3 == 0:
            w[rng.randrange(20)] = rng.choice(["blockhead", "dunderpate", "numbskull"])
        rows.append((k, " ".join(w)))
        labels.append((k, int(k % 3 == 0)))
    odd = {1000: "b-l-o-c-k-h-e-a-d", 1001: "blockkhead", 1002: "bl.ockhe_ad", 1003: "n u m b s k u l l", 1004: "numbskulls", 1005: "dunderpatte"}
    rows += [(i, "rain over " + w + " and more") for i, w in odd.items()] + [(2000, "rain over land and more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.detect(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert got[2000] < 0.5 and all(got[i] >= 0.5 for i in odd), {odd.get(i): got[i] for i in [*odd, 2000]}


def test_leaks_against_force(spark):
    docs, items = texts(spark, SMALL), {r.item_id: r.text for r in table(spark, SMALL, "benchmark").collect()}
    got = {(r.doc_id, r.item_id) for r in decontamination.query(spark, SMALL).collect()}
    assert got >= {(i, j) for i, t in docs.items() for j, x in items.items() if x in t}
    for i, j in got:
        a, b = shingles(docs[i], 3), shingles(items[j], 3)
        assert len(a & b) * 3 >= len(b)


def test_edited_copies_of_items_leak(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    some = lambda n: " ".join(word() for _ in range(n))
    items, rows = {}, {}
    for k, (q, a) in enumerate([(24, 1), (24, 2), (20, 4), (24, 5), (30, 6), (30, 7), (9, 3), (40, 24)]):
        question, answer = some(q), some(a)
        items[k] = f"{question}. {answer}."
        edited = answer.split()
        edited[a // 2] = "changed"
        copies = [items[k], f"{question}. {' '.join(edited)}.", f"{question[: question.index(' ')]} changed {question.split(' ', 2)[2]}. {answer}."]
        copies += [f"{question}."] if a <= decontamination.SHORT_ANSWER else []
        rows |= {(k, n): f"{some(90)} {x} {some(90)}" for n, x in enumerate(copies)}
    items[99] = some(30) + ". " + some(30) + "."  # the question alone is not an item with a long answer
    rows[99, 0] = f"{some(90)} {items[99].split('.')[0]} {some(90)}"
    docs = spark.createDataFrame([(k * 10 + n, t) for (k, n), t in rows.items()], "doc_id long, text string")
    got = decontamination.contaminated(docs, spark.createDataFrame(list(items.items()), "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(k * 10 + n, k) for k, n in rows if k != 99}


def test_rows_without_id_are_cleaned_and_deduplicated(spark):
    rng = random.Random(9)
    some = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    item, lost, clean, near, twice, other, lone = some(30), some(30), some(80), some(80), some(80), some(80), some(80)
    rows = [(None, f"{some(40)} {item}"), (1, f"{some(40)} {lost}"), (None, clean), (2, near), (3, f"{some(40)} {item}"), (3, twice)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (None, lost), (None, item)], "item_id long, text string")
    assert {(r.doc_id, r.text) for r in decontamination.clean(docs, items).collect()} == {(None, clean), (2, near), (3, twice)}
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()} == {(None, 7), (1, None), (3, 7)}

    rows = [(None, clean), (None, clean), (None, clean + " end"), (None, near), (5, near + " end"), (6, twice), (6, twice)]
    rows += [(8, other), (8, lone), (9, other + " end"), (10, ""), (10, ""), (11, ""), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in jaccard_join.keep_one(docs).collect()), key=str)
    assert len(got) == 8 and sum(t in (clean, clean + " end") for _, t in got) == 1
    assert {(5, near + " end"), (6, twice), (8, lone), (9, other + " end"), (10, ""), (11, ""), (None, None)} <= set(got)


def test_scores_do_not_depend_on_shards(spark, monkeypatch):
    docs, items = table(spark, TINY, "documents"), table(spark, TINY, "benchmark")
    want = sorted(map(tuple, decontamination.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontamination, "SHARD_ITEMS", 7)
    monkeypatch.setattr(decontamination, "SHARDS_A_PASS", 2)
    got = sorted(map(tuple, decontamination.contaminated(docs, items).collect()))
    assert [r[:2] for r in got] == [r[:2] for r in want] and np.allclose(got, want)


def test_wand_finds_what_full_scoring_finds():
    rng = np.random.default_rng(4)
    items = [(k, " ".join(f"t{x}" for x in rng.integers(0, 40, rng.integers(6, 25)))) for k in range(60)]
    shard = decontamination.Shard(items)
    for _ in range(200):
        query = np.unique(rng.integers(0, len(shard.vocabulary), 60))
        full = collections.defaultdict(float)
        for t in query.tolist():
            for item, x in shard.postings[t]:
                full[item] += x
        for threshold in (0.02, 0.1, 0.3):
            got = dict(shard.wand(query, threshold))
            assert set(got) == {i for i, s in full.items() if s >= threshold - 1e-9}
            assert all(abs(got[i] - full[i]) < 1e-9 for i in got)


def test_mix_comes_near_its_targets(spark):
    rows = source_mixing.query(spark, SMALL).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.target, r.source_size].append(r)
    assert abs(sum(t for t, _ in by) - sum(s for _, s in by)) < 1e-6 * sum(s for _, s in by)
    for (target, size), group in by.items():
        assert target <= 3 * size + 1e-9
        assert abs(sum(r.taken for r in group) - target) <= 3 * max(r.size for r in group)
        assert all(r.taken <= 3 * r.size for r in group)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, source_mixing.query(spark, SMALL).collect()))


def lines_by_force(rows):
    seen, out = set(), {}
    for i in sorted(rows):
        ls = (rows[i] or "").split("\n")
        gone = set()
        for k in range(len(ls) - 2):
            w = tuple(ls[k : k + 3])
            if WORD.search("".join(w)):
                gone |= {k, k + 1, k + 2} if w in seen else set()
                seen.add(w)
        out[i] = "\n".join(x for k, x in enumerate(ls) if k not in gone)
        if gone and not out[i].strip():
            del out[i]
    return out


def test_pipeline_against_force(spark):
    """Every stage on its own input; the fitted forest's verdict is taken from its own query."""
    docs = table(spark, TINY, "documents")
    steps = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, TINY), "test")
        steps.append(docs.collect())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == table(spark, TINY, "documents").columns
    kept = {r.doc_id for r in quality_rules.query(spark, TINY).collect() if r.kept}
    got = [{r.doc_id: r.text for r in s} for s in steps]
    start = texts(spark, TINY)
    assert got[0] == {i: start[i] for i in kept}
    assert got[1] == lines_by_force(got[0])
    comp = components_by_force({i: shingles(t) for i, t in got[1].items()})
    assert set(got[2]) == {i for i, c in comp.items() if i == c}
    items = [r.text for r in table(spark, TINY, "benchmark").collect()]
    assert set(got[3]) == {i for i, t in got[2].items() if not any(x in t for x in items)}
    size = sum(len(WORD.findall(t)) for t in got[3].values())
    assert set(got[4]) <= set(got[3]) and 0.7 * size < sum(len(WORD.findall(r.text)) for r in steps[4]) < 1.3 * size
    assert sorted(map(tuple, corpus_pipeline.run(spark, TINY).collect()), key=str) == sorted(map(tuple, steps[4]), key=str)


def test_line_windows_blank_lines_and_gaps(spark):
    rows = {1: "a\nb\nc\nd", 2: "x\na\nb\nc\ny", 3: "\n\n\n\n", 4: "\n\n\nz", 5: "a\nb\nc", 6: "a\nb"}
    got = line_dedup.dedup_lines(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.text, r.n_removed, r.emptied) for r in got} == {1: ("a\nb\nc\nd", 0, False), 2: ("x\ny", 3, False), 3: ("\n\n\n\n", 0, False), 4: ("\n\n\nz", 0, False), 5: ("", 3, True), 6: ("a\nb", 0, False)}
