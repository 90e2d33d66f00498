"""Defined results, plans that stay linear, and operators against plain versions of themselves."""

import collections
import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.test_operators import LOWER, SMALL, TINY, WORD, held_out, near_copies, removed_by_force, shingles, texts
from wattloom.llm import (
    common,
    decontamination,
    jaccard_join,
    language_id,
    license_scan,
    license_texts,
    line_dedup,
    quality_classifier,
    quality_rules,
    registry,
    source_mixing,
    suffix_dedup,
    toxicity,
)
from wattloom.llm import textops as tx
from wattloom.llm.common import table

ID_TEXT = "doc_id long, text string"


def letters(rng, n):
    return "".join(rng.choice("abcdé ") for _ in range(n))


# op7


def test_suffix_dedup_one_id_with_several_texts(spark):
    rng = random.Random(12)
    common_part, other = letters(rng, 400), letters(rng, 350)
    rows = [(9, "x" + common_part + "y"), (9, letters(rng, 300)), (9, other), (None, common_part), (None, letters(rng, 70) + other), (4, letters(rng, 260)), (9, other)]
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(spark.createDataFrame(rows, ID_TEXT)).collect())
    assert got == sorted(removed_by_force({k: t for k, (_, t) in enumerate(rows)}).values())


def test_suffix_dedup_of_a_text_in_pieces(spark):
    """Repeats over the cut between two pieces, inside one long text and between it and a short one."""
    rng = np.random.default_rng(2)
    long = bytes(rng.integers(97, 123, suffix_dedup.PIECE_BYTES + 500_000).astype(np.uint8)).decode()
    cut = suffix_dedup.PIECE_BYTES
    rows = [(1, long), (2, "--" + long[cut - 150 : cut + 150] + "--"), (3, long[1000:1250] + "." + long[-240:])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.dedup(spark.createDataFrame(rows, ID_TEXT)).collect()}
    assert got == {1: (len(long), 790, 3), 2: (304, 300, 1), 3: (491, 490, 2)}


# op2


def test_documents_on_a_template_form_no_pairs(spark):
    """Texts that share 85 of 100 shingles link with nothing: they meet on each shingle of the template, and no pair may come of it."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    template = [word() for _ in range(89)]
    rows = [(k, " ".join(template + [word() for _ in range(15)])) for k in range(300)]
    rows += [(1000 + k, t.replace(template[40], "changed")) for k, t in rows[:5]]
    docs = spark.createDataFrame(rows, ID_TEXT)
    sketches, classes = jaccard_join._classes(docs, 80)
    _, heads = jaccard_join._prefixes(docs, sketches, classes, 80)
    assert heads.groupBy("shingle").count().agg(F.max("count")).first()[0] >= 300
    alone = heads.select(F.col("doc").alias("node"), F.col("doc").alias("component_id")).distinct()
    assert jaccard_join.other_pairs(heads, alone, 80).count() <= 20
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == {k: k % 1000 for k, _ in rows}


@pytest.mark.parametrize("seed", [3, 4])
def test_all_pairs_against_force(spark, seed):
    rows = near_copies(seed, 160)
    pairs, members = jaccard_join.similar_pairs(spark.createDataFrame(list(rows.items()), ID_TEXT))
    sets = {i: shingles(t) for i, t in rows.items() if t}
    rep = {}
    for i in sorted(sets):
        rep.setdefault(sets[i], i)
    assert {(r.doc_id, r.rep) for r in members.collect()} == {(i, rep[s]) for i, s in sets.items()}
    ids = sorted(rep.values())
    want = {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    got = [(r.a, r.b) for r in pairs.collect()]
    assert {(min(p), max(p)) for p in got} == want and len(got) == len(want)


def test_joins_by_shuffle_give_the_same(spark, monkeypatch):
    docs = table(spark, TINY, "documents").select("doc_id", "text")
    run = lambda: [sorted(map(tuple, x.collect())) for x in (jaccard_join.near_duplicates(docs), suffix_dedup.dedup(docs), line_dedup.dedup_lines(docs))]
    want = run()
    monkeypatch.setattr(common, "BROADCAST_IDS", 0)
    assert run() == want


def test_scratch_tables_go(spark):
    folder = f"{common.work_dir(spark).removeprefix('file://')}/wattloom"
    docs = table(spark, TINY, "documents").select("doc_id", "text")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    jaccard_join.near_duplicates(docs).count()
    assert len(set(os.listdir(folder)) - before) == 1


# op3


def test_folded_table_gives_the_kernel_sum():
    """The table's margins are those of a plain sum of kernels with landmarks, counted subsequence by subsequence."""
    rng = random.Random(3)
    rows = [" " + "".join(rng.choice("abcdefg") for _ in range(n)) + " " + "".join(rng.choice("abcdefg") for _ in range(5)) + " " for n in (3, 4, 6, 8, 9, 5, 7, 4)]

    def phi(row):
        out = collections.Counter()
        for at in range(len(row)):
            for a, b, c, w in toxicity._SHAPES:
                if at + c < len(row):
                    part = np.array([ord(row[at + k]) for k in (0, a, b, c)], np.uint64)
                    h = np.uint64((sum(int(x) * int(k) for x, k in zip(part, toxicity._AT, strict=True))) % 2**64)
                    h ^= h >> np.uint64(29)
                    out[int((int(h) * 0xBF58476D1CE4E5B9 % 2**64) >> (64 - toxicity.TABLE_BITS))] += w
        size = math.sqrt(sum(w * w * max(len(row) - c, 0) for _, _, c, w in toxicity._SHAPES))
        return {k: v / size for k, v in out.items()}

    sparse, marks = [phi(r) for r in rows], [1, 4, 6]
    dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
    kernel, ids, dense = toxicity.Rows(rows).kernel(np.array(marks))
    assert np.allclose(kernel, [[dot(x, sparse[m]) for m in marks] for x in sparse], atol=1e-6)
    alpha = np.array([0.7, -1.3, 0.4])
    weights = np.zeros(1 << toxicity.TABLE_BITS)
    weights[ids] = dense @ alpha
    for x, row in zip(sparse, rows, strict=True):
        stream = np.array([ord(c) for c in row], np.uint32)
        got = toxicity.margins(stream, np.array([0]), np.array([len(row)]), weights, 0.25)[0]
        assert abs(got - (0.25 + sum(a * dot(x, sparse[m]) for a, m in zip(alpha, marks, strict=True)))) < 1e-5


def test_windows_of_words_and_sentences():
    got = toxicity.windows(pa.array(["One b-i.g cat. Two\nA b c dog!", None, "", "... 12", "ÉTÉ x y"]))
    stream, begin, end, doc = got
    rows = ["".join(map(chr, stream[a:b])) for a, b in zip(begin, end, strict=True)]
    assert list(zip(doc.tolist(), rows, strict=True)) == [(0, " one big "), (0, " big cat "), (0, " two "), (0, " abc dog "), (4, " été xy ")]


def test_toxicity_beats_never_on_held_out_labels(spark):
    rows = held_out(spark, "op3_toxicity", "toxic")
    hit = sum(r.predicted and y for r, y in rows)
    toxic, said = sum(y for _, y in rows), sum(r.predicted for r, _ in rows)
    assert hit >= 0.6 * toxic and hit >= 0.6 * said
    assert np.mean([r.predicted == y for r, y in rows]) > max(np.mean([y == 0 for _, y in rows]), 0.9)
    best = [r.score for r, y in rows if y]
    assert np.mean([s > r.score for s in best for r, y in rows if not y]) > 0.75


def test_few_labels_still_give_scores(spark):
    rows = toxicity.query(spark, TINY).collect()
    truth = {r.doc_id: r.toxic for r in table(spark, TINY, "labels").collect()}
    known = [(r.score, truth[r.doc_id]) for r in rows if truth.get(r.doc_id) is not None]
    assert len({r.score for r in rows}) > 100
    assert np.mean([s > t for s, a in known if a for t, b in known if not b]) > 0.9


# op4


def test_language_of_short_texts_only(spark):
    rng = random.Random(1)
    english = "the house and water with people from there about which would think little".split()
    french = "le chat est sur la table avec vous nous êtes où très déjà".split()
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(k, say(english, 40), "en") for k in range(30)] + [(100 + k, say(french, 4), "fr") for k in range(30)] + [(200, None, "fr"), (201, "123", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, docs).collect()}
    assert all(got[i] == lang for i, _, lang in rows[:60]) and got[200] == got[201] == "und"


def test_language_against_plain_coding(spark):
    docs = table(spark, TINY, "documents")
    known = language_id.dictionaries(docs)
    assert all(len(c.decode()) <= language_id.SAMPLE_CHARS + language_id.SAMPLE_TEXTS for _, c in known)
    for r in language_id.identify(docs, docs).join(docs, "doc_id").collect():
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert r.lang_pred == "und"
            continue
        sizes = []
        for lang, content in known:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append((len(coder.compress(("\n" + r.text.lower()).encode())), lang))
        assert r.lang_pred == min(sizes, key=lambda x: x[0])[1]


# op5


def test_leaks_against_full_scoring(spark):
    """Every passage scored in full against every item, without index, bounds or shards."""
    docs, items = texts(spark, TINY), {r.item_id: r.text for r in table(spark, TINY, "benchmark").collect()}
    rng = random.Random(4)
    some = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    items |= {900: some(100) + ". " + some(30) + ".", 901: some(6) + ". yes."}
    docs |= {9000: some(50) + " " + items[900] + " " + some(500), 9001: items[901], 9002: None}
    found = decontamination.contaminated(spark.createDataFrame(list(docs.items()), ID_TEXT), spark.createDataFrame(list(items.items()), "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.score, r.question_share, r.answer_share) for r in found.collect()}

    words = lambda t: [w.translate(LOWER) for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", t or "")]
    runs = lambda w, n: [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
    bags = {i: collections.Counter(runs(words(t), 3)) for i, t in items.items()}
    df = collections.Counter(t for b in bags.values() for t in b)
    mean = np.mean([sum(b.values()) for b in bags.values()])
    impact = {}
    for i, b in bags.items():
        size = sum(b.values())
        raw = {t: math.log1p((len(bags) - df[t] + 0.5) / (df[t] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * size / mean)) for t, c in b.items()}
        impact[i] = {t: x / sum(raw.values()) for t, x in raw.items()}
    want = {}
    for d, text in docs.items():
        w = words(text)
        for i, item in items.items():
            whole = words(item)
            stride = max(64, 2 ** math.ceil(math.log2(len(whole))))
            cuts = [m.end() for m in re.finditer(r"[.!?\n]+\s*(?=\S)", item)]
            tail = words(item[cuts[-1] :]) if cuts else whole[-5:]
            head = whole[: len(whole) - len(tail)] or whole
            for at in range(0, len(w), stride):
                passage = w[at : at + 2 * stride]
                score = sum(impact[i].get(t, 0) for t in set(runs(passage, 3)))
                if score < 0.5:
                    continue
                share = [np.mean([g in set(runs(passage, n)) for g in set(runs(p, n))]) for p in (head, tail) for n in [max(1, min(5, len(p) // 4))]]
                if min(share) >= 0.5 or len(tail) <= 10 and share[0] >= 0.8:
                    want[d, i] = tuple(map(max, want.get((d, i), (0, 0, 0)), (score, *share)))
    assert (9000, 900) in want and set(got) == set(want)
    assert all(np.allclose(got[k], want[k]) for k in got)


def test_single_words_retrieve_no_other_leaks():
    """Runs of three words as terms lose nothing against single words, once question and answer are verified."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(150)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, f"{some(25)}. {some(rng.choice([3, 12]))}.") for k in range(20)]
    texts_ = [f"{some(200)} {t if k % 2 else ' '.join(t.split()[:-2])} {some(100)}" for k, (_, t) in enumerate(items)]
    found = []
    for n in (3, 1):
        old, decontamination.TERM_WORDS = decontamination.TERM_WORDS, n
        shard = decontamination.Shard(items)
        w, doc = decontamination.terms(*tx.text_bytes(pa.array(texts_)))
        found.append({(d, i) for d, i, *_ in shard.search(w, doc, len(texts_), 64, decontamination.THRESHOLD)})
        decontamination.TERM_WORDS = old
    assert found[0] == found[1] and len(found[0]) >= 20


# op6


def test_whole_licences_in_other_layouts(spark):
    bsd = next(t for i, t in license_texts.LICENSES if i == "BSD-3-Clause")
    wrapped = "Copyright The Foo Authors\nCopyright (c) 2020, X\n\n" + re.sub(r"(.{60}\S*) ", r"\1\n", bsd).replace('"AS IS"', "``AS IS''")
    rows = [(1, wrapped), (2, bsd[:-20]), (3, "Copyright by nobody\n" + next(t for i, t in license_texts.LICENSES if i == "Unlicense"))]
    names = {"Apache-2.0": "Apache-2.0", "GPL-3.0": "GPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    folder = "/usr/share/common-licenses/"
    for k, (_, f) in enumerate(names.items()):
        if os.path.exists(folder + f):
            with open(folder + f) as file:
                rows.append((10 + k, file.read()))
    got = {(r.doc_id, r.license_id) for r in license_scan.scan(spark.createDataFrame(rows, ID_TEXT)).where("whole").collect()}
    assert got == {(1, "BSD-3-Clause"), (3, "Unlicense")} | {(10 + k, i) for k, i in enumerate(names) if 10 + k in dict(rows)}


def test_licences_of_a_table(spark):
    known = license_scan.digests(spark.createDataFrame([("house", "Our house rules.\nBe kind.")], "license_id string, text string"))
    docs = spark.createDataFrame([(1, "OUR HOUSE-RULES!\n\nbe kind"), (2, "be kind")], ID_TEXT)
    assert [tuple(r) for r in license_scan.scan(docs, known).collect()] == [(1, "house", 0, True)]


# op9, op1


def test_word_vectors_and_pooling_against_loops(spark):
    rows = ["The cat sat. the CAT, 42 times!", "a b a b a b", "", None, "cat 42 cat"]
    docs = spark.createDataFrame(list(enumerate(rows)), ID_TEXT).repartition(3)
    size = 64
    got = quality_classifier.word_vectors(docs, size)
    kind = re.compile(r"[A-Za-z\x80-\U0010ffff]+|[0-9]+|[^\x20\x09-\x0D0-9A-Za-z\x80-\U0010ffff]+")
    total = np.zeros((size, quality_classifier.DIMENSIONS))
    hashes = []
    for t in rows:
        h, _, _ = quality_classifier.tokens(pa.array([t or ""]))
        assert len(h) == len(kind.findall(t or ""))
        hashes.append([int(x) for x in h])
        for i, me in enumerate(hashes[-1]):
            for j in range(max(0, i - 2), min(len(h), i + 3)):
                for k in range(quality_classifier.MARKS_PER_INDEX if i != j else 0):
                    other = hashes[-1][j]
                    total[me % size, (other >> (20 + 8 * k)) % 64] += 1 - 2 * ((other >> (50 + k)) & 1)
    want = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)
    assert np.allclose(got, want, atol=1e-6)
    x = quality_classifier.pool(pa.array(rows, pa.string()), got)
    for h, row in zip(hashes, x, strict=True):
        assert np.allclose(row[:64], np.mean([want[i % size] for i in h], axis=0) if h else 0, atol=1e-5)
        assert np.allclose(row[64:], [sum(a % size == b % size for a, b in zip(h, h[1:], strict=False)) / max(len(h), 1), math.sqrt(sum((c / len(h)) ** 2 for c in collections.Counter(i % size for i in h).values())) if h else 0, math.log1p(len(h))], atol=1e-5)


def test_flat_forest_against_walking():
    rng = np.random.default_rng(2)
    x = rng.random((500, len(quality_rules.FEATURES)))
    forest = quality_rules.fit_trees(x, (x[:, 0] > x[:, 3]).astype(float), [0] * x.shape[1])
    for row, got in zip(x[:60], quality_rules.score_trees(forest, x[:60]), strict=True):
        margin = float(forest["start"])
        for feature, cut, value in zip(forest["feature"], forest["cut"], forest["value"], strict=True):
            node = 0
            while feature[node] >= 0:
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            margin += value[node]
        assert abs(got - 1 / (1 + math.exp(-margin))) < 1e-9


def test_labels_and_documents_that_repeat(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    labels = quality_rules.labelled(spark, SMALL)
    once = quality_rules.fit(docs, labels)
    again = quality_rules.fit(docs.unionByName(docs.limit(300)), labels.unionByName(labels.limit(200)).unionByName(labels))
    assert all(np.array_equal(once[k], again[k]) for k in once)
    got = common.learnable(docs.unionByName(docs), labels.unionByName(labels), "quality", 50)
    assert got.count() == 50 and got.select("doc_id").distinct().count() == 50


def test_held_out_is_false_without_id(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, TINY, name).limit(150).withColumn("doc_id", F.when(F.col("doc_id") % 10 > 0, F.col("doc_id"))).write.parquet(f"file://{tmp_path}/{name}.parquet")
    for name in ("op3_toxicity", "op4_language_id", "op9_quality_classifier"):
        rows = registry.queries()[name](spark, f"file://{tmp_path}").collect()
        nameless = [r for r in rows if r.doc_id is None]
        assert nameless and not any(r.held_out is not False for r in nameless) and any(r.held_out for r in rows), name


# op10, op8 and columns


def test_lines_left_with_a_word_of_odd_space(spark):
    rows = [(1, "a\nb\nc"), (2, "\xa0\na\nb\nc"), (3, " \t\na\nb\nc")]
    assert {r.doc_id: (r.n_removed, r.emptied) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, ID_TEXT)).collect()} == {1: (0, False), 2: (3, False), 3: (3, True)}


def test_a_line_that_all_documents_share(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.format_string("first %d\nsame a\nsame b\nsame c\nlast %d", "id", "id").alias("text"))
    got = line_dedup.dedup_lines(docs)
    assert got.agg(F.sum("n_removed")).first()[0] == 3 * 2999
    assert got.where("doc_id = 0").first().text == "first 0\nsame a\nsame b\nsame c\nlast 0"


def test_taken_and_dotted_column_names(spark):
    docs = table(spark, TINY, "documents").limit(40)
    for c in ("kept", "_kept", "n_lines", "_n_lines", "__n_lines", "copy", "_copy", "Emptied", "a.b"):
        docs = docs.withColumn(c, F.lit(c))
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "___n_lines", "n_removed", "_emptied"]
    assert {r["a.b"] for r in out.collect()} == {"a.b"}
    mix = source_mixing.mixed(docs)
    assert mix.columns == [*docs.columns, "__copy"] and mix.first()["_copy"] == "_copy"
    labels = table(spark, TINY, "labels")
    out = quality_rules.judge(docs.drop("a.b"), labels, docs.drop("a.b").columns)
    assert out.columns[-1] == "__kept" and out.first()["kept"] == "kept"


def test_work_folder_must_be_named_on_a_cluster():
    class Conf(dict):
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        common.work_dir(Cluster())


def test_word_pattern_of_the_contract(spark):
    docs = spark.createDataFrame([(1, "a\x0bb\x1cc\xa0d e\n")], ID_TEXT).withColumn("source", F.lit("s"))
    assert docs.select(source_mixing.word_count("text").alias("n")).first().n == len(WORD.findall("a\x0bb\x1cc\xa0d e\n")) == 3
