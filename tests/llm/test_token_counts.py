"""Token counts against the vocabulary's own library."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import DATA
from wattloom.llm import token_counts
from wattloom.llm.common import table

FILE = public_tokenizers.path(token_counts.VOCABULARY)
#: Letters, marks, spaces of many kinds, contractions, special strings whole and cut, letters new in the latest tables.
PARTS = [*"ab '  \n\t\r\x0b.!?,12é漢字🙂́\x00\x85\x1cKst", "　", "​", "﻿", "ſ", " ", "'s", "'ll", "'S", "<|endoftext|>", "<|end", "|>", " the", chr(0x558), chr(0x1E6C0), chr(0x33000), chr(0x16EA0)]


@pytest.fixture(scope="module")
def coder():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def counter():
    with open(FILE, encoding="utf-8") as f:
        told = f.read()
    return token_counts.Counter(told, token_counts.whole_tokens(token_counts.checked(told)), token_counts.disputed())


@pytest.mark.parametrize("block", [token_counts.BLOCK, 5])
def test_random_texts(coder, counter, monkeypatch, block):
    monkeypatch.setattr(token_counts, "BLOCK", block)
    rng = random.Random(block)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(20_000)]
    want = [len(e) for e in coder.encode_batch(texts, add_special_tokens=False)]
    assert [counter.count(t) for t in texts] == want


def test_every_character_in_context(coder, counter):
    """Each code point between letters, digits and marks, doubled and at the end; where tables differ in age, too."""
    texts = [f"a{c}a 1{c}1 !{c}! {c}{c} {c}" for k in range(0x110000) if not 0xD800 <= k < 0xE000 and (k < 0x3400 or k % 17 == 0 or 0x1D000 <= k < 0x1F000) for c in [chr(k)]]
    want = [len(e) for e in coder.encode_batch_fast(texts, add_special_tokens=False)]
    assert [counter.count(t) for t in texts] == want


def test_whole_tokens_are_proven(coder, counter):
    assert len(counter.whole) > 49_000
    for text in random.Random(3).sample(sorted(counter.whole), 5_000):
        assert len(coder.encode(text, add_special_tokens=False)) == 1


def test_forgetting_changes_nothing(coder, counter, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    text = "Unwahrscheinliche Wörter, unwahrscheinliche Wörter; improbable-ish words'll repeat. " * 5
    assert counter.count(text) == len(coder.encode(text, add_special_tokens=False))


def test_whole_table(spark, coder):
    docs = table(spark, f"{DATA}/sf0.01", "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.query(spark, f"{DATA}/sf0.01").collect()}
    want = {}
    for (key, text), e in zip(rows.items(), coder.encode_batch([t or "" for t in rows.values()], add_special_tokens=False), strict=True):
        want[key] = (len((text or "").encode()), len(e), len(e) > 512)
    assert got == want


def test_hard_rows(spark, coder):
    long = "word " * 300_000 + "x" * 100_000
    rows = [(1, None), (2, ""), (None, "a b"), (None, None), (3, "a b"), (3, "a b"), (4, long), (5, " <|endoftext|> "), (6, " x" * 512), (7, " x" * 513)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("n_tokens", "n_bytes", "whole", "batch")})
    got = token_counts.count_tokens(docs, FILE).collect()
    count = lambda t: len(coder.encode(t or "", add_special_tokens=False))
    assert sorted(map(str, got)) == sorted(f"Row(doc_id={i}, n_bytes={len((t or '').encode())}, n_tokens={count(t)}, over_limit={count(t) > 512})" for i, t in rows)
    assert [r.over_limit for r in got if r.doc_id in (6, 7)] == [False, True]
    assert token_counts.count_tokens(docs.limit(0), FILE).collect() == []


def test_other_kinds_of_vocabulary_are_an_error(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
