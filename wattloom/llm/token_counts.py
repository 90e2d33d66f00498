"""Token counts of whole texts for a byte-level BPE vocabulary, by the whole-token shortcut.

The vocabulary's file is read once on the driver, which proves for each of its strings that the merges
leave it as one token when it stands alone. Tasks cut a text into pre-tokens by the vocabulary's pattern:
a pre-token among the proven strings counts one, and only the rest is merged. Special strings inside a
text are one token each, as the library reads them by default; no begin, end or other token is added.

The pattern's letters and numbers come from Unicode tables, which differ in age between libraries. A text
with a code point that is a letter or number in one table and unassigned in another is cut by the
vocabulary's own library.

Defined results: a null text counts as the empty one, 0 bytes and 0 tokens; a long text is
cut word by word, so memory stays bounded; rows that repeat are counted each; a null doc_id stays
null; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from .common import ship, table
from .textops import chunks

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Below are scripts whose tables have not changed for long; a word of these letters only needs no look at newer ones.
DISPUTED_FROM = 0x500
#: A longer text is cut word by word, not into a list. A worker remembers the counts of so many words of so many characters.
BLOCK = 1 << 20
REMEMBERED = 1 << 19
REMEMBERED_CHARS = 64

#: Fixed value: the pattern's white space, and how byte-level vocabularies of this kind cut a text into pre-tokens.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if it is one, else the next free from 256 on."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def whole_tokens(coder: Tokenizer) -> tuple[str, ...]:
    """The vocabulary's strings, as text, that the merges leave as one token. A string that is no valid UTF-8 is no pre-token."""
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    out = []
    for letters in coder.get_vocab(with_added_tokens=False):
        if all(c in byte_of for c in letters) and len(coder.model.tokenize(letters)) == 1:
            try:
                out.append(bytes(byte_of[c] for c in letters).decode())
            except UnicodeDecodeError:
                continue
    return tuple(sorted(out))


@lru_cache(maxsize=1)
def disputed() -> str:
    """A character class of the letters and numbers of one Unicode table that the other does not have."""
    known = regex.compile(r"[\p{L}\p{N}]")
    spans: list[list[int]] = []
    for c in range(DISPUTED_FROM, sys.maxunicode + 1):
        ch = chr(c)
        if unicodedata.category(ch) == "Cn" and known.match(ch):
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]" if spans else r"(?!)"


def checked(description: str) -> Tokenizer:
    """The coder of a vocabulary file's text; other kinds than plain byte-level BPE are an error."""
    told = json.loads(description)
    cut = told.get("pre_tokenizer") or {}
    plain = told.get("model", {}).get("type") == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    specials = [t for t in told.get("added_tokens", ()) if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")]
    if not plain or told.get("normalizer") or specials or told["model"].get("ignore_merges") or told["model"].get("dropout"):
        raise ValueError("the vocabulary must be byte-level BPE without normaliser, prefix space or padded special tokens")
    return Tokenizer.from_str(description)


class Counter:
    """Counts the tokens of texts for one vocabulary."""

    def __init__(self, description: str, whole: tuple[str, ...], newer: str) -> None:
        self.coder = checked(description)
        self.merge = self.coder.model.tokenize
        self.whole = frozenset(whole)
        self.newer, self.later = re.compile(newer), re.compile(f"[^\x00-{chr(DISPUTED_FROM - 1)}]")
        self.cut = regex.compile(PATTERN.format(L=r"\p{L}", N=r"\p{N}")).findall
        self.ascii_cut = re.compile(PATTERN.format(L="A-Za-z", N="0-9"), re.ASCII).findall
        self.words = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
        self.ascii_words = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
        added = [t["content"] for t in json.loads(description).get("added_tokens", ())]
        self.special = re.compile("|".join(re.escape(s) for s in sorted(added, key=len, reverse=True)) or r"(?!)")
        self.letters = dict(enumerate(byte_letters()))
        self.known: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Tokens of a pre-token that is not a whole token: what the merges leave of it."""
        return len(self.merge(piece.encode().decode("latin-1").translate(self.letters)))

    def pieces(self, word: str) -> list[str]:
        """The pre-tokens of a word with the white space before it."""
        if word.isascii():
            return self.ascii_cut(word)
        if not self.later.search(word) or not self.newer.search(word):
            return self.cut(word)
        return [word[a:b] for _, (a, b) in self.coder.pre_tokenizer.pre_tokenize_str(word)]

    def word(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            n = sum(1 if p in self.whole else self.merged(p) for p in self.pieces(word))
            if len(word) <= REMEMBERED_CHARS:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[word] = n
        return n

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings. No pre-token crosses the end of a word, so words are counted on their own."""
        pattern = self.ascii_words if text.isascii() else self.words
        if len(text) <= BLOCK:
            return sum(map(self.word, pattern.findall(text)))
        return sum(self.word(m[0]) for m in pattern.finditer(text))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


@lru_cache(maxsize=2)
def counter_of(description: str, whole: tuple[str, ...], newer: str) -> Counter:
    """One counter for a Python worker, so that what it has counted serves its later tasks too."""
    return Counter(description, whole, newer)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs(doc_id, text)``; ``vocabulary``: a file on the driver."""
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, encoding="utf-8") as f:
        description = f.read()
    proven = spark.sparkContext.broadcast((description, whole_tokens(checked(description)), disputed()))  # one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            counter = counter_of(*proven.value)
            texts = batch.column(1)
            n = [counter.count(t) for t in texts.to_pylist()]
            size = [len(b or b"") for b in texts.cast(pa.binary()).to_pylist()]
            cols = [batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
