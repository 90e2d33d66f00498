"""Conversation repair against a plain search over whole edit strings, and giant conversations."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from wattloom.llm import conversations
from wattloom.llm.common import table

SEEN = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def faults_of(rows):
    out, seen = [], set()
    for _, role, text in rows:
        marks = SEEN.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Every state with its least ``(cost, audit)`` and the lines there, row by row; insertions are tried up to two at a place."""

    def with_insertions(best):
        for _ in range(2):
            for state, (cost, audit, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    if role[0] in NEXT[state]:
                        put(best, role[0], cost + 3, audit + "I", [*lines, f"{role}:"])
        return best

    def put(best, state, cost, audit, lines):
        if state not in best or (cost, audit) < best[state][:2]:
            best[state] = (cost, audit, lines)

    # strings are compared after each row's edit, as insertions make one string the beginning of another
    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        ways = [(s, *w) for s, w in best.items()]
        for s, cost, audit, lines in list(ways):
            chain = [(s, cost, audit, lines)]
            for _ in range(2):
                s2, c2, a2, l2 = chain[-1]
                r = "user" if "u" in NEXT[s2] else "assistant"
                chain.append((r[0], c2 + 3, a2 + "I", [*l2, f"{r}:"]))
            for s2, c2, a2, l2 in chain:
                put(after, s2, c2 + 4, a2 + "D", l2)
                if fault in ("blank", "duplicate"):
                    continue
                extra = 3 if fault == "truncated" else 0
                if role[:1] and role[0] in NEXT[s2]:
                    put(after, role[0], c2 + extra, a2 + "K", [*l2, f"{role}:{text}"])
                for other in ("user", "assistant"):
                    if other[0] in NEXT[s2]:
                        put(after, other[0], c2 + 3 + extra, a2 + "R", [*l2, f"{other}:{text}"])
        best = after
    final = with_insertions(best)
    return min(final[s] for s in ("", "a") if s in final)


def expected(rows):
    """``rows``: ``(turn, role, text)`` after damage, in any order."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [t for t, *_ in rows if t is not None]
    faults = faults_of(rows)
    cost, audit, lines = cheapest(rows, faults)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines)))


def figures(r):
    return tuple(r[c] for c in conversations.COLUMNS)


def made_rows(rng, n):
    texts = ["Yes.", "No!", "And then", "", " ", "Why? ", "Because.\n", None, "it goes on", "the end."]
    roles = ["user", "assistant"] * 4 + ["system", "system", None, "tool", "", "sys", "umbrella"]
    return [(rng.choice([None, *range(-3, 12)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randrange(50)}" + rng.choice([".", "?", "", "!"])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, monkeypatch, seed):
    rng = random.Random(seed)
    by_id = {k: made_rows(rng, rng.choice([0, 1, 2, 3, 5, 9, 14])) for k in range(250)}
    by_id[None] = made_rows(rng, 7)
    flat = [(k, *r) for k, rows in by_id.items() for r in rows]
    rng.shuffle(flat)
    got = conversations.repair(spark.createDataFrame(flat, "conv_id long, turn long, role string, text string").repartition(5)).collect()
    assert {r.conv_id: figures(r) for r in got} == {k: expected(rows) for k, rows in by_id.items() if rows}


def damaged_by_force(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        mine = out.setdefault(conv_id, [])
        blank = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{blank(conv_id)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        mine += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def test_whole_table(spark):
    sf = f"{DATA}/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = {k: expected(v) for k, v in damaged_by_force(rows).items()}
    assert {r.conv_id: figures(r) for r in conversations.query(spark, sf).collect()} == want


def test_hard_rows(spark):
    rows = [(1, 0, "user", "a."), (1, 2**62 + 1, "assistant", "b."), (1, 2**62 + 3, "user", "b."), (2, None, None, None), (None, 1, "user", "x" * 2_000_000), (None, None, "system", "s."), (3, 5, "user", "q?"), (3, 5, "user", "q?"), (3, 5, "assistant", "r.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(c) for c in ("key", "first", "blank", "digest")})
    want = {}
    for c, *rest in rows:
        want.setdefault(c, []).append(tuple(rest))
    assert {r.conv_id: figures(r) for r in conversations.repair(df).collect()} == {c: expected(v) for c, v in want.items()}
    assert conversations.repair(df.limit(0)).collect() == []
    gone = conversations.repair(df.withColumn("there", F.lit(False))).collect()
    assert len(gone) == 4 and {figures(r) for r in gone} == {(0,) * 6 + ("", sha(""))}
    other = df.withColumn("conv_id", F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    assert {r.conv_id for r in conversations.repair(other).collect()} == {"c1", "c2", "c3", None}


def test_giant_conversation_spills_its_trail(spark, monkeypatch):
    """In pieces of 1,000 back pointers, over many Arrow batches; the situations stay few."""
    rng = random.Random(9)
    rows = [(t, rng.choice(["user", "assistant", "system"]), f"t{t}" + rng.choice(["", ".", "!"])) for t in range(30_000)]
    monkeypatch.setattr(conversations, "HELD", 1000)
    one = conversations.Conversation()
    for t, role, text in rows:
        one.add(t, role, text, False, text[-1] not in ".!?", True, False)
    assert one.trail.file is not None
    assert one.row()[5:] == expected_cost_only(rows)
    df = spark.createDataFrame([(7, *r) for r in rows], "conv_id long, turn long, role string, text string").repartition(6)
    got = figures(conversations.repair(df).collect()[0])
    assert got[5:] == expected_cost_only(rows)
    assert len(conversations.steps().all) < 3000


def expected_cost_only(rows):
    """As ``cheapest``, with texts of edits and lines kept as back links, so that length does not matter."""
    now = conversations.BEGIN
    cost, links = 0, [(None, "", [])] + [None] * 3
    for _, role, text in rows:
        taken = conversations.step(now, role[0], False, text[-1] not in ".!?")
        new = []
        for m in taken.moves:
            if m is None:
                new.append(None)
                continue
            state, lines = m.source, []
            for _ in range(m.inserted):
                state = conversations._NEXT[state]
                lines.append(f"{conversations._ROLE[state]}:")
            if m.edit != "D":
                lines.append(f"{role if m.edit == 'K' else conversations._ROLE[conversations._NEXT[state]]}:{text}")
            new.append((links[m.source], m.initials, lines))
        links, now, cost = new, taken.after, cost + taken.least
    more, state, n = conversations.ending(now)
    audit, lines, end = [], [], links[state]
    while end:
        audit.append(end[1])
        lines.append(end[2])
        end = end[0]
    tail = [f"{('user', 'assistant')[(k + (state == conversations._U)) % 2]}:" for k in range(n)]
    return (cost + more, "".join(reversed(audit)) + "I" * n, sha("\n".join([x for part in reversed(lines) for x in part] + tail)))
