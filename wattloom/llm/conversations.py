"""Repair of conversation structure: the cheapest edits that make the roles take turns.

Roles have to read ``(s?(ua)+)?`` by their initials: a system row first if at all, then user and assistant in
turns. Rows may be kept (K, free), given the other role user or assistant (R), deleted (D), and empty rows of either may
be inserted (I); blank and repeated rows have to go, and a truncated row that stays costs more. Of the cheapest
edits those count whose initials, in order, are ASCII-least.

Conversations are dealt out by ``conv_id`` and sorted by turn (a secondary sort, which spills), and stream through
``mapInPandas``. What is carried from row to row, across Arrow batches, is a cost for each of four states
(nothing yet, system, user, assistant), the order of their edit strings, and a running digest of each one's
repaired text. Costs matter by their differences only, so there are few situations; a step is looked up by
situation and kind of row. Its number, two bytes a row, is the back pointer; beyond ``HELD`` rows they go to an
unnamed file of the task and are read back from the end once the conversation is over. So memory does not grow
with a conversation, but for its ``audit`` string, which is a cell of the result.

An edit string that has consumed the same rows as another without an insertion at the end is never
its prefix, so comparing the strings' order at the row before, then what the row adds, is comparing the whole strings.

Which rows are repeated is found before: equal role and text (by digest) of one conversation are counted with
a partial aggregation, and those that come twice give their first turn to the rows by a join.

Defined results: a null turn comes first; equal turns are ordered by role, then text, by code point; a null role, text or id
reads as one space, so a null role has to be changed or deleted and a null text is blank; an empty role
has no initial and cannot be kept. A null conv_id is a conversation of its own and stays null. A conversation whose rows are all dropped
gives zeros, an empty audit and the digest of the empty string. Rows that repeat are duplicates of the
first; a text of any length is one cell; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_few, ship, table, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Back pointers of a conversation that are held in memory; more go to the task's own unnamed file.
HELD = 1 << 20

_SEEN = r"[^\x20\x09-\x0D]"
_START, _S, _U, _A = range(4)
#: The state that a role's initial leads to, and the role that comes next in a state, if one may.
_AFTER = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_U, "a"): _A, (_A, "u"): _U}
_NEXT = {_START: _U, _S: _U, _U: _A, _A: _U}
#: A state that costs more than another and this on top is never on a cheapest way: what follows it can follow the other, after
#: insertions or, for a system row, its deletion. So the differences of costs, and the situations, stay few.
_INSTEAD = {
    _START: [(_A, DELETE), (_U, DELETE + INSERT), (_S, DELETE + 2 * INSERT)],
    _S: [(_A, 0), (_U, INSERT)],
    _U: [(_A, INSERT), (_S, INSERT)],
    _A: [(_U, INSERT), (_S, 2 * INSERT)],
}
_ROLE = {_U: "user", _A: "assistant"}


@dataclass(frozen=True)
class Move:
    """How a state was reached by a row: from which state, after how many insertions, by which edit."""

    source: int
    inserted: int
    edit: str

    @property
    def initials(self) -> str:
        return "I" * self.inserted + self.edit


@dataclass(frozen=True)
class Situation:
    """Cost of each state above the cheapest (None: out of reach) and the place of its edit string among them."""

    cost: tuple[int | None, ...]
    place: tuple[int, ...]


@dataclass(frozen=True)
class Step:
    after: Situation
    least: int
    moves: tuple[Move | None, ...]


BEGIN = Situation((0, None, None, None), (0, 0, 0, 0))


def insertions(state: int) -> list[tuple[int, int]]:
    """States within reach by insertions, with their number; more come back to the same."""
    out = [(state, 0)]
    while len(out) < 3 and _NEXT[out[-1][0]] not in [s for s, _ in out]:
        out.append((_NEXT[out[-1][0]], len(out)))
    return out


def step(now: Situation, initial: str, must_go: bool, truncated: bool) -> Step:
    """The best way to each state over one row."""
    best: dict[int, tuple[int, int, str, Move]] = {}
    for source, cost in enumerate(now.cost):
        if cost is None:
            continue
        for state, n in insertions(source):
            ways = [("D", state, DELETE)]
            if not must_go:
                extra = TRUNCATED if truncated else 0
                ways.append(("R", _NEXT[state], REROLE + extra))
                if (state, initial) in _AFTER:
                    ways.append(("K", _AFTER[state, initial], KEEP + extra))
            for edit, to, price in ways:
                move = Move(source, n, edit)
                way = (cost + n * INSERT + price, now.place[source], move.initials, move)
                if to not in best or way[:3] < best[to][:3]:
                    best[to] = way
    for state in [s for s in best if any(best[s][0] > best[o][0] + price for o, price in _INSTEAD[s] if o in best)]:
        del best[state]
    least = min(w[0] for w in best.values())
    order = sorted(best, key=lambda s: best[s][1:3])
    place = tuple(order.index(s) if s in best else 0 for s in range(4))
    cost = tuple(best[s][0] - least if s in best else None for s in range(4))
    return Step(Situation(cost, place), least, tuple(best[s][3] if s in best else None for s in range(4)))


def ending(now: Situation) -> tuple[int, int, int]:
    """``cost, state, insertions`` of the best way to stop: with nothing, or after an assistant."""
    ways = [(cost + n * INSERT, now.place[s], "I" * n, s, n) for s, cost in enumerate(now.cost) if cost is not None for to, n in insertions(s) if to in (_START, _A)]
    best = min(ways)
    return best[0], best[3], best[4]


class Steps:
    """Steps by number: they are few, since costs differ by little."""

    def __init__(self) -> None:
        self.all: list[Step] = []
        self.number: dict[tuple, int] = {}

    def take(self, now: Situation, initial: str, must_go: bool, truncated: bool) -> int:
        kind = (now, initial if initial in ("s", "u", "a") else "", must_go, truncated)
        n = self.number.get(kind)
        if n is None:
            n = self.number[kind] = len(self.all)
            self.all.append(step(*kind))
        return n


@lru_cache(maxsize=1)
def steps() -> Steps:
    return Steps()


class Trail:
    """Step numbers of a conversation, two bytes each; all but the latest may be in a file."""

    def __init__(self) -> None:
        self.held, self.file = array("H"), None

    def add(self, number: int) -> None:
        self.held.append(number)
        if len(self.held) >= HELD:
            self.file = self.file or tempfile.TemporaryFile()  # noqa: SIM115  closed by the conversation's end
            self.held.tofile(self.file)
            self.held = array("H")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.held)
        size = self.file.tell() if self.file else 0
        while size:
            n = min(size, 2 * HELD)
            self.file.seek(size - n)
            part = array("H")
            part.fromfile(self.file, n // 2)
            yield from reversed(part)
            size -= n

    def close(self) -> None:
        if self.file:
            self.file.close()


@dataclass
class Conversation:
    """One conversation while its rows go by."""

    low: int | None = None
    high: int | None = None
    turns: int = 0
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0))
    last: str | None = None  # initial of the role before
    before: tuple | None = None
    now: Situation = BEGIN
    cost: int = 0
    digests: list = field(default_factory=lambda: [(hashlib.sha256(), True), None, None, None])
    trail: Trail = field(default_factory=Trail)

    def add(self, turn: int | None, role: str, text: str, blank: bool, truncated: bool, in_first_turn: bool, twice: bool) -> None:
        known, row = steps(), (turn, role, text)
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        # of equal rows that share a turn the later ones stand next to the first
        duplicate = twice and (not in_first_turn or self.before == row)
        self.before = row if twice else None
        fault = "blank" if blank else "duplicate" if duplicate else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last = initial
        number = known.take(self.now, initial, fault in ("blank", "duplicate"), fault == "truncated")
        taken = known.all[number]
        self.trail.add(number)
        self.cost += taken.least
        self.now = taken.after
        self.digests = [move and self._digest(move, role, text) for move in taken.moves]

    def _digest(self, move: Move, role: str, text: str):
        """Digests are never changed in place: states share them."""
        found, empty = self.digests[move.source]
        if move.inserted or move.edit != "D":
            found = found.copy()
        state = move.source
        for _ in range(move.inserted):
            state = _NEXT[state]
            found.update(f"{'' if empty else chr(10)}{_ROLE[state]}:".encode())
            empty = False
        if move.edit != "D":
            name = role if move.edit == "K" else _ROLE[_NEXT[state]]
            found.update(f"{'' if empty else chr(10)}{name}:{text}".encode())
            empty = False
        return found, empty

    def row(self) -> tuple:
        cost, state, inserted = ending(self.now)
        final = self._digest(Move(state, inserted, "D"), "", "")[0]
        parts = ["I" * inserted]
        for number in self.trail.backwards():
            move = steps().all[number].moves[state]
            parts.append(move.initials[::-1])
            state = move.source
        self.trail.close()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        audit = "".join(parts)[::-1]
        return (gaps, *self.counts.values(), self.cost + cost, audit, final.hexdigest())


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _repair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and turn; the open conversation is carried from one frame to the next."""
    key, open_, out = None, None, []
    for frame in frames:
        for next_key, there, timed, turn, role, text, blank, truncated, first, twice in frame.itertuples(index=False, name=None):
            if next_key != key:
                if open_:
                    out.append((key, *open_.row()))
                key, open_ = next_key, Conversation()
            if there:
                open_.add(turn if timed else None, role, text, blank, truncated, first == turn, twice)
        if len(out) >= 1000:
            yield pd.DataFrame(out, columns=["key", *COLUMNS])
            out = []
    if open_:
        out.append((key, *open_.row()))
    if out:
        yield pd.DataFrame(out, columns=["key", *COLUMNS])


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id`` and the figures of ``COLUMNS`` for each conversation of ``rows(conv_id, turn, role, text)``.

    A row whose column ``there`` (if it has one) is false only makes its conversation known.
    """
    ship(rows.sparkSession)
    there = F.col("there") if "there" in rows.columns else F.lit(True)
    kind = dict(rows.dtypes)["conv_id"]
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63)))  # before all others, as a null turn is; pandas would make doubles of nulls
    key = F.when(F.col("conv_id").isNotNull(), F.concat(F.lit("="), F.col("conv_id").cast("string"))).otherwise("")
    rows = rows.select(key.alias("key"), there.alias("there"), F.col("turn").isNotNull().alias("timed"), turn.alias("turn"), _text("role").alias("role"), _text("text").alias("text"))
    last = F.regexp_extract("text", rf"({_SEEN})[\x20\x09-\x0D]*\z", 1)
    rows = rows.withColumns({"blank": ~F.col("text").rlike(_SEEN), "truncated": ~last.isin(".", "!", "?"), "digest": F.md5("text")})
    again = rows.where("there").groupBy("key", "role", "digest").agg(F.min("turn").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = written(again.select("key", "role", "digest", "first"), "repeated-turns")
    rows = join_few(rows, again, ["key", "role", "digest"], F.lit(4))
    first, twice = F.coalesce("first", "turn").alias("first"), F.col("first").isNotNull().alias("twice")
    rows = rows.repartition("key").sortWithinPartitions("key", "timed", "turn", "role", "text")
    made = ", ".join(f"{c} {'string' if c in ('audit', 'repaired_sha256') else 'long'}" for c in COLUMNS)
    out = rows.select("key", "there", "timed", "turn", "role", "text", "blank", "truncated", first, twice).mapInPandas(_repair, f"key string, {made}")
    return out.select(F.expr(f"CAST(nullif(substr(key, 2), '') AS {kind})").alias("conv_id") if kind != "string" else F.when(F.col("key") != "", F.expr("substr(key, 2)")).alias("conv_id"), *COLUMNS)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults by the crc32 of ``conv_id:turn``: 0 drops a row (``there`` false), 1 empties it, 2 takes its
    ends of sentences, 3 repeats it, 4 makes its role user."""
    fault = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(_text("text"), "[.!?]", "")).otherwise(_text("text"))
    out = rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(_text("role")).alias("role"), text.alias("text"), (fault != 0).alias("there"), fault.alias("fault"))
    return out.withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("copy", "fault")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


#: The same by a recursion over the rows of all conversations: the best (cost, audit, text) of each state, row by row.
ORACLE = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
fault AS (
  SELECT g.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS f FROM given g, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM fault WHERE f <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS seen FROM damaged),
marked AS (
  SELECT *, CASE WHEN seen = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS i0 FROM placed),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i0 IS NOT NULL AND i0 || i NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id),
inserts(a, b, k, lines) AS (VALUES
  ('', '', 0, ''), ('', 'u', 1, chr(10) || 'user:'), ('', 'a', 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
  ('s', 's', 0, ''), ('s', 'u', 1, chr(10) || 'user:'), ('s', 'a', 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
  ('u', 'u', 0, ''), ('u', 'a', 1, chr(10) || 'assistant:'), ('a', 'a', 0, ''), ('a', 'u', 1, chr(10) || 'user:')),
edits(b, e, c, price) AS (VALUES ('', 'D', '', 4), ('s', 'D', 's', 4), ('u', 'D', 'u', 4), ('a', 'D', 'a', 4), ('', 'R', 'u', 3), ('s', 'R', 'u', 3),
  ('a', 'R', 'u', 3), ('u', 'R', 'a', 3), ('', 'K', 's', 0), ('', 'K', 'u', 0), ('s', 'K', 'u', 0), ('u', 'K', 'a', 0), ('a', 'K', 'u', 0)),
moves AS (SELECT a, e, c, lines, repeat('I', k) || e AS edits, 3 * k + price AS price FROM inserts JOIN edits USING (b)),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, '' AS c, {'cost': 0, 'audit': '', 'lines': ''} AS best FROM conversations
  UNION ALL
  SELECT w.conv_id, w.n + 1, m.c, min({'cost': w.best.cost + m.price + CASE WHEN m.e <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END,
      'audit': w.best.audit || m.edits,
      'lines': w.best.lines || m.lines || CASE m.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
        ELSE chr(10) || CASE m.c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text END})
  FROM walk w JOIN marked r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.n = w.n + 1 JOIN moves m ON m.a = w.c
  WHERE (m.e = 'D' OR r.fault NOT IN ('blank', 'duplicate')) AND (m.e <> 'K' OR m.c = r.i)
  GROUP BY w.conv_id, w.n, m.c),
ends AS (SELECT conv_id, max(n) AS n FROM walk GROUP BY conv_id),
done AS (
  SELECT w.conv_id, min({'cost': w.best.cost + 3 * k, 'audit': w.best.audit || repeat('I', k), 'lines': w.best.lines || x.lines}) AS best
  FROM walk w JOIN ends e ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND w.n = e.n JOIN inserts x ON x.a = w.c AND x.b IN ('', 'a') GROUP BY w.conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.cost::BIGINT AS cost, best.audit AS audit, sha256(substr(best.lines, 2)) AS repaired_sha256
FROM done d LEFT JOIN figures f ON d.conv_id IS NOT DISTINCT FROM f.conv_id
"""
