"""Repair of the structure of conversations at least cost.

A repaired conversation has the role initials ``(s?(ua)+)?``: nothing, or an
optional system turn and then pairs of user and assistant.  Rows are kept (cost
0), given the role user or assistant (2) or deleted (3, a must where the text is
blank or repeated); empty turns may be inserted anywhere (2); a truncated row
that stays adds 1.  Of the cheapest edits those whose letters (K, R, D, I in
order) come first in ASCII are taken.

One exchange brings a conversation into one partition.  There it is sorted and
streamed twice, with Spark's own external sorts between:

1. backward, last turn first.  What remains to be paid from each of the four
   states of the grammar is all the state there is, four numbers, carried from
   one Arrow batch to the next.  Each row gets one byte: for each state the
   letter to take, two bits.  These backpointers leave with their rows, so a
   conversation of any length is spilled by Spark's sort, not held here;
2. forward.  The bytes are followed from the first turn on.  As each row's
   letter is the least of the cheapest ones, so is their sequence.

A conversation's digest runs over its turns in order, so one conversation is
one stream in one task; memory holds one Arrow batch of it and its letters.

Edge cases: nulls in ``conv_id`` are one conversation; a null turn comes before
all others; null role or text stands for one space.  Rows of one turn are
ordered by role, then text; rows equal in all are interchangeable, but the first
of them is the one not repeated.  An empty role fits nowhere.  Very long texts
pass through with their batch (``BATCH_ROWS`` rows).  An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
BLANKS = " \t\n\x0b\x0c\r"
CLOSING = [".", "!", "?"]
#: states of the grammar: nothing yet, after the system turn, after a user, after an assistant
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
#: where a kept initial leads
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: the turn that a new or rewritten role must be, and where it leads
NEEDED = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
LETTERS = "DIKR"  # in ASCII order
LEGAL = ("su", "ua", "au")
WORK = "conv string, absent boolean, turn {turn}, known boolean, role string, text string, fault string, again boolean"
_ORDER = ["conv", "absent", "known", "turn", "role", "text", "again"]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in, by ``crc32(conv_id:turn) % 20``: 0 marks a row
    ``absent``, 1 empties its text, 2 takes the closing marks out, 3 repeats it,
    4 makes it the user's.  Nulls count as one space; conv_id and turn stay."""
    space = F.lit(" ")
    role, text = (F.coalesce(c, space) for c in ("role", "text"))
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), space) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                (F.crc32(key.cast("binary")) % 20).cast("int").alias("kind"))
    kind = F.col("kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", "".join(CLOSING), "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("absent"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("col")


def _planned(rows: DataFrame) -> DataFrame:
    """Rows with their fault and backpointers, each conversation in one
    partition.  ``absent`` rows (see ``damaged``) only name their conversation."""
    from pyspark.sql import Window

    absent = F.col("absent") if "absent" in rows.columns else F.lit(False)
    turn = rows.schema["turn"].dataType.simpleString()
    space = F.lit(" ")
    dealt = rows.select(
        F.when(F.col("conv_id").isNull(), "-").otherwise(F.concat(F.lit(":"), F.col("conv_id").cast("string"))).alias("conv"),
        F.coalesce(absent, F.lit(False)).alias("absent"), F.coalesce("turn", F.lit(0).cast(turn)).alias("turn"),
        F.col("turn").isNotNull().alias("known"), F.coalesce("role", space).alias("role"),
        F.when(absent, "").otherwise(F.coalesce("text", space)).alias("text")).repartition("conv")
    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    # the exchange by conversation serves this window too
    order = Window.partitionBy("conv", "absent", "role", "text").orderBy("known", "turn")
    fault = (F.when(ended == "", "blank").when(F.col("again"), "duplicate")
             .when(~F.substring(ended, -1, 1).isin(CLOSING), "truncated"))
    flagged = dealt.withColumn("again", F.row_number().over(order) > 1).withColumn("fault", fault)
    schema = WORK.format(turn=turn)
    names = [part.split()[0] for part in schema.split(", ")]
    return (flagged.select(*names).sortWithinPartitions(_ORDER[0], *(F.col(c).desc() for c in _ORDER[1:])).mapInPandas(_backward, f"{schema}, choices int")
            .sortWithinPartitions(*_ORDER))


def _options(ahead: list[int], initial: str, fault: str | None, state: int) -> Iterator[tuple[int, str]]:
    """Cost from a state on, by the letter for the row that is next; inserting
    leads to a state before the same row and is settled by the caller."""
    yield COSTS[DELETE] + ahead[state], DELETE
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED_COST if fault == "truncated" else 0
        to = STEPS.get((state, initial))
        if to is not None:
            yield extra + ahead[to], KEEP
        yield COSTS[REROLE] + extra + ahead[NEEDED[state][1]], REROLE


def _with_inserts(best: list[int]) -> list[int]:
    """Costs when a missing turn may be inserted first: two are enough, as more
    come back to the same state."""
    for _ in range(2):
        best = [min(best[s], COSTS[INSERT] + best[NEEDED[s][1]]) for s in range(4)]
    return best


END = _with_inserts([0 if s in FINAL else 10**9 for s in range(4)])


def _backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, ahead, known = None, END, {}
    for b in batches:
        choices = []
        for c, absent, role, fault in zip(b["conv"], b["absent"], b["role"], b["fault"], strict=True):
            if c != conv:
                conv, ahead = c, END
            if absent:
                choices.append(0)
                continue
            # costs that differ by a constant choose alike, so few cases ever occur
            low = min(ahead)
            case = (*(x - low for x in ahead), role[:1], fault)
            if case not in known:
                known[case] = _step(list(case[:4]), role[:1], fault)
            costs, byte = known[case]
            ahead = [x + low for x in costs]
            choices.append(byte)
        yield b.assign(choices=choices)


def _step(ahead: list[int], initial: str, fault: str | None) -> tuple[list[int], int]:
    """Costs before a row from those after it, and the letters of its states,
    two bits each."""
    options = [dict((letter, cost) for cost, letter in _options(ahead, initial, fault, s)) for s in range(4)]
    costs = _with_inserts([min(o.values()) for o in options])
    byte = 0
    for s, o in enumerate(options):
        o[INSERT] = COSTS[INSERT] + costs[NEEDED[s][1]]
        letter = min(x for x, cost in o.items() if cost == costs[s])
        byte |= LETTERS.index(letter) << (2 * s)
    return costs, byte


class _Walk:
    """The edits of one conversation, followed from its first turn on."""

    def __init__(self):
        self.state = START

    def _needed(self) -> str:
        role, self.state = NEEDED[self.state]
        return role

    def row(self, choices: int, role: str, text: str) -> Iterator[tuple[str, str | None, str | None]]:
        """Letters with role and text of the turn that results (null: none)."""
        while (letter := LETTERS[choices >> (2 * self.state) & 3]) == INSERT:
            yield INSERT, self._needed(), ""
        if letter == KEEP:
            self.state = STEPS[self.state, role[:1]]
            yield KEEP, role, text
        elif letter == REROLE:
            yield REROLE, self._needed(), text
        else:
            yield DELETE, None, None

    def end(self) -> Iterator[tuple[str, str, str]]:
        while self.state not in FINAL:
            yield INSERT, self._needed(), ""


def _original_id(rows: DataFrame) -> Column:
    kind = rows.schema["conv_id"].dataType.simpleString()
    return F.when(F.col("conv") != "-", F.substring("conv", 2, 2**31 - 1).cast(kind)).alias("conv_id")


def repaired(rows: DataFrame) -> DataFrame:
    """The repair as rows ``conv_id, place, edit, role, text``: one for each
    letter in order, with the turn that results (none where a row is deleted)."""
    def run(batches):
        conv, walk, place = None, None, 0
        out: list[tuple] = []

        def take(edits):
            nonlocal place
            for letter, role, text in edits:
                out.append((conv, place, letter, role, text))
                place += 1

        for b in batches:
            for c, absent, role, text, choices in zip(b["conv"], b["absent"], b["role"], b["text"], b["choices"], strict=True):
                if c != conv:
                    if walk:
                        take(walk.end())
                    conv, walk, place = c, _Walk(), 0
                if not absent:
                    take(walk.row(choices, role, text))
            yield pd.DataFrame(out, columns=names)
            out.clear()
        if walk:
            take(walk.end())
            yield pd.DataFrame(out, columns=names)

    names = ["conv", "place", "edit", "role", "text"]
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    done = _planned(rows).mapInPandas(run, "conv string, place bigint, edit string, role string, text string")
    return done.select(_original_id(rows), "place", "edit", "role", "text")


class _Report:
    """Counts and digest of one conversation."""

    def __init__(self, conv: str):
        self.conv, self.walk, self.sha = conv, _Walk(), hashlib.sha256()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.first = self.last = None
        self.distinct = self.illegal = self.cost = 0
        self.before, self.turns, self.letters = None, 0, bytearray()

    def _edit(self, edits, fault: str | None = None) -> None:
        for letter, role, text in edits:
            self.letters += letter.encode()
            self.cost += COSTS.get(letter, 0)
            if letter in (KEEP, REROLE) and fault == "truncated":
                self.cost += TRUNCATED_COST
            if role is not None:
                self.sha.update(("\n" if self.turns else "").encode() + f"{role}:{text}".encode())
                self.turns += 1

    def row(self, turn, known: bool, role: str, text: str, fault: str | None, choices: int) -> None:
        if known:
            self.distinct += self.last is None or turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        if fault is not None:
            self.counts[fault] += 1
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        self._edit(self.walk.row(choices, role, text), fault)

    def done(self) -> tuple:
        self._edit(self.walk.end())
        gaps = 0 if self.last is None else int(self.last) - int(self.first) + 1 - self.distinct
        return (self.conv, gaps, *self.counts.values(), self.illegal, self.cost, self.letters.decode(), self.sha.hexdigest())


def report(rows: DataFrame) -> DataFrame:
    """One row per conversation, those with ``absent`` rows only included:
    ``conv_id, gaps`` (turn numbers missing between the first and the last),
    ``blank, duplicate, truncated`` (rows by first fault), ``illegal`` (adjacent
    initials that the grammar forbids), ``cost, audit`` (the letters) and
    ``repaired_sha256`` of the repaired ``role:text`` lines."""
    def run(batches):
        now = None
        for b in batches:
            out = []
            for c, absent, turn, known, role, text, fault, choices in zip(*(b[n] for n in used), strict=True):
                if now is None or c != now.conv:
                    if now:
                        out.append(now.done())
                    now = _Report(c)
                if not absent:
                    now.row(turn, known, role, text, fault, choices)
            yield pd.DataFrame(out, columns=names)
        if now:
            yield pd.DataFrame([now.done()], columns=names)

    used = ["conv", "absent", "turn", "known", "role", "text", "fault", "choices"]
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["conv", *longs, "audit", "repaired_sha256"]
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    done = _planned(rows).mapInPandas(
        run, "conv string, " + ", ".join(f"{n} bigint" for n in longs) + ", audit string, repaired_sha256 string")
    return done.select(_original_id(rows), *longs, "audit", "repaired_sha256")
