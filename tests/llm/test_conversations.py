"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

from rollcall.llm import conversations
from rollcall.llm.queries import op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, fault string, choices string"
GOOD = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]  # every conversation, whatever is left of it
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """Least (cost, letters) by a best-first search over edits whose initials
    can still become a good conversation."""
    heap = [(0, "", 0, "", ())]
    best = {}
    while heap:
        cost, letters, i, initials, turns = heapq.heappop(heap)
        if i == len(rows) and GOOD.fullmatch(initials):
            return cost, letters, turns
        # what follows depends on the place and the last initial only
        if best.setdefault((i, initials[-1:]), (cost, letters)) < (cost, letters):
            continue
        options = [("I", r, "", 2, i) for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            options.append(("D", None, None, 3, i + 1))
            if marks[i] not in ("blank", "duplicate"):
                extra = marks[i] == "truncated"
                options += [("K", role, text, extra, i + 1)] + [("R", r, text, 2 + extra, i + 1) for r in ("user", "assistant")]
        for letter, role, text, price, to in options:
            now = initials if role is None else initials + (role[:1] or "?")
            if any(GOOD.fullmatch(now + end) for end in ("", "a", "ua")):
                heapq.heappush(heap, (cost + price, letters + letter, to, now, turns if role is None else (*turns, f"{role}:{text}")))
    raise AssertionError("none")


def expected(rows):
    out = []
    for conv, own in damage(rows).items():
        marks = faults(own)
        n = Counter(marks)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, letters, left = cheapest(own, marks)
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, letters,
                    hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in conversations.report(conversations.damaged(frame.repartition(3))).collect()), key=str)


def test_random_conversations(spark):
    r = random.Random(13)
    rows = []
    for conv in range(400):
        for turn in range(r.randrange(0, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "Assistant"])
            text = r.choice(["Hi.", "Yes!", "No", "Why?\n", "", " \t", None, "é", f"t{turn}.", "x. \x0b"])
            rows.append((conv, r.choice([turn, turn, turn, turn * 3, None, 0]), role, text))
    rows += [(None, t, "user", "a.") for t in range(4)] + [(-5, None, "user", "a.")] * 3 + [(9**17, 2**62, "user", "a."), (9**17, 5, "user", "a!")]
    assert found(spark, rows) == expected(rows)


def test_long_conversation_over_many_batches(spark):
    rows = [(1, t, ["user", "assistant"][t % 2] if t % 11 else "tool", f"turn {t}." if t % 7 else "cut") for t in range(7000)]
    rows += [(2, 0, "user", "a" * 300_000), (2, 1, "assistant", "b.")]
    rows += [(3, t, "user", "same.") for t in range(3000)]
    assert found(spark, rows) == expected(rows)


def test_only_dropped_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(spark, [(conv, 0, "user", "x.")]) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.report(conversations.damaged(empty)).collect() == []
    assert conversations.repaired(empty).collect() == []


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "q?"), (1, 2, "user", "more."), (1, 2, "user", "more."), (1, 3, "assistant", "a."), (2, 0, "user", "x.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(tuple(r) for r in conversations.repaired(frame).collect())
    # by ASCII, an inserted turn (I) is less than another role (R)
    assert [x[2:] for x in got if x[0] == 1] == [("K", "system", "s."), ("K", "user", "q?"), ("I", "assistant", ""), ("K", "user", "more."),
                                                 ("D", None, None), ("K", "assistant", "a.")]
    assert [x[1:] for x in got if x[0] == 2] == [(0, "K", "user", "x."), (1, "I", "assistant", "")]


def test_conversations_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in op13_conversation_repair(spark, "/root/testdata/sf0.01").collect()), key=str)
    assert got == expected(rows)
