import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from costwatch.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        ending = text.rstrip(BLANKS)
        if not ending:
            out.append(1)
        elif (role, text) in seen:
            out.append(2)
        else:
            out.append(3 if ending[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def every_repair(turns, marks):
    """(cost, audit, lines) of all edits with at most one insertion in front of each turn and at the end."""
    n = len(turns)
    for inserts in itertools.product(("", "user", "assistant"), repeat=n + 1):
        if sum(map(bool, inserts)) > 2:
            continue
        for edits in itertools.product(("D", "K", "Ruser", "Rassistant"), repeat=n):
            cost, audit, lines = 0, "", []
            for i in range(n + 1):
                if inserts[i]:
                    cost, audit = cost + 5, audit + "I"
                    lines.append((inserts[i], ""))
                if i == n:
                    break
                audit += edits[i][0]
                if edits[i] == "D":
                    cost += 2
                    continue
                if marks[i] in (1, 2):
                    cost = None
                    break
                cost += (edits[i] != "K") + 5 * (marks[i] == 3)
                lines.append((turns[i][0] if edits[i] == "K" else edits[i][1:], turns[i][1]))
            if cost is not None and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in lines)):
                yield cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]  # every conversation has a row
        one = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        row = ((turn is not None, turn or 0), turn, "user" if fate == 4 else role, text)
        out[conv] += [row] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {conv: sorted(turns, key=lambda r: (r[0], r[2].encode(), r[3].encode())) for conv, turns in out.items()}


def brute(rows):
    out = []
    for conv, full in damaged(rows).items():
        turns = [r[2:] for r in full]
        numbers = [r[1] for r in full if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        marks = faults(turns)
        pairs = zip(turns, turns[1:])
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
        cost, audit, text = min(every_repair(turns, marks))
        digest = hashlib.sha256(text.encode()).hexdigest()
        counts = [marks.count(k) for k in (1, 2, 3)]
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=repr)


def got(spark, rows, parts=4):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    frame = frame.selectExpr("*", "turn AS at", "conv_id AS key", "turn AS gaps", "'x' AS audit", "1 AS _n")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, repair.repair_digest(frame).select(names).collect()), key=repr)


def conversations(n=60, turns=5):
    rng, rows = random.Random(6), []
    for conv in range(n):
        for turn in range(rng.randint(1, turns)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, rng.choice(["Yes.", "No", "Why?", " \n", "Yes. ", "ok!"])))
    return rows


HARD = [
    (None, None, None, None), (None, 3, "user", "a."), (None, 4, "assistant", "b."), (None, 4, "assistant", "b."),
    (-5, None, "user", "x."), (-5, None, "assistant", "é."), (-5, 9, "user", None), (-7, 2, None, "t"),
    (-8, None, "u", "z" * 300_000 + "."), (-8, None, "assistant", "🙂."), (-9, 1, "user", ""),
]


def test_against_every_edit(spark):
    rows = conversations(40, 4) + HARD
    random.Random(1).shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_small_chunks_and_windows(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_TURNS", 2)
    monkeypatch.setattr(repair, "BATCH_CHUNKS", 3)
    monkeypatch.setattr(repair, "WINDOW", 2)
    rows = conversations(40, 4) + HARD
    assert got(spark, rows, 7) == brute(rows)


def greedy(codes):
    """Least cost by plain dynamic programming, then the least letter that keeps to it."""
    keep = [{0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2}]
    spoken, never = [2, 2, 3, 2], 10**9

    def settle(costs):
        for _ in range(2):
            costs = [min(c, 5 + costs[spoken[q]]) for q, c in enumerate(costs)]
        return costs

    after = [settle([0, never, never, 0])]
    for code in reversed(codes):
        more, rest = 5 * (code >> 2 == 3) + never * (code >> 2 in (1, 2)), after[-1]
        after.append(settle([
            min(2 + rest[q], more + (rest[keep[q][code & 3]] if code & 3 in keep[q] else never), 1 + more + rest[spoken[q]])
            for q in range(4)
        ]))
    after.reverse()
    at, q, left, out = 0, 0, after[0][0], ""
    while at < len(codes) or left:
        code = codes[at] if at < len(codes) else 4
        more = 5 * (code >> 2 == 3) + never * (code >> 2 in (1, 2))
        last = at == len(codes)
        steps = [("D", at + 1, q, 2), ("I", at, spoken[q], 5), ("K", at + 1, keep[q].get(code & 3), more), ("R", at + 1, spoken[q], 1 + more)]
        for letter, to, state, cost in steps:
            if state is not None and (letter == "I" or not last) and cost + after[to][state] == left:
                out, at, q, left = out + letter, to, state, left - cost
                break
    return after[0][0], out


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 300, 3000])
def test_long_conversations(size):
    rng = random.Random(size)
    for _ in range(5):
        codes = bytes(rng.choice([1, 2, 1, 2, 0, 3]) + 4 * rng.choice([0, 0, 0, 0, 3, 1, 2]) for _ in range(size))
        cost, windows = repair.cheapest_edits(codes)
        assert (cost, "".join(w for w, _ in windows)) == greedy(codes)


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_TURNS", 16)
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"{i}.", f"{i}!", ""])) for i in range(900)]
    turns = [r[2:] for r in damaged(rows)[1]]
    codes = bytes({"u": 1, "a": 2}[role[0]] + 4 * fault for (role, _), fault in zip(turns, faults(turns)))
    cost, audit = greedy(codes)
    text, at, last = [], 0, "a"
    for letter in audit:
        if letter in "KR":
            text.append(f"{turns[at][0] if letter == 'K' else 'user' if last == 'a' else 'assistant'}:{turns[at][1]}")
        elif letter == "I":
            text.append(f"{'user' if last == 'a' else 'assistant'}:")
        last = text[-1][0] if text else "a"
        at += letter != "I"
    (row,) = got(spark, rows)
    assert row[6:8] == (cost, audit)
    assert row[8] == hashlib.sha256("\n".join(text).encode()).hexdigest()


def test_empty(spark):
    assert got(spark, []) == []
    gone = [(c, t, "user", "x.") for c in range(60) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone and got(spark, gone) == brute(gone)
