import random
from collections import defaultdict

from costwatch.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    grouped = defaultdict(list)
    last = lambda x: (x is None, x if x is not None else "")
    for conv, turn, role, text in sorted(rows, key=lambda r: ((r[1] is None, r[1] or 0), last(r[2]), last(r[3]))):
        grouped[conv].append((role, text))
    unlike = {}
    for conv, turns in grouped.items():
        key = tuple(turns)
        ids = [x for x in (unlike.get(key), conv) if x is not None]
        unlike[key] = min(ids) if ids else None
    out = set()
    for turns, conv in unlike.items():
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in unlike):
            continue
        for k, (role, text) in enumerate(turns, 1):
            mark = lambda x: (x or "").replace("<|", "<\\|")
            out.add((conv, k, len(turns), f"<|{mark(role)}|>\n{mark(text)}<|end|>\n"))
    return out


def make():
    rng, rows, conv = random.Random(8), [], 0
    for _ in range(25):
        turns = [(rng.choice("ua"), rng.choice(["hi", "yes", "<|no|>", ""])) for _ in range(rng.randint(1, 5))]
        for n in rng.sample(range(1, len(turns) + 1), rng.randint(1, len(turns))) + [len(turns)]:
            rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns[:n])]
            conv += 1
    rng.shuffle(rows)
    return rows


def collect(frame):
    return {tuple(r) for r in chat.chat_turns(frame).collect()}


def test_collapse_by_hand(spark):
    rows = make()
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "conv_id AS position", "turn AS h1", "role AS _own_n")
    assert collect(frame) == by_hand(rows)


def test_long_conversation_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK_TURNS", 4)
    rows = [(1, k, "u", f"t{k % 3}") for k in range(30)] + [(2, k + 5, "u", f"t{k % 3}") for k in range(17)]
    rows += [(3, k, "u", f"t{k % 3}") for k in range(16)] + [(3, 16, "u", "other")]
    assert collect(spark.createDataFrame(rows, SCHEMA)) == by_hand(rows)


def test_hard_rows(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (2, None, "u", "x"), (2, 0, "", ""), (None, 0, "u", "y"),
            (None, None, None, "z"), (3, 0, "", ""), (4, 0, None, ""), (5, 0, "u", "y" * 100_000)]
    assert collect(spark.createDataFrame(rows, SCHEMA)) == by_hand(rows)
    assert collect(spark.createDataFrame([], SCHEMA)) == set()


def test_many_rows_without_an_id_or_turn(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK_TURNS", 16)
    rows = [(None, k % 2, "u", f"t{k % 90}") for k in range(700)] + [(None, None, None, None)] * 50
    rows += [(1, None, "u", f"t{k}") for k in range(120)] + [(2, 3, "u", "same")] * 100 + [(3, 7, "u", "same")] * 90
    rows += [(4, -k, "u", f"t{k}") for k in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    out = chat.chat_turns(frame).collect()
    assert {tuple(r) for r in out} == by_hand(rows) and len(out) == len(by_hand(rows))
    dealt = chat.hashed_turns(frame.repartition(4)).select("conv_id", "position").collect()
    assert sorted(r["position"] for r in dealt if r["conv_id"] is None) == list(range(1, 751))
