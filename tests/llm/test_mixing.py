import random
from collections import Counter

import numpy as np
import pytest
from small import documents, hard_rows, text

from costwatch.llm import mixing


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_and_its_inverse(size):
    index = np.arange(size)
    for seed in (0, 5):
        places = mixing.permute(index, np.full(size, size), np.full(size, seed))
        assert sorted(places) == index.tolist()
        back = mixing.permute(places, np.full(size, size), np.full(size, seed), back=True)
        assert back.tolist() == index.tolist()


def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_ = dict.fromkeys(names, 0.0), set(names)
    left = float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def check(rows, out):
    size_of = lambda t: len((t or "").encode().split())
    assert sorted((str(r["doc_id"]), r["size"]) for r in out) == sorted((str(i), size_of(t)) for i, t, _, _ in rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size_of(t)
    want = targets_by_hand(dict(sizes))
    taken, seen = Counter(), {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[(r["source_size"], round(r["target"], 6))] += r["taken"]
    expected = Counter()
    for s, t in want.items():
        expected[(sizes[s], round(t, 6))] += int(np.floor(t + 0.5))
    assert {k: v for k, v in taken.items()} == dict(expected), (taken, expected, seen)


def test_digest(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, rng.randint(1, 60)), "en", rng.choice("aaaaabcdefg")) for i in range(300)]
    rows += [(1000 + i, text(rng, 3), "en", "rare") for i in range(2)]
    frame = documents(spark, rows, extra=True)
    for block in (7, 256):
        out = mixing.mix_digest(frame, block).collect()
        check(rows, out)
        again = mixing.mix_digest(frame.repartition(3), block).collect()
        assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_hard_rows(spark):
    out = mixing.mix_digest(documents(spark, hard_rows()), 16).collect()
    check(hard_rows(), out)
    assert mixing.mix_digest(documents(spark, [])).count() == 0


def test_documents_of_the_mix(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, rng.randint(1, 40)), "en", rng.choice("aab")) for i in range(60)]
    rows += [(1, rows[1][1], "en", rows[1][3]), (99, None, "en", "a"), (None, "no number", "en", None)]
    frame = documents(spark, rows, extra=True)
    mixed = mixing.mix_documents(frame, 5)
    assert mixed.columns == frame.columns
    words, origin = Counter(), Counter()
    for r in mixed.collect():
        assert r["n_chars"] == len(r["text"]) and r["node"] == r["doc_id"]
        words[r["doc_id"]] += len(r["text"].split())
        whole = {t for i, t, _, _ in rows if i == r["doc_id"]}
        origin[r["text"] in whole] += 1
    taken = Counter()
    for r in mixing.mix_digest(frame, 5).collect():
        taken[r["doc_id"]] += r["taken"]
    assert {k: v for k, v in taken.items() if v} == dict(words)
    assert origin[True]


def test_one_text_in_several_sources(spark):
    """Words per source and document, with equal ids and texts in sources a, b and none."""
    rng = random.Random(5)
    shared = [(i, text(rng, rng.randint(5, 40)), "en") for i in range(20)]
    rows = [(*r, s) for r in shared for s in ("a", "b", None)]
    rows += [(100 + i, text(rng, 30), "en", "b") for i in range(60)]
    frame = documents(spark, rows)
    mixed = mixing.mix_documents(frame, 7).collect()
    assert sorted(map(repr, mixed)) == sorted(map(repr, mixing.mix_documents(frame.repartition(5), 7).collect()))
    taken, words = Counter(), Counter()
    placed, pieces = mixing.plan_mix(frame, 7)
    for r in pieces.collect():
        taken[(r["source"], r["doc_id"])] += r["_high"] - r["_low"]
    for r in mixed:
        words[(r["source"], r["doc_id"])] += len(r["text"].split())
    assert taken == words
    targets = {r["source"]: r["target"] for r in placed.select("source", "target").distinct().collect()}
    for source, target in targets.items():
        assert abs(sum(n for (s, _), n in words.items() if s == source) - target) <= 1


def test_uses_name_slots_and_output_shards(spark):
    rng = random.Random(8)
    rows = [(i, text(rng, rng.randrange(0, 900)), "en", rng.choice("ab")) for i in range(60)]
    out = mixing.mix_digest(documents(spark, rows), block_words=64).collect()
    again = mixing.mix_digest(documents(spark, rows), block_words=64).collect()
    assert sorted(out, key=str) == sorted(again, key=str)
    source = {i: s for i, _, _, s in rows}
    for name in "ab":
        slots, of = Counter(), {}
        for r in out:
            if source[r["doc_id"]] != name:
                continue
            assert r["taken"] == sum(u["words"] for u in r["uses"])
            assert [u["slot"] for u in r["uses"]] == sorted({u["slot"] for u in r["uses"]})
            want = int(np.floor(r["target"] + 0.5))
            for u in r["uses"]:
                slots[u["slot"]] += u["words"]
                assert of.setdefault(u["slot"], u["shard"]) == u["shard"]
        assert sorted(slots) == list(range(len(slots))) and sum(slots.values()) == want
        assert max(slots.values()) <= 64
        in_order = [of[slot] for slot in range(len(slots))]
        assert in_order == sorted(in_order) and 0 <= in_order[0] and in_order[-1] < mixing.OUTPUT_SHARDS
        assert len(set(in_order)) > mixing.OUTPUT_SHARDS // 2
