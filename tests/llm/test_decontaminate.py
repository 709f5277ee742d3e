import itertools
import random

import numpy as np
from small import documents, hard_rows, text, words

from costwatch.llm import decontaminate


def best_stretch(equal, least):
    """Length of the longest run with at least 80 % equal words and equal ends."""
    best = 0
    for a in range(len(equal)):
        for b in range(a + 1, len(equal) + 1):
            part = equal[a:b]
            if part[0] and part[-1] and 100 * sum(part) >= 80 * len(part):
                best = max(best, b - a)
    return best if best >= least else 0


def test_longest_stretch_by_brute_force():
    rng = random.Random(3)
    for _ in range(600):
        share = rng.choice([0, 0.3, 0.75, 0.9, 1])
        equal = np.array([rng.random() < share for _ in range(rng.randint(1, 30))])
        least = rng.randint(1, 13)
        found = decontaminate.longest_stretch(equal, least)
        want = best_stretch(equal.tolist(), least)
        assert (found is None) == (want == 0)
        if found:
            a, b = found
            assert b - a == want and equal[a] and equal[b - 1]
            assert 100 * equal[a:b].sum() >= 80 * (b - a)


def test_masks_miss_no_allowed_change_of_items_of_one_to_twenty_words():
    for size in range(1, 21):
        used = np.flatnonzero(decontaminate.masks_of(np.array([size]))[:, 0])
        masks = [[i for i, c in enumerate(decontaminate.MASKS[m]) if c == "1"] for m in used]
        for changed in range(size // 5 + 1):
            for gone in itertools.combinations(range(1, size - 1), changed):
                assert any(
                    all(p + o not in gone for o in mask) for mask in masks for p in range(size - mask[-1])
                )


def make(spark):
    rng = random.Random(4)
    items = [(k, text(rng, rng.randint(14, 40))) for k in range(12)]
    items += [(50, "just four words here"), (51, None), (52, ""), (0, items[0][1]), (53, "seven words make up this short item")]
    docs, leaks = [], set()
    for i in range(80):
        body = words(rng, rng.randint(0, 80))
        if i % 4 == 0:
            k = rng.randrange(12)
            part = items[k][1].split()
            if i % 8 == 0:  # every sixth word replaced
                part = [w if j % 6 != 3 else "zz" for j, w in enumerate(part)]
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() if rng.random() < 0.5 else w for w in part]
            leaks.add((i, k))
        docs.append((i, " ".join(body), "en", "a"))
    docs.append((200, f"x {items[-1][1]} y", "en", "a"))
    docs.append((201, "are just four words here", "en", "a"))
    leaks |= {(200, 53), (201, 50)}
    return docs, items, leaks


def test_planted_leaks(spark):
    docs, items, leaks = make(spark)
    frame = documents(spark, docs + hard_rows(), extra=True)
    table = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.leak_digest(frame, table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == leaks
    assert len(out) == len(leaks)
    assert all(r["n_equal"] >= 0.8 * r["n_words"] for r in out)
    clean = decontaminate.clean_documents(frame, table)
    assert clean.columns == frame.columns
    bad = {i for i, _ in leaks}
    rows = [i for i, *_ in docs if i not in bad] + [i for i, *_ in hard_rows()]
    assert sorted(map(str, rows)) == sorted(str(r["doc_id"]) for r in clean.select("doc_id").collect())


def test_empty(spark):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    docs = documents(spark, [(1, "a b c d e f g", "en", "a")])
    assert decontaminate.leak_digest(documents(spark, []), items).count() == 0
    assert decontaminate.leak_digest(docs, items.limit(0)).count() == 0
    assert decontaminate.leak_digest(docs, items).count() == 1


def brute_force(docs, items):
    """(doc_id, item_id, n_words, n_equal) of the longest stretch of all alignments."""
    out = set()
    for i, body, *_ in docs:
        for k, item in items:
            x, y = (body or "").lower().split(), (item or "").lower().split()
            best = (0, 0)
            for shift in range(-len(y) + 1, len(x)):
                a, b = max(shift, 0), min(shift + len(y), len(x))
                equal = [x[j] == y[j - shift] for j in range(a, b)]
                for p, q in itertools.combinations(range(len(equal) + 1), 2):
                    part = equal[p:q]
                    if part[0] and part[-1] and q - p >= min(13, len(y)) and 100 * sum(part) >= 80 * (q - p):
                        best = max(best, (q - p, sum(part)))
            if best[0]:
                out.add((i, k, *best))
    return out


def test_items_of_all_lengths_by_brute_force(spark):
    rng = random.Random(6)
    items = [(n, " ".join(f"i{n}w{j % 7}" for j in range(n))) for n in range(1, 21)]
    docs = []
    for i in range(160):
        part = items[i % 20][1].split()
        for j in rng.sample(range(len(part)), min(len(part), rng.randint(0, len(part) // 5 + 1))):
            part[j] = "zz"
        body = words(rng, rng.randint(0, 4)) + part * rng.randint(1, 2) + words(rng, rng.randint(0, 4))
        docs.append((i, " ".join(body), "en", "a"))
    table = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.leak_digest(documents(spark, docs), table).collect()
    found = {(r["doc_id"], r["item_id"], r["n_words"], r["n_equal"]) for r in out}
    want = brute_force(docs, items)
    assert {x[:2] for x in found} == {x[:2] for x in want}
    assert {x[:3] for x in found} == {x[:3] for x in want} and len(out) == len(want)
    assert {k for _, k, *_ in found} == set(range(1, 21))
