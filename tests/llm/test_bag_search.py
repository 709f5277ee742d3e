import math
import random
import re
from collections import Counter

import pytest
from small import documents, hard_rows, text

from costwatch.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(value):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in value or "")
    return TERM.findall(lowered)


def brute(items, docs, k=10):
    """{(item_id, rank, doc_id, score)} by scoring every document."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    n_terms = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        scores = []
        for i, c in counted:
            if c:
                m = 10 + (90 * sum(c.values()) * n_docs) // n_terms
                scores.append((sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in own if c[t]
                ), i))
        best = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(item, rank, i, score) for rank, (score, i) in enumerate(best[:k], 1)]
    return sorted(out, key=repr)


def got(spark, items, docs, **more):
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "item_id AS item", "1 AS score")
    return sorted(map(tuple, search.search(asked, docs, **more).collect()), key=repr)


def corpus():
    rng = random.Random(4)
    rows = [(i, text(rng, rng.randint(1, 60)), "en", "a") for i in range(150)]
    # groups of equal bags: copies, and texts that differ in order, case and words no item holds
    rows += [(200 - i, "Ka-na LE.tu, kana zz" + str(i % 2), "en", "a") for i in range(40)]
    rows += [(300 + i, " ".join(rng.sample("kana letu mipe nosi zz9".split(), 5)), "de", "b") for i in range(30)]
    return rows


ITEMS = [(1, "kana letu"), (2, "KANA mipe vowox kana"), (3, "nothing held here"), (4, ""), (5, None),
         (6, "über 漢字"), (None, "nosi"), (7, "kana"), (7, "letu x"), (7, "kana")]


def test_against_brute_force(spark):
    rows = corpus() + hard_rows()
    frame = documents(spark, rows, extra=True).selectExpr("*", "doc_id AS h", "doc_id AS m", "1 AS item", "1 AS first")
    assert got(spark, ITEMS, frame) == brute(ITEMS, [r[:2] for r in rows])


def test_blocks_of_items_and_of_groups(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 4)
    monkeypatch.setattr(search, "SCORE_CELLS", 7)
    monkeypatch.setattr(search, "PENDING", 3)
    rows = corpus()
    items = ITEMS + [(i, r[1]) for i, r in enumerate(rows[:6], 20)]
    frame = documents(spark, rows).repartition(5)
    assert got(spark, items, frame, k=4) == brute(items, [r[:2] for r in rows], 4)


def test_equal_bags_are_one_class(spark):
    rows = [(i, "one two three" if i % 2 else "three, two ONE", "en", "a") for i in range(50)]
    frame = documents(spark, rows)
    known = spark.sparkContext.broadcast(
        __import__("numpy").array(sorted(r["term"] for r in search.item_terms(
            spark.createDataFrame([(1, "one three")], "item_id long, text string")).collect()))
    )
    marked = search.bag_classes(search.document_bags(frame, known), 50, 150)
    assert marked.select("h", "m", "bag").distinct().count() == 1


@pytest.mark.parametrize("items, rows", [([], corpus()), (ITEMS, []), ([(1, "absent")], [(1, None, "en", "a")])])
def test_empty(spark, items, rows):
    assert got(spark, items, documents(spark, rows)) == brute(items, [r[:2] for r in rows])
