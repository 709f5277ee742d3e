"""Searches against brute force on small fixtures, with blocks made small on purpose."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from costwatch.operators import blocks, dense, evaluate, hybrid, lexical, ranking, shared

random.seed(3)
WORDS = [f"w{i}" for i in range(40)]
# "all" is in every document, "half" in half of them, a third of the documents are copies
TEXTS = [
    "all " + ("half " if i % 2 else "") + ("copy of one text" if i % 3 == 0 else " ".join(random.choices(WORDS, k=12)))
    for i in range(90)
]
DOCS = [(i, t) for i, t in enumerate(TEXTS)] + [(90, ""), (91, "--- !")]
QUERIES = [
    (0, "all half w1 w2 w2"), (1, "copy text"), (2, "w3"), (3, "unknown"), (4, "..."),
    (5, "all"), (6, TEXTS[7]), (7, TEXTS[7]),
]


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "POSTING_BLOCK", 100)
    monkeypatch.setattr(blocks, "MIN_POSTING_BLOCK", 50)
    monkeypatch.setattr(blocks, "MIN_VECTOR_BLOCK", 8)
    monkeypatch.setattr(blocks, "VECTOR_BLOCK", 16)
    monkeypatch.setattr(blocks, "SCORE_CELLS", 20)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "document_id bigint, text string")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id bigint, text string")


def tokens(text):
    return re.findall(r"[a-z0-9]+(?:-[a-z0-9]+)*", text.lower())


def best(scores, k):
    return sorted(scores.items(), key=lambda s: (-round(s[1], 8), s[0]))[:k]


def brute_bm25(text, k, pad):
    counts = {i: Counter(tokens(t)) for i, t in DOCS}
    n, mean = len(DOCS), sum(sum(c.values()) for c in counts.values()) / len(DOCS)
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log(n - f + 0.5) - math.log(f + 0.5) for t, f in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: v if v >= 0 else floor for t, v in idf.items()}
    scores = {}
    for i, c in counts.items():
        hits = [t for t in tokens(text) if c[t]]
        if hits or pad:
            size = sum(c.values())
            scores[i] = sum(
                idf[t] * c[t] * 2.5 / (c[t] + 1.5 * (0.25 + 0.75 * size / mean)) for t in hits
            )
    return best(scores, k) if tokens(text) else []


def per_query(hits, score="score"):
    out = {q: [] for q, _ in QUERIES}
    for r in hits.orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["document_id"], r[score]))
    return out


def same(got, expected):
    assert [d for d, _ in got] == [d for d, _ in expected]
    assert [s for _, s in got] == pytest.approx([s for _, s in expected], abs=1e-7)


@pytest.mark.parametrize("pad", [False, True])
def test_bm25_against_brute_force(spark, docs, queries, pad):
    got = per_query(lexical.bm25_search(queries, lexical.lexical_index(docs), 5, pad=pad))
    for query_id, text in QUERIES:
        same(got[query_id], brute_bm25(text, 5, pad))


def test_tfidf_against_brute_force(spark, docs, queries):
    stop = ["of", "all"]

    def grams(text):
        words = [w for w in re.findall(r"\b\w\w+\b", text.lower()) if w not in stop]
        return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])

    counts = {i: grams(t) for i, t in DOCS}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(DOCS)) / (1 + f)) + 1 for t, f in df.items()}

    def unit(c):
        v = {t: f * idf[t] for t, f in c.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    vectors = {i: unit(c) for i, c in counts.items()}
    got = per_query(lexical.tfidf_search(queries, lexical.tfidf_index(docs, stop), 4))
    for query_id, text in QUERIES:
        q = unit(grams(text))
        scores = {i: sum(x * v.get(t, 0.0) for t, x in q.items()) for i, v in vectors.items()}
        same(got[query_id], [h for h in best(scores, 4) if round(h[1], 8) > 0])


def test_dense_against_brute_force(spark):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(70, 8))
    matrix[20:50] = matrix[20]  # copies: ties go to the smaller id
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    corpus = spark.createDataFrame(rows, "document_id bigint, embedding array<double>")
    asked = spark.createDataFrame(rows[:30], "query_id bigint, embedding array<double>")
    got = {}
    for r in dense.dense_search(asked, corpus, 6).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["document_id"], r["score"]))
    for q in range(30):
        same(got[q], best(dict(enumerate(matrix @ matrix[q])), 6))


def test_encode(spark, docs):
    rows = {r["document_id"]: r["embedding"] for r in dense.encode(docs, "document_id").collect()}
    assert len(rows) == len(DOCS)
    assert rows[90] == [0.0] * 64
    assert sum(x * x for x in rows[1]) == pytest.approx(1.0, abs=1e-5)
    assert rows[0] == rows[6]
    own = dense.encode(
        docs, "document_id", encoder=lambda texts: np.array([[len(t), 1.0] for t in texts])
    )
    got = {r["document_id"]: r["embedding"] for r in own.collect()}
    assert got[90] == [0.0, 1.0]


def test_minmax_and_merge(spark):
    dense_hits = spark.createDataFrame(
        [(1, 1, 0.9), (1, 2, 0.4), (2, 1, 0.5), (2, 2, 0.5)],
        "query_id int, document_id int, score double",
    )
    lexical_hits = spark.createDataFrame(
        [(1, 2, 8.0), (1, 3, 2.0)], "query_id int, document_id int, score double"
    )
    rows = hybrid.hybrid_scores(dense_hits, lexical_hits).collect()
    got = {(r["query_id"], r["document_id"]): r["hybrid_score"] for r in rows}
    assert got[(1, 1)] == pytest.approx(0.6)
    assert got[(1, 2)] == pytest.approx(0.6 * 0.4 / 0.9 + 0.4, abs=1e-7)
    assert got[(1, 3)] == pytest.approx(0.1)
    assert got[(2, 1)] == got[(2, 2)] == 1.0  # all equal: 1.0 on either side
    with pytest.raises(ValueError):
        hybrid.hybrid_scores(dense_hits, lexical_hits, 0.7, 0.4)
    with pytest.raises(ValueError):
        ranking.top_k(dense_hits, 0, [dense_hits["score"]])


def test_rerank(spark, docs, queries):
    index = lexical.lexical_index(docs)
    hits = lexical.bm25_search(queries, index, 5)
    rows = hybrid.rerank(hits, queries, docs, index, 1).collect()
    got = {r["query_id"]: (r["document_id"], r["rerank_score"]) for r in rows}
    assert got[6] == (7, 1.5)  # every term and every pair is found
    plan = hybrid.rerank(hits, queries, docs, index, 1)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange hash" in line]
    assert shuffled and "_doc" not in plan and not [line for line in shuffled if "text" in line]
    own = hybrid.rerank(hits, queries, docs, index, 1, scorer=lambda q, d: -d.str.len())
    assert own.filter("query_id = 2").count() == 1


def test_contained_passages_and_recall(spark, docs):
    passages = spark.createDataFrame(
        [(1, TEXTS[7][4:]), (2, "copy of one text"), (3, "copy of two text"), (4, "w1"), (5, "w1 w"), (6, "opy of"),
         (7, "--- !"), (8, "- "), (9, " "), (10, ""), (11, "??"), (12, "w1 zz"), (13, "--")],
        "query_id bigint, text string",
    )
    index = lexical.lexical_index(docs)
    truth = evaluate.contained_passages(passages, docs, index)
    got = {(r["query_id"], r["document_id"]) for r in truth.collect()}
    expected = {
        (q, i)
        for q, t in [(r["query_id"], r["text"]) for r in passages.collect()]
        for i, d in DOCS
        if t in d
    }
    assert got == expected
    plan = truth._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    passages = passages.filter("query_id <= 5")
    truth = evaluate.contained_passages(passages, docs, index)
    hits = lexical.bm25_search(passages, index, 3)
    assert evaluate.retrieval_recall(hits, truth, 3).first().asDict() == {
        "queries": 4, "found": 4, "recall": 1.0,
    }


def test_padding_with_negative_scores(spark):
    """Document 6 shares no word: score 0 comes before the negative ones of the others."""
    texts = ["a b", "a c", "a b c", "a b d", "a c d", "z y", "a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "document_id long, text string")
    queries = spark.createDataFrame([(1, "a"), (2, "nothing"), (3, "z")], "query_id long, text string")
    index = lexical.lexical_index(docs)
    hits = lexical.bm25_search(queries, index, 3, pad=True).orderBy("query_id", "rank").collect()
    plain = {
        (r["query_id"], r["document_id"]): r["score"]
        for r in lexical.bm25_search(queries, index, 7).collect()
    }
    for q in (1, 2, 3):
        want = sorted((-plain.get((q, d), 0.0), d) for d in range(1, 8))[:3]
        got = [(-r["score"], r["document_id"]) for r in hits if r["query_id"] == q]
        assert got == want


def test_blocks_are_skipped(spark, monkeypatch):
    """Each document has words of its own block: a query looks into few blocks and misses nothing."""
    monkeypatch.setattr(blocks, "POSTING_BLOCK", 200)
    texts = [" ".join(["common"] + [f"t{i // 8}"] * 3 + [f"u{i}"] * (i % 5 + 1) + ["x"] * (i % 40)) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "document_id long, text string")
    asked = [(q, f"u{q} t{q // 8} common") for q in range(0, 400, 20)]
    queries = spark.createDataFrame(asked, "query_id long, text string")
    index, visits = lexical.lexical_index(docs), []
    visited = blocks._visited

    def counted(postings, pairs, n_blocks, *rest):
        visits.append((pairs.select("query_id", "block").distinct().count(), n_blocks))
        return visited(postings, pairs, n_blocks, *rest)

    monkeypatch.setattr(blocks, "_visited", counted)
    monkeypatch.setattr(lexical, "shared_cut", lambda *_: None)
    got = lexical.bm25_search(queries, index, 2).collect()
    assert sum(n for n, _ in visits) < len(asked) * visits[0][1] / 2
    monkeypatch.setattr(blocks, "SEED_BLOCKS", 10_000)  # everything is visited
    assert sorted(got) == sorted(lexical.bm25_search(queries, index, 2).collect())
    assert {r["query_id"]: r["document_id"] for r in got if r["rank"] == 1} == {q: q for q, _ in asked}


def test_vector_blocks_are_skipped(spark, monkeypatch):
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(12, 16)) * 4
    matrix = np.repeat(middles, 40, axis=0) + rng.normal(size=(480, 16)) * 0.1
    matrix[5] = 0.0
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    corpus = spark.createDataFrame(rows, "document_id bigint, embedding array<double>")
    asked = spark.createDataFrame(rows[::30], "query_id bigint, embedding array<double>")
    visits, visited = [], blocks._visited

    def counted(vectors, pairs, n_blocks, *rest):
        visits.append((pairs.select("query_id", "block").distinct().count(), n_blocks))
        return visited(vectors, pairs, n_blocks, *rest)

    monkeypatch.setattr(blocks, "_visited", counted)
    got = {}
    for r in dense.dense_search(asked, corpus, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["document_id"], r["score"]))
    for q in range(0, 480, 30):
        same(got[q], best(dict(enumerate(matrix @ matrix[q])), 5))
    assert sum(n for n, _ in visits) < 16 * visits[0][1] / 2


def test_shared_parts_against_blocks(spark, monkeypatch):
    """Queries from a template: the same hits with and without sharing, and few matches."""
    rng = random.Random(11)
    docs = [(i, " ".join(rng.choices(["cost", "fuel", "toll", "week", "north", "south", *WORDS], k=25))) for i in range(120)]
    docs = spark.createDataFrame(docs, "document_id long, text string")
    asked = [(q, f"cost fuel toll week {'north' if q % 2 else 'south'} w{q} w{q // 3}") for q in range(36)]
    queries = spark.createDataFrame(asked, "query_id long, text string")
    index, cuts = lexical.lexical_index(docs), []
    choose = lexical.shared_cut
    monkeypatch.setattr(shared, "LEAST_GAIN", 2)
    monkeypatch.setattr(lexical, "shared_cut", lambda *a: cuts.append(choose(*a)) or cuts[-1])
    frame = lexical.bm25_search(queries, index, 6)
    plan = frame._jdf.queryExecution().toString()
    assert cuts == [16] and "MapInArrow" not in plan and "Nested" not in plan and "Cartesian" not in plan
    monkeypatch.setattr(lexical, "shared_cut", lambda *_: None)
    plain = per_row(lexical.bm25_search(queries, index, 6))
    assert per_row(frame) == plain


def per_row(hits):
    return {(r["query_id"], r["rank"]): (r["document_id"], round(r["score"], 6)) for r in hits.collect()}


def test_padding_over_ranges(spark, monkeypatch):
    """Free ids before, between and behind ranges that are matched wholly, partly and not at all."""
    monkeypatch.setattr(lexical, "ID_RANGE", 4)
    words = {i: "a b" if i < 8 or i in (13, 14) else "b" if i < 13 else "c" for i in range(30)}
    docs = spark.createDataFrame([(i, words[i]) for i in range(30)], "document_id long, text string")
    queries = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "a b c"), (5, "d")], "query_id long, text string")
    index = lexical.lexical_index(docs)
    hits = lexical.bm25_search(queries, index, 3)
    frame = lexical.unmatched(lexical.query_terms(queries, index.tokens), hits.filter("score > 100"), index, 6)
    assert "CartesianProduct" not in frame._jdf.queryExecution().toString()
    got = {}
    for r in frame.collect():
        got.setdefault(r["query_id"], set()).add(r["document_id"])
    for q, text in ((1, "a"), (2, "b"), (3, "c"), (4, "abc"), (5, "d")):
        free = [i for i in range(30) if not set(text) & set(words[i].split())]
        assert got.get(q, set()) == set(free[:6])
