"""Packed term counts: the words of the expression, small writes, odd ids, exact blocks."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from costwatch.functions import grams, text
from costwatch.operators import blocks, explain, lexical, packed

TEXTS = [
    "The end of the END", "é éà x a_b 12 ab", "日本 a 日本語 𝒳𝒴 𝒳", "", "x", None, "a-b cd-ef\tgh\n--ij", "İstanbul ǅ ßa", "ab" * 40,
]


def test_grams_are_those_of_the_expression(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "query_id long, text string")
    expected = rows.select("query_id", F.explode(text.word_ngrams(F.col("text"), ["the"])).alias("term"))
    counts = Counter((r["query_id"], r["term"]) for r in expected.collect())
    got = Counter()
    found = packed.grams_of(rows, "query_id", F.col("text"), ["the"]).collect()
    for r in found:
        got[r["query_id"], r["code"]] += r["n"]
    by_row = lambda c: {i: sorted(n for (j, _), n in c.items() if j == i) for i in range(len(TEXTS))}
    assert by_row(got) == by_row(counts)
    assert len({c for _, c in got}) == len({t for _, t in counts})


def test_packed_columns_are_read_back():
    rng = np.random.default_rng(5)
    codes = np.unique(rng.integers(0, 2**64, 500, dtype=np.uint64))
    columns = [rng.integers(0, top, 500) for top in (2, 300, 70_000, 2**40)] + [np.empty(0, np.int64)]
    back = grams.unpack_sorted(grams.pack_sorted(codes, *columns))
    assert (back[0] == codes).all() and all((a == b).all() and len(a) == len(b) for a, b in zip(back[1:], columns, strict=True))


def test_no_terms_are_written_that_no_question_has(spark, monkeypatch):
    """A written index of all words and pairs is several times the texts."""
    rows = [(i, " ".join(f"w{i}x{j} common{j % 7}" for j in range(200))) for i in range(60)]
    docs = spark.createDataFrame(rows, "document_id long, text string")
    queries = spark.createDataFrame([(1, "w3x7 common3"), (2, "unknown")], "query_id long, text string")
    tables, staged = {}, lexical.stage
    monkeypatch.setattr(lexical, "stage", lambda df, name: tables.setdefault(name, staged(df, name)))
    hits = lexical.tfidf_search(queries, lexical.tfidf_index(docs, []), 3).collect()
    assert {r["document_id"] for r in hits if r["rank"] == 1} == {3}
    assert not {"counted", "terms", "document_vectors"} & set(tables)
    held = tables["document_parts"].filter(F.col("kind") != packed.IDS).agg(F.sum(F.length("data"))).first()[0]
    assert held < sum(len(t) for _, t in rows) / 10


def test_repeated_and_missing_ids(spark):
    """Rows of one id are one vector; rows without an id count as documents and are no hits."""
    rows = [("a", "red red blue"), ("a", "red red blue"), ("b", "blue sea"), (None, "red sea"), (None, "red sea"), ("c", None)]
    docs = spark.createDataFrame(rows, "document_id string, text string")
    queries = spark.createDataFrame([(1, "red"), (2, "sea"), (None, "red"), (3, None)], "query_id long, text string")
    hits = lexical.tfidf_search(queries, lexical.tfidf_index(docs, []), 5).collect()
    idf = {t: math.log(7 / (1 + df)) + 1 for t, df in {"red": 4, "blue": 3, "sea": 3, "rr": 2, "rb": 2, "bs": 1}.items()}
    a = math.sqrt(2 * ((2 * idf["red"]) ** 2 + idf["blue"] ** 2 + idf["rr"] ** 2 + idf["rb"] ** 2))
    b = math.sqrt(idf["blue"] ** 2 + idf["sea"] ** 2 + idf["bs"] ** 2)
    assert {(r[0], r[1]): r[2] for r in hits} == {
        (1, "a"): pytest.approx(2 * idf["red"] / a, abs=1e-7), (2, "b"): pytest.approx(idf["sea"] / b, abs=1e-7),
    }


@pytest.mark.parametrize(("cells", "often"), [(1 << 18, 128), (40, 128), (40, 0), (1 << 18, 3)])
def test_block_against_brute_force(monkeypatch, cells, often):
    monkeypatch.setattr(blocks, "SWEPT_CELLS", cells)
    monkeypatch.setattr(blocks, "OFTEN_TERMS", often)
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3, (12, 30)) * (rng.random((12, 30)) < np.linspace(0.05, 0.9, 12)[:, None])
    counts[:, 7] = counts[:, 3]  # a tie
    codes = np.arange(12, dtype=np.uint64) * 5 + 1
    term, row = np.nonzero(counts)
    lengths = np.maximum((counts**2).sum(axis=0), 1).astype(float)
    ids = pa.array([f"d{i:02}" for i in range(30)])
    held = blocks._SweptBlock(ids, codes, np.bincount(term, minlength=12), row, counts[term, row].astype(float), lengths, 4)
    asked = rng.random((20, 12)) * (rng.random((20, 12)) < 0.4)
    score = np.round(asked @ counts / np.sqrt(lengths), 8)
    floors = np.where(np.arange(20) % 3 == 0, np.nan, 0.4)
    pairs = [[{"code": int(codes[t]), "weight": w} for t, w in enumerate(a) if w] + [{"code": 999, "weight": 1.0}] for a in asked]
    kind = pa.list_(pa.struct([("code", pa.int64()), ("weight", pa.float64())]))
    part = pa.record_batch([pa.array(range(20)), pa.array(pairs, kind), pa.array(floors)], ["query_id", "pairs", "floor"])
    got, (found, scores) = held.score(part)
    expected = []
    for q in range(20):
        near = [(-s, d) for d, s in enumerate(score[q]) if s > 0 and not s < floors[q]]
        expected += [(q, f"d{d:02}", -s) for s, d in sorted(near)[:4]]
    assert [(q, d) for q, d in zip(got.to_pylist(), found.to_pylist())] == [e[:2] for e in expected]
    assert scores.to_pylist() == pytest.approx([e[2] for e in expected], abs=1e-8)


@pytest.mark.parametrize(("texts", "asked"), [([], ["red"]), (["red sea"], []), (["of", "", None], ["of red"]), (["x y", "red"], ["red of"])])
def test_nothing_to_find(spark, texts, asked):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "document_id long, text string")
    queries = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "query_id long, text string")
    hits = lexical.tfidf_search(queries, lexical.tfidf_index(docs, ["of"]), 3)
    assert [tuple(r)[:2] for r in hits.collect()] == ([(0, 1)] if texts[:1] == ["x y"] else [])
    prompts = explain.qa_prompts(queries, hits, docs).collect()
    assert [r["n_evidence"] for r in prompts] == [int(texts[:1] == ["x y"])] * len(asked)
