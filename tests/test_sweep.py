"""Sparse vectors that all queries pass by: exact hits, no pairs of query and block, few tables."""

import numpy as np
import pytest

from costwatch.operators import blocks, dense, evaluate, lexical

COMMON = [f"w{i}x" for i in range(12)]


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    text = lambda: " ".join(rng.choice(COMMON, rng.integers(3, 9)))
    return [(i, text()) for i in range(240)], [(i, text()) for i in range(60)] + [(60, "none of them"), (61, None)]


def test_sweep_over_blocks_equals_one_block(spark, texts, monkeypatch):
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in texts[0]], "document_id string, text string")
    queries = spark.createDataFrame(texts[1], "query_id long, text string")
    index = lexical.tfidf_index(docs, [])
    rows = lambda: sorted(map(tuple, lexical.tfidf_search(queries, index, 5).collect()))
    monkeypatch.setattr(lexical, "block_count", lambda *_: 1)
    one = rows()
    monkeypatch.setattr(lexical, "block_count", lambda *_: 9)
    assert rows() == one and len(one) == 300
    assert not {60, 61} & {r[0] for r in one}


def test_questions_are_not_dealt_to_blocks(spark, texts, monkeypatch):
    """Every question promises most everywhere: no shuffle may carry a row for each question and block."""
    docs = spark.createDataFrame(texts[0], "document_id long, text string")
    queries = spark.createDataFrame(texts[1], "query_id long, text string")
    written, staged = [], lexical.stage
    monkeypatch.setattr(lexical, "stage", lambda df, name: written.append(name) or staged(df, name))
    monkeypatch.setattr(blocks, "SWEPT_BLOCK", 100, raising=False)
    monkeypatch.setattr(blocks, "POSTING_BLOCK", 100)
    monkeypatch.setattr(blocks, "MIN_POSTING_BLOCK", 50)
    visits, visited = [], blocks._visited
    monkeypatch.setattr(blocks, "_visited", lambda *a: visits.append(a[1].count()) or visited(*a))
    hits = lexical.tfidf_search(queries, lexical.tfidf_index(docs, []), 5)
    assert hits.count() == 300
    assert sum(visits) <= 2 * len(texts[1])
    assert not {"weights", "unit_weights", "blocked_postings"} & set(written)


def test_short_passages_need_no_cut_texts(spark, monkeypatch):
    """Passages of two tokens are looked for by both, those without a token by a few lookups."""
    rows = [(i, f"of the {i} é! offer them {i}") for i in range(40)] + [(90, "proof the rest"), (91, None)]
    docs = spark.createDataFrame(rows, "document_id long, text string")
    asked = [(1, "of the"), (2, "the 7"), (3, "é!"), (4, "Of the"), (5, "fer"), (6, ""), (7, "of"), (7, "e 8"), (8, "the zz")]
    passages = spark.createDataFrame(asked, "query_id long, text string")
    tables, staged, cut = {}, evaluate.stage, []
    monkeypatch.setattr(evaluate, "stage", lambda df, name: tables.setdefault(name, []).append(staged(df, name)) or tables[name][-1])
    grams = evaluate.character_grams
    monkeypatch.setattr(evaluate, "character_grams", lambda text, n: cut.append(str(text)) or grams(text, n))
    got = evaluate.contained_passages(passages, docs, lexical.lexical_index(docs))
    expected = sorted((q, i) for q, p in asked for i, t in rows if t is not None and p in t)
    assert sorted(map(tuple, got.collect())) == expected
    assert not any("_doc" in c for c in cut)
    wider = {(r["query_id"][0], r["term"]) for r in tables["wider_terms"][0].collect()}
    assert (1, "offer") not in wider and (1, "proof") in wider and (5, "offer") in wider


def test_vectors_from_the_index(spark, monkeypatch):
    """The default vectors come from the counted terms; documents are not cut into tokens again."""
    rows = [("a", "One two two three-4"), ("b", ""), ("c", None), ("d", "two é"), ("d", "two two")]
    docs = spark.createDataFrame(rows, "document_id string, text string")
    index = lexical.lexical_index(docs)
    plain = sorted((r[0], list(r[1])) for r in dense.encode(docs, "document_id").collect())
    counted = dense.encode_counted(index.counted)
    assert sorted((r[0], list(r[1])) for r in counted.collect()) == plain
    assert "regexp_extract_all" not in counted._jdf.queryExecution().toString()
