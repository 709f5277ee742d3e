"""Hybrid ranking, reranking and evidence retrieval."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costwatch.functions.text import bigrams, tokenize
from costwatch.operators.corpus import note_docs, retrieval_queries, route_week_id
from costwatch.operators.dense import dense_search, encode, encode_counted
from costwatch.operators.evidence import (
    EVIDENCE_COLUMNS,
    matching_notes,
    note_order,
    with_pair_flags,
    with_snippet,
    with_text_flags,
)
from costwatch.operators.lexical import LexicalIndex, bm25_search, lexical_index, query_terms
from costwatch.operators.ranking import SCORE_DECIMALS, best_hits, minmax_normalize, top_k
from costwatch.settings import (
    CANDIDATE_K,
    DENSE_WEIGHT,
    LEXICAL_WEIGHT,
    NOTE_WINDOW_DAYS,
    TOP_K,
)
from costwatch.staging import join_side, stage

BIGRAM_WEIGHT = 0.5


def merge_hits(dense: DataFrame, lexical: DataFrame) -> DataFrame:
    """Hits of either search; a score that is missing on one side is 0."""
    return dense.select("query_id", "document_id", F.col("score").alias("dense_score")).join(
        lexical.select("query_id", "document_id", F.col("score").alias("lexical_score")),
        ["query_id", "document_id"],
        "full",
    ).fillna(0.0, ["dense_score", "lexical_score"])


def hybrid_scores(
    dense: DataFrame,
    lexical: DataFrame,
    dense_weight: float = DENSE_WEIGHT,
    lexical_weight: float = LEXICAL_WEIGHT,
) -> DataFrame:
    """Merged hits with both scaled scores and their weighted sum.

    Input are two top-k lists, so a query holds a bounded number of rows.
    """
    if abs(dense_weight + lexical_weight - 1.0) > 1e-9:
        raise ValueError("dense and lexical weights must sum to 1")
    merged = minmax_normalize(merge_hits(dense, lexical), "dense_score", "dense_scaled")
    merged = minmax_normalize(merged, "lexical_score", "lexical_scaled")
    total = dense_weight * F.col("dense_scaled") + lexical_weight * F.col("lexical_scaled")
    return merged.withColumn("hybrid_score", F.round(total, SCORE_DECIMALS))


def hybrid_search(
    queries: DataFrame,
    query_vectors: DataFrame,
    index: LexicalIndex,
    vectors: DataFrame,
    k: int = TOP_K,
    candidate_k: int = CANDIDATE_K,
    dense_weight: float = DENSE_WEIGHT,
    lexical_weight: float = LEXICAL_WEIGHT,
) -> DataFrame:
    """`k` best documents per query out of the `candidate_k` best of both searches."""
    dense = dense_search(query_vectors, vectors, candidate_k)
    lexical = bm25_search(queries, index, candidate_k, pad=True)
    scored = hybrid_scores(dense, lexical, dense_weight, lexical_weight)
    return best_hits(scored, "hybrid_score", k)


def rerank(
    hits: DataFrame,
    queries: DataFrame,
    docs: DataFrame,
    index: LexicalIndex,
    k: int = TOP_K,
    scorer: Callable[[pd.Series, pd.Series], pd.Series] | None = None,
) -> DataFrame:
    """Score each hit on its two whole texts and rank again; the hits' own scores stay.

    Default: idf-weighted share of the query's terms that the document holds, plus half the
    share of its word pairs, from postings and a table of pairs. An own `scorer` maps query and
    document texts to scores; only for it texts are joined to the hits.
    """
    scored = scored_hits(hits.drop("rank"), queries, docs, index, scorer)
    return best_hits(scored, "rerank_score", k)


def scored_hits(
    hits: DataFrame, queries: DataFrame, docs: DataFrame, index: LexicalIndex, scorer: Callable | None = None
) -> DataFrame:
    """`hits` with `rerank_score`."""
    pairs = stage(hits, "hits_to_rerank")
    if scorer is not None:
        texts = docs.select("document_id", F.col("text").alias("_doc"))
        asked = queries.select("query_id", F.col("text").alias("_query"))
        score = F.pandas_udf(scorer, "double")(F.col("_query"), F.col("_doc"))
        scored = pairs.join(texts, "document_id").join(asked, "query_id").withColumn("_score", score)
    else:
        scored = pairs.join(pair_scores(pairs, queries, docs, index), ["query_id", "document_id"])
    return scored.select(*pairs.columns, F.round("_score", SCORE_DECIMALS).alias("rerank_score"))


def pair_scores(pairs: DataFrame, queries: DataFrame, docs: DataFrame, index: LexicalIndex) -> DataFrame:
    """(query_id, document_id, _score) of written pairs, from terms and word pairs that match.

    No text leaves its row: documents of the pairs are found by their ids, and of their word
    pairs only those that a query holds are kept.
    """
    wanted = stage(pairs.select("document_id").distinct(), "documents_to_rerank")
    of_pairs = lambda frame: frame.join(join_side(wanted), "document_id", "left_semi")
    key = ["query_id", "document_id"]

    weights = stage(_query_weights(queries, index), "query_weights")
    held = of_pairs(index.counted).select("document_id", F.explode("counts.term").alias("term"))
    held = held.join(weights.select("term").distinct(), "term", "left_semi")
    covered = pairs.select(*key).join(weights, "query_id").join(held, ["document_id", "term"])
    covered = covered.groupBy(*key).agg(F.sum("idf").alias("_covered"))

    word_pairs = lambda c: F.array_distinct(bigrams(tokenize(F.col(c))))
    asked = queries.select("query_id", word_pairs("text").alias("_pairs"))
    per_query = asked.select("query_id", F.coalesce(F.size("_pairs"), F.lit(0)).alias("_n_pairs")).join(
        weights.groupBy("query_id").agg(F.sum("idf").alias("_idf_sum")), "query_id", "left"
    )
    asked = asked.select("query_id", F.explode("_pairs").alias("pair"))
    found = of_pairs(docs).select("document_id", F.explode(word_pairs("text")).alias("pair"))
    found = found.join(asked.select("pair").distinct(), "pair", "left_semi")
    shared = pairs.select(*key).join(asked, "query_id").join(found, ["document_id", "pair"])
    shared = shared.groupBy(*key).agg(F.count(F.lit(1)).alias("_shared"))

    scored = pairs.select(*key).join(per_query, "query_id").join(covered, key, "left").join(shared, key, "left")
    share = F.coalesce("_shared", F.lit(0)) / F.greatest("_n_pairs", F.lit(1))
    coverage = F.coalesce(F.col("_covered") / F.col("_idf_sum"), F.lit(0.0))
    return scored.select(*key, (coverage + BIGRAM_WEIGHT * share).alias("_score"))


def _query_weights(queries: DataFrame, index: LexicalIndex) -> DataFrame:
    """(query_id, term, idf) with ln(1 + (N - df + 0.5) / (df + 0.5)) for each term of a query."""
    n = index.documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    df = F.coalesce("df", F.lit(0))
    return (
        query_terms(queries, index.tokens)
        .join(index.terms, "term", "left")
        .select("query_id", "term", F.log(1 + (n - df + 0.5) / (df + 0.5)).alias("idf"))
    )


def retrieve_evidence(
    route_weeks: DataFrame,
    notes: DataFrame,
    strategy: str = "post",
    k: int = TOP_K,
    candidate_k: int = CANDIDATE_K,
    days: int = NOTE_WINDOW_DAYS,
    encoder: Callable | None = None,
    scorer: Callable | None = None,
) -> DataFrame:
    """Up to `k` ranked notes per route-week, each with its rule flags and scores.

    `post` ranks all notes by hybrid search and reranking and then checks the rules, so a
    valid note outside the best `k` is not seen. `pre` joins on route and date first and
    ranks what fits: usable notes first, then by their rerank score. Stages documents, queries
    and index, for `post` vectors too.
    """
    if strategy not in ("pre", "post"):
        raise ValueError(f"unknown strategy {strategy!r}")
    docs = stage(with_snippet(with_text_flags(note_docs(notes), "text")), "note_docs")
    queries = stage(retrieval_queries(route_weeks), "queries")
    index = lexical_index(docs)
    if strategy == "pre":
        pairs = matching_notes(queries, docs.drop("text"), days, k).withColumn("query_id", route_week_id())
        scored = scored_hits(pairs, queries, docs, index, scorer)
        order = note_order(F.col("rerank_score").desc())
        ranked = top_k(scored, k, order, group=["route", "week_of"])
        return with_pair_flags(ranked, days).select(*EVIDENCE_COLUMNS, "rerank_score")
    encoded = encode_counted(index.counted) if encoder is None else encode(docs, "document_id", encoder=encoder)
    vectors = stage(encoded, "vectors")
    asked = stage(encode(queries, "query_id", encoder=encoder), "query_vectors")
    hits = hybrid_search(queries, asked, index, vectors, k, candidate_k)
    ranked = rerank(hits, queries, docs, index, k, scorer)
    found = ranked.join(docs.drop("text"), "document_id").join(
        queries.select("query_id", "route", "week_of"), "query_id"
    )
    scores = ["rerank_score", "hybrid_score", "dense_score", "lexical_score"]
    return with_pair_flags(found, days).select(*EVIDENCE_COLUMNS, *scores)
