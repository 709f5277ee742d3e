"""Whole jobs: from shipments and notes to results, and from questions to answers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costwatch.operators.corpus import note_docs, qa_corpus
from costwatch.operators.explain import answer, explain, ground_prompts, qa_prompts
from costwatch.operators.hybrid import retrieve_evidence
from costwatch.operators.lexical import tfidf_index, tfidf_search
from costwatch.operators.metrics import candidates, score_route_weeks, weekly_metrics
from costwatch.operators.prepare import prepare_shipments
from costwatch.operators.verdict import assign_verdict, shape_results, with_explanations
from costwatch.settings import DEFAULT_MODEL, QUESTION_TOP_K, THRESHOLD_PCT
from costwatch.staging import stage


def weekly_table(shipments: DataFrame) -> DataFrame:
    """Staged weekly metrics: the only pass over the shipments."""
    return stage(weekly_metrics(prepare_shipments(shipments)), "weekly")


def scored_table(shipments: DataFrame, threshold_pct: float = THRESHOLD_PCT) -> DataFrame:
    """Staged route-weeks with baselines and flags."""
    return stage(score_route_weeks(weekly_table(shipments), threshold_pct), "scored")


@dataclass(frozen=True)
class Assessment:
    verdicts: DataFrame
    results: DataFrame
    calls: DataFrame


def assess(
    shipments: DataFrame,
    notes: DataFrame,
    strategy: str = "post",
    threshold_pct: float = THRESHOLD_PCT,
    generator: Callable | None = None,
    **retrieval,
) -> Assessment:
    """Score all route-weeks, look for evidence on the candidates, decide and explain.

    `calls` has one row per explanation with its model and token counts, as `usage_cost`
    takes it. Four jobs run before this returns: the weekly table, the scored table, the notes
    (with `post` also queries, vectors and index) and the verdicts are written; with a generator
    the explanations too.
    """
    scored = scored_table(shipments, threshold_pct)
    evidence = retrieve_evidence(candidates(scored), notes, strategy, **retrieval)
    verdicts = stage(assign_verdict(scored, evidence), "verdicts")
    explained = explain(ground_prompts(verdicts, note_docs(notes)), generator)
    if generator is not None:  # one call per explanation: keep its text, never ask twice
        explained = stage(explained, "explanations")
        verdicts = with_explanations(verdicts, explained)
    model = F.lit(getattr(generator, "__name__", None) or DEFAULT_MODEL).alias("model")
    calls = explained.select("route", "week_of", model, "input_tokens", "output_tokens")
    return Assessment(verdicts, shape_results(verdicts), calls)


def ask(
    questions: DataFrame,
    results: DataFrame,
    notes: DataFrame,
    k: int = QUESTION_TOP_K,
    generator: Callable | None = None,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Answer every question (query_id, text) from result rows and notes."""
    docs = stage(qa_corpus(results, notes), "qa_corpus")
    hits = tfidf_search(questions, tfidf_index(docs, stop_words), k)
    return answer(qa_prompts(questions, hits, docs), generator)
