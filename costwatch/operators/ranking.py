"""Ranking: top-k per group, min-max scores, best evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Scores are compared at this many decimals, so that the order in which a sum was added up
# cannot decide a tie; ties go to the smaller id.
SCORE_DECIMALS = 8


def top_k(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    group: Sequence[str] = ("query_id",),
    rank: str = "rank",
) -> DataFrame:
    """The `k` first rows of each group with their rank.

    Spark limits every group to `k` rows before the shuffle as well (WindowGroupLimit), so
    a large group never reaches one task whole.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    position = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, position).filter(F.col(rank) <= k)


def best_hits(df: DataFrame, score: str, k: int) -> DataFrame:
    """Best documents per query: score down, id up."""
    return top_k(df, k, [F.col(score).desc(), F.col("document_id").asc()])


def minmax_normalize(hits: DataFrame, score: str, out: str) -> DataFrame:
    """Scores of each query scaled to 0..1; all 1.0 where minimum and maximum are close."""
    per_query = Window.partitionBy("query_id")
    low, high = F.min(score).over(per_query), F.max(score).over(per_query)
    close = F.abs(low - high) <= 1e-8 + 1e-5 * F.abs(high)
    return hits.withColumn(
        out, F.when(close, 1.0).otherwise((F.col(score) - low) / (high - low))
    )


def first_valid(evidence: DataFrame) -> DataFrame:
    """Per route-week the best-ranked valid note (`valid`) and best-ranked note (`closest`)."""
    note = F.struct("rank", "note_id", "note_date", "snippet")
    return evidence.groupBy("route", "week_of").agg(
        F.min(F.when(F.col("evidence_valid"), note)).alias("valid"), F.min(note).alias("closest")
    )
