"""Verdicts and the result table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch import settings
from costwatch.functions.measures import round_cents
from costwatch.functions.text import comparison_text, signed_percent
from costwatch.operators.ranking import first_valid


def with_comparison_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "vs_own_history": comparison_text(
                F.col("vs_own_history_pct"), settings.OWN_HISTORY_PHRASE
            ),
            "vs_similar_routes": comparison_text(
                F.col("vs_similar_routes_pct"), settings.SIMILAR_ROUTES_PHRASE
            ),
        }
    )


def rejected_reason(note_id: Column, note_date: Column, snippet: Column) -> Column:
    return F.format_string(
        settings.REJECTED_NOTE_REASON, note_id, note_date.cast("string"), snippet
    )


def _pct(name: str) -> Column:
    return F.when(F.col(name).isNull(), "not known").otherwise(
        F.concat(signed_percent(F.col(name)), F.lit("%"))
    )


def default_explanation() -> Column:
    """Explanation from the row's own values and its note only."""
    return F.concat(
        F.lit("Note "), F.col("note_id"), F.lit(", dated "), F.col("note_date").cast("string"),
        F.lit(', reports "'), F.col("snippet"), F.lit('". It supports the cost rise on '),
        F.col("route"), F.lit(" in the week of "), F.col("week_of").cast("string"),
        F.lit(" (own history "), _pct("vs_own_history_pct"),
        F.lit(", similar routes "), _pct("vs_similar_routes_pct"), F.lit(")."),
    )


def assign_verdict(scored: DataFrame, evidence: DataFrame) -> DataFrame:
    """Verdict, matched note and reason for every route-week; `evidence` of the candidates."""
    best = first_valid(evidence)
    out = scored.join(best, ["route", "week_of"], "left")
    candidate, valid = F.col("is_candidate_anomaly"), F.col("valid").isNotNull()
    chosen = F.when(candidate, F.coalesce("valid", "closest"))
    flagged = (
        F.when(~candidate, settings.NORMAL)
        .when(valid, settings.JUSTIFIED)
        .otherwise(settings.UNEXPLAINED)
    )
    out = out.withColumn("_note", chosen).withColumns(
        {
            "flagged": flagged,
            "note_id": F.col("_note.note_id"),
            "note_date": F.col("_note.note_date"),
            "snippet": F.col("_note.snippet"),
        }
    )
    reason = (
        F.when(F.col("flagged") == settings.NORMAL, settings.NORMAL_REASON)
        .when(F.col("flagged") == settings.JUSTIFIED, default_explanation())
        .when(F.col("note_id").isNull(), settings.NO_NOTE_REASON)
        .otherwise(rejected_reason(F.col("note_id"), F.col("note_date"), F.col("snippet")))
    )
    return out.withColumn("reason", reason).select(
        *scored.columns,
        "flagged",
        "note_id",
        "note_date",
        "snippet",
        F.when(F.col("flagged") == settings.JUSTIFIED, F.col("note_id")).alias("matched_note_id"),
        "reason",
    )


def with_explanations(verdicts: DataFrame, explanations: DataFrame) -> DataFrame:
    """Reasons replaced where `explanations` (route, week_of, reason) has one."""
    given = explanations.select("route", "week_of", F.col("reason").alias("_given"))
    joined = verdicts.join(given, ["route", "week_of"], "left")
    return joined.withColumn("reason", F.coalesce("_given", "reason")).select(*verdicts.columns)


def shape_results(verdicts: DataFrame) -> DataFrame:
    """The eight result columns in their order, formatted."""
    return with_comparison_text(verdicts).select(
        "route",
        F.date_format("week_of", "yyyy-MM-dd").alias("week_of"),
        round_cents(F.col("cost_per_tonne_km")).alias("cost_per_tonne_km"),
        "vs_own_history",
        "vs_similar_routes",
        "flagged",
        F.coalesce("matched_note_id", F.lit("")).alias("matched_note_id"),
        "reason",
    )
