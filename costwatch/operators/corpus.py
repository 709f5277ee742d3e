"""Searchable documents and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costwatch import settings
from costwatch.functions.measures import decimal_text
from costwatch.functions.text import strip


def note_docs(notes: DataFrame) -> DataFrame:
    """Notes as documents: one labelled sentence per field."""
    fields = {c: strip(F.col(c).cast("string")) for c in settings.NOTE_COLUMNS}
    return notes.select(
        F.concat(F.lit("context_"), fields["note_id"]).alias("document_id"),
        fields["note_id"].alias("note_id"),
        F.col("date").alias("note_date"),
        fields["applies_to"].alias("applies_to"),
        F.format_string(settings.NOTE_DOC_FORMAT, *fields.values()).alias("text"),
    )


def _blank(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def finding_docs(results: DataFrame) -> DataFrame:
    """Result rows as documents for questions; a missing value is blank."""
    return results.select(
        F.concat_ws("|", F.lit("finding"), "route", "week_of").alias("document_id"),
        F.format_string(
            settings.FINDING_FORMAT, *[_blank(c) for c in settings.RESULT_COLUMNS]
        ).alias("text"),
        F.lit("finding").alias("source_type"),
        F.col("route"),
        _blank("week_of").alias("week_of"),
        _blank("matched_note_id").alias("note_id"),
    )


def qa_note_docs(notes: DataFrame) -> DataFrame:
    return notes.select(
        F.concat_ws("|", F.lit("context_note"), "note_id").alias("document_id"),
        F.format_string(
            settings.QA_NOTE_FORMAT, *[_blank(c) for c in settings.NOTE_COLUMNS]
        ).alias("text"),
        F.lit("context_note").alias("source_type"),
        F.col("applies_to").alias("route"),
        _blank("date").alias("week_of"),
        F.col("note_id"),
    )


def qa_corpus(results: DataFrame, notes: DataFrame) -> DataFrame:
    """Findings and notes as one corpus."""
    return finding_docs(results).unionByName(qa_note_docs(notes))


def route_week_id():
    return F.concat_ws("|", "route", F.col("week_of").cast("string"))


def retrieval_queries(route_weeks: DataFrame) -> DataFrame:
    """One query per route-week, from its own values and fixed hint words."""
    return route_weeks.select(
        route_week_id().alias("query_id"),
        "route",
        "week_of",
        F.format_string(
            settings.QUERY_FORMAT,
            "route",
            F.col("week_of").cast("string"),
            decimal_text(F.col("cost_per_tonne_km"), 6),
        ).alias("text"),
    )
