"""Summaries and views of shipments and results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costwatch import settings
from costwatch.functions.rules import date_matches
from costwatch.functions.text import (
    clean_note_id,
    extract_percent,
    format_money,
    parse_number,
    status_label,
    strip,
)
from costwatch.operators.evaluate import one_per_note_id
from costwatch.operators.evidence import with_text_flags
from costwatch.sources.files import CSV_WRITE

ANY_ROUTE = "All Routes"
ANY_STATUS = "All"
# Names of the status filter.
STATUS_FILTERS = {
    "Flagged (Needs Review)": settings.UNEXPLAINED,
    "Justified": settings.JUSTIFIED,
    "Normal": settings.NORMAL,
}


def profile_shipments(prepared: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, routes and weeks; distinct counts are exact unless `approximate`."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return prepared.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct(F.col("route")).alias("n_routes"),
        distinct(F.col("week_of")).alias("n_weeks"),
    )


def verdict_summary(results: DataFrame) -> DataFrame:
    flagged = F.col("flagged")
    return results.agg(
        F.count(F.lit(1)).alias("route_weeks"),
        F.count_if(flagged != settings.NORMAL).alias("anomalies"),
        F.count_if(flagged == settings.JUSTIFIED).alias("justified"),
        F.count_if(flagged == settings.UNEXPLAINED).alias("unexplained"),
        F.count_if(flagged == settings.NORMAL).alias("normal"),
    )


def unexplained_by_route(results: DataFrame) -> DataFrame:
    return (
        results.filter(F.col("flagged") == settings.UNEXPLAINED)
        .groupBy("route")
        .agg(F.count(F.lit(1)).alias("unexplained"))
    )


def route_options(results: DataFrame) -> DataFrame:
    return results.select("route").filter("route is not null").distinct().orderBy("route")


def filter_results(
    results: DataFrame, route: str = ANY_ROUTE, status: str = ANY_STATUS
) -> DataFrame:
    if status != ANY_STATUS and status not in STATUS_FILTERS:
        raise ValueError(f"unknown status {status!r}")
    out = results
    if route != ANY_ROUTE:
        out = out.filter(F.col("route") == route)
    if status != ANY_STATUS:
        out = out.filter(F.col("flagged") == STATUS_FILTERS[status])
    return out


def export_view(results: DataFrame, route: str, status: str, path: str) -> None:
    """Filtered rows as CSV files."""
    filter_results(results, route, status).write.csv(
        path, mode="overwrite", **CSV_WRITE
    )


def report_view(results: DataFrame) -> DataFrame:
    """Display columns of the result table."""
    return results.select(
        "route",
        "week_of",
        format_money(F.col("cost_per_tonne_km")).alias("cost_per_tonne_km"),
        extract_percent(F.col("vs_own_history")).alias("vs_own_history"),
        extract_percent(F.col("vs_similar_routes")).alias("vs_similar_routes"),
        status_label(F.col("flagged")).alias("status"),
        "matched_note_id",
        "reason",
    )


def lookup_notes(results: DataFrame, notes: DataFrame) -> DataFrame:
    """Results with the note they name (null where none is named or known)."""
    named = results.withColumn("matched_id", clean_note_id(F.col("matched_note_id")))
    # Only notes that are named have their texts judged.
    ids = named.select(F.col("matched_id").alias("note_id")).distinct()
    asked = notes.withColumn("note_id", strip(F.col("note_id"))).join(ids, "note_id", "left_semi")
    known = one_per_note_id(with_text_flags(asked), ["date"]).withColumnsRenamed(
        {"note_id": "matched_id", "date": "note_date"}
    )
    return named.join(known, "matched_id", "left")


def investigation_view(
    results: DataFrame, notes: DataFrame, route: str = ANY_ROUTE
) -> DataFrame:
    """Anomalies with their note and the three checks evaluated again."""
    anomalies = filter_results(results, route).filter(F.col("flagged") != settings.NORMAL)
    found = lookup_notes(anomalies, notes)
    applies = F.lower("applies_to")
    checks = {
        "route_ok": (applies == F.lower("route")) | (applies == settings.ALL_ROUTES),
        "date_ok": date_matches(
            F.col("note_date"), F.col("week_of").try_cast("date"), settings.NOTE_WINDOW_DAYS
        ),
        "cost_ok": F.col("positive_evidence") & ~F.col("negative_evidence"),
    }
    return found.select(
        "route",
        "week_of",
        status_label(F.col("flagged")).alias("status"),
        parse_number(F.col("cost_per_tonne_km").cast("string")).alias("cost_per_tonne_km"),
        parse_number(extract_percent(F.col("vs_own_history"))).alias("own_history_pct"),
        parse_number(extract_percent(F.col("vs_similar_routes"))).alias("similar_routes_pct"),
        "reason",
        F.col("matched_id").alias("note_id"),
        "note_date",
        "applies_to",
        "note",
        *[
            F.when(F.col("matched_id").isNotNull(), F.coalesce(c, F.lit(False))).alias(n)
            for n, c in checks.items()
        ],
    )
