"""Evidence rules, and their use as a join of route-weeks with notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch.functions.rules import date_matches, route_matches, route_matches_lenient
from costwatch.functions.text import matches_any, normalize_text, note_snippet, strip
from costwatch.operators.ranking import top_k
from costwatch.settings import (
    ALL_ROUTES,
    NEGATIVE_PATTERNS,
    NOTE_WINDOW_DAYS,
    POSITIVE_PATTERNS,
    TOP_K,
)

EVIDENCE_COLUMNS = [
    "route",
    "week_of",
    "rank",
    "note_id",
    "note_date",
    "applies_to",
    "snippet",
    "route_match",
    "date_match",
    "positive_evidence",
    "negative_evidence",
    "evidence_valid",
]


def with_text_flags(notes: DataFrame, text_col: str = "note") -> DataFrame:
    """Text rules, evaluated once per note rather than once per pair."""
    normal = F.col("_normal")
    return (
        notes.withColumn("_normal", normalize_text(F.col(text_col)))
        .withColumns(
            {
                "positive_evidence": matches_any(normal, POSITIVE_PATTERNS),
                "negative_evidence": matches_any(normal, NEGATIVE_PATTERNS),
            }
        )
        .drop("_normal")
    )


def with_pair_flags(
    pairs: DataFrame, days: int = NOTE_WINDOW_DAYS, lenient: bool = False
) -> DataFrame:
    """Route and date rules of (route-week, note) pairs, and the verdict of all four rules.

    `lenient` compares route names without regard to case and repeated blanks.
    """
    same_route = route_matches_lenient if lenient else route_matches
    flags = {
        "route_match": same_route(F.col("applies_to"), F.col("route")),
        "date_match": date_matches(F.col("note_date"), F.col("week_of"), days),
    }
    flags = {name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}
    valid = (
        F.col("route_match")
        & F.col("date_match")
        & F.coalesce("positive_evidence", F.lit(False))
        & ~F.coalesce("negative_evidence", F.lit(False))
    )
    return (
        pairs.withColumns(flags)
        .withColumn("evidence_valid", valid)
        .withColumn("verdict", F.when(valid, "justified").otherwise("unexplained"))
    )


def evidence_flags(
    pairs: DataFrame, text_col: str = "note", days: int = NOTE_WINDOW_DAYS, lenient: bool = True
) -> DataFrame:
    """All rules on given pairs with columns route, week_of, applies_to, note_date and text."""
    return with_pair_flags(with_text_flags(pairs, text_col), days, lenient)


def note_weeks(notes: DataFrame, days: int) -> DataFrame:
    """One row per note and Monday within `days` of its date: the date band as a join key."""
    first = F.date_add("note_date", 6 - days)
    first = F.date_trunc("week", first).cast("date")
    last = F.date_add("note_date", days)
    mondays = F.when(first <= last, F.sequence(first, last, F.expr("interval 7 days")))
    return notes.withColumn("week_of", F.explode(mondays)).withColumn(
        "days_apart", F.abs(F.date_diff("note_date", "week_of"))
    )


def note_order(*scores: Column) -> list[Column]:
    """Usable notes first, then by given scores, distance in days and id."""
    return [F.col("_usable").desc(), *scores, F.col("days_apart").asc(), F.col("note_id").asc()]


def matching_notes(route_weeks: DataFrame, notes: DataFrame, days: int, k: int) -> DataFrame:
    """Pairs of route-weeks (Mondays) and notes that fit route and date, at most `2 k` of each.

    Notes that justify a rise come first, then the nearest, then by id. That order does not
    depend on the route-week beyond its key, so notes are cut to `k` per route and week, and
    notes for all routes to `k` per week, before the join: no pair beyond those is ever built.
    `notes` needs note_date, applies_to, note_id and the text flags.
    """
    eligible = note_weeks(notes, days).withColumn(
        "_usable", F.col("positive_evidence") & ~F.col("negative_evidence")
    )
    wildcard = F.lower(strip(F.col("applies_to"))) == ALL_ROUTES
    keys = route_weeks.select("route", "week_of", strip(F.col("route")).alias("_route"))
    own = top_k(
        eligible.filter(~wildcard).withColumn("_route", strip(F.col("applies_to"))),
        k,
        note_order(),
        group=["_route", "week_of"],
    ).drop("rank")
    everywhere = top_k(eligible.filter(wildcard), k, note_order(), group=["week_of"]).drop("rank")
    return (
        keys.join(own, ["_route", "week_of"])
        .drop("_route")
        .unionByName(keys.drop("_route").join(everywhere, "week_of"))
    )


def match_evidence(
    route_weeks: DataFrame, notes: DataFrame, days: int = NOTE_WINDOW_DAYS, k: int = TOP_K
) -> DataFrame:
    """The `k` first notes of each route-week among those that fit route and date, unscored.

    Order: notes that justify a rise first, then by distance in days, then by id. `notes` needs
    note_date, applies_to, note_id, snippet and the text flags.
    """
    pairs = matching_notes(route_weeks, notes, days, k)
    ranked = top_k(pairs, k, note_order(), group=["route", "week_of"])
    return with_pair_flags(ranked, days).select(*EVIDENCE_COLUMNS)


def with_snippet(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs.withColumn("snippet", note_snippet(F.col(text_col)))
