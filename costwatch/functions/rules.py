"""Route and date rules of evidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costwatch.functions.text import normalize_text, strip
from costwatch.settings import ALL_ROUTES


def route_matches(note_route: Column, route: Column) -> Column:
    """Same route, or a note for all routes. Case counts in route names."""
    return (strip(note_route) == strip(route)) | (F.lower(strip(note_route)) == ALL_ROUTES)


def route_matches_lenient(note_route: Column, route: Column) -> Column:
    """As `route_matches`, without regard to case and repeated blanks."""
    return normalize_text(note_route).isin(ALL_ROUTES) | (
        normalize_text(note_route) == normalize_text(route)
    )


def date_matches(note_date: Column, week_of: Column, days: int) -> Column:
    return F.abs(F.date_diff(note_date, week_of)) <= days
