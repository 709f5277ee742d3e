"""Date and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def monday(c: Column) -> Column:
    """Monday of the date's week, without a time."""
    return F.date_trunc("week", c).cast("date")


def no_nan(c: Column) -> Column:
    """NaN becomes null: Spark compares NaN as larger than every number."""
    return F.when(~F.isnan(c), c)


def pct_difference(value: Column, base: Column) -> Column:
    """(value - base) / base * 100; a rise from zero is infinite, zero from zero is null."""
    return (
        F.when((base == 0) & (value > 0), float("inf"))
        .when(base != 0, (value - base) / base * 100)
        .cast("double")
    )


def round_exact(c: Column, decimals: int) -> Column:
    """Nearest decimal to the exact binary value, as C and Python format it; ties to even.

    Spark's own rounding starts from the shortest decimal text of a double, which sends
    0.15 (binary 0.1499...) up. Splitting the value in two halves makes the product with a
    power of ten exact, so that the side of a tie can be told.
    """
    scale = float(10**decimals)
    high = c * 134217729.0 - (c * 134217729.0 - c)
    floor = F.floor(c * scale).cast("double")
    beyond_half = (high * scale - (floor + 0.5)) + (c - high) * scale
    up = F.when(beyond_half == 0, floor % 2 != 0).otherwise(beyond_half > 0)
    return (floor + F.when(up, 1.0).otherwise(0.0)) / scale


def decimal_text(c: Column, decimals: int) -> Column:
    """Fixed-point text of a finite number."""
    return F.format_string(f"%.{decimals}f", round_exact(c, decimals))


def round_cents(c: Column) -> Column:
    """Two decimals, scaled value rounded half to even."""
    return F.rint(c * 100) / 100
