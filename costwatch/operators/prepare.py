"""Shipment projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costwatch.functions.measures import monday
from costwatch.functions.text import strip
from costwatch.operators.quality import require_columns


def with_route(df: DataFrame) -> DataFrame:
    """Add `route` as `origin-destination`; null if either end is null."""
    require_columns(df, ["origin", "destination"], "route")
    return df.withColumn(
        "route", F.concat(strip(F.col("origin")), F.lit("-"), strip(F.col("destination")))
    )


def with_week(df: DataFrame, date_col: str = "shipment_date") -> DataFrame:
    """Add `week_of`, the Monday of the date's week."""
    require_columns(df, [date_col], "week")
    return df.withColumn("week_of", monday(F.col(date_col)))


def with_tonne_km(df: DataFrame) -> DataFrame:
    return df.withColumn("tonne_km", F.col("quantity_tonnes") * F.col("distance_km"))


def prepare_shipments(df: DataFrame) -> DataFrame:
    return with_week(with_route(df))
