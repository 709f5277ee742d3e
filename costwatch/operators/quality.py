"""Data-quality checks: all checks of a table are one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from costwatch import settings


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    """Fail on missing columns; looks at the schema only."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def missing(df: DataFrame, column: str) -> Column:
    """True where the value is null, or NaN in a floating-point column."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def run_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows `(check, violations)`: how many rows satisfy each (bad-row) condition.

    A check named `empty` is added; it has one violation if the table has no row.
    """
    aggregates = [F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("empty")]
    aggregates += [F.count_if(cond).cast("bigint").alias(name) for name, cond in checks.items()]
    names = ["empty", *checks]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("violations")) for n in names]
    )
    return df.agg(*aggregates).select(F.inline(pairs))


def enforce(checked: DataFrame) -> None:
    """Raise `ValueError` naming every failed check. Runs the (one-row) aggregate."""
    failed = checked.filter("violations > 0").orderBy("check").collect()
    if failed:
        raise ValueError(
            "failed checks: " + ", ".join(f"{r['check']}={r['violations']}" for r in failed)
        )


def shipment_checks(df: DataFrame) -> DataFrame:
    require_columns(df, settings.SHIPMENT_COLUMNS, "shipments")
    checks = {f"missing_{c}": missing(df, c) for c in settings.SHIPMENT_REQUIRED}
    checks["quantity_not_positive"] = F.col("quantity_tonnes") <= 0
    checks["distance_not_positive"] = F.col("distance_km") <= 0
    checks["freight_negative"] = F.col("freight_cost_inr") < 0
    return run_checks(df, checks)


def note_checks(df: DataFrame) -> DataFrame:
    require_columns(df, settings.NOTE_COLUMNS, "notes")
    return run_checks(df, {f"missing_{c}": missing(df, c) for c in settings.NOTE_COLUMNS})


def prepared_checks(df: DataFrame) -> DataFrame:
    require_columns(df, ["route", "week_of"], "prepared shipments")
    return run_checks(
        df,
        {
            "missing_route": F.col("route").isNull(),
            "missing_week": F.col("week_of").isNull(),
            "week_not_monday": F.weekday("week_of") != 0,
        },
    )


def weekly_checks(df: DataFrame) -> DataFrame:
    require_columns(df, ["cost_per_tonne_km", "total_tonne_km"], "weekly metrics")
    return run_checks(
        df,
        {
            "cost_missing": missing(df, "cost_per_tonne_km"),
            "cost_infinite": F.abs("cost_per_tonne_km") == float("inf"),
            "tonne_km_not_positive": F.col("total_tonne_km") <= 0,
        },
    )


def baseline_checks(df: DataFrame) -> DataFrame:
    """The earliest week of a route has no own baseline; baselines that exist are positive."""
    require_columns(
        df, ["route", "week_of", "own_history_baseline", "similar_route_baseline"], "baselines"
    )
    own, peer = F.col("own_history_baseline"), F.col("similar_route_baseline")
    earliest = F.row_number().over(Window.partitionBy("route").orderBy("week_of"))
    return run_checks(
        df.withColumn("_position", earliest),
        {
            "first_week_has_baseline": (F.col("_position") == 1) & own.isNotNull(),
            "own_baseline_not_positive": own <= 0,
            "peer_baseline_not_positive": peer <= 0,
        },
    )


def anomaly_checks(df: DataFrame) -> DataFrame:
    flags = ["anomaly_own_history", "anomaly_similar_routes", "is_candidate_anomaly"]
    require_columns(df, flags, "anomalies")
    either = F.col(flags[0]) | F.col(flags[1])
    return run_checks(
        df,
        {
            "flag_missing": F.greatest(*[F.col(c).isNull() for c in flags]),
            "candidate_not_or": F.col(flags[2]) != either,
        },
    )
