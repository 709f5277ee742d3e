"""Weekly cost per tonne-km and its two baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costwatch.functions.measures import no_nan, pct_difference
from costwatch.operators.quality import require_columns
from costwatch.settings import HISTORY_WEEKS, THRESHOLD_PCT

WEEK_KEY = ["route", "week_of"]


def weekly_metrics(df: DataFrame) -> DataFrame:
    """One row per route and week; the cost is the ratio of the sums.

    The route type is that of the earliest shipment. Types are part of the first grouping
    key, so that every aggregate over shipments is a number and runs as a hash aggregate.
    Partial aggregation leaves each map task with one row per route, week and type, so a
    route that holds most of the shipments is no heavier to merge than any other.
    """
    require_columns(
        df,
        [*WEEK_KEY, "route_type", "quantity_tonnes", "distance_km", "freight_cost_inr"],
        "weekly metrics",
    )
    quantity, distance = no_nan(F.col("quantity_tonnes")), no_nan(F.col("distance_km"))
    dated = "shipment_date" if "shipment_date" in df.columns else "week_of"
    by_type = df.groupBy(*WEEK_KEY, "route_type").agg(
        F.sum(quantity).alias("total_quantity_tonnes"),
        F.sum(distance).alias("total_distance_km"),
        F.sum(quantity * distance).alias("total_tonne_km"),
        F.sum("freight_cost_inr").alias("total_freight_cost_inr"),
        F.count(F.lit(1)).alias("shipment_count"),
        F.min(dated).alias("_first"),
    )
    totals = [c for c in by_type.columns if c.startswith("total_") or c == "shipment_count"]
    sums = by_type.groupBy(*WEEK_KEY).agg(
        F.min(F.when(F.col("route_type").isNotNull(), F.struct("_first", "route_type")))[
            "route_type"
        ].alias("route_type"),
        *[F.sum(c).alias(c) for c in totals],
    )
    freight = F.col("total_freight_cost_inr").cast("double")
    tonne_km = F.col("total_tonne_km")
    return sums.withColumn(
        "cost_per_tonne_km",
        F.when(tonne_km != 0, freight / tonne_km).when(freight > 0, float("inf")),
    )


def own_history_baseline(df: DataFrame, weeks: int = HISTORY_WEEKS) -> DataFrame:
    """Mean of up to `weeks` previous observed rows of the route, and the difference to it.

    The window runs over route-weeks, not shipments: a partition is as long as the route's
    calendar, whatever the number of its shipments.
    """
    require_columns(df, [*WEEK_KEY, "cost_per_tonne_km"], "own history")
    before = Window.partitionBy("route").orderBy("week_of").rowsBetween(-weeks, -1)
    cost = no_nan(F.col("cost_per_tonne_km"))
    out = df.withColumn("own_history_baseline", F.avg(cost).over(before))
    return out.withColumn(
        "vs_own_history_pct", pct_difference(cost, F.col("own_history_baseline"))
    )


def similar_route_baseline(df: DataFrame) -> DataFrame:
    """Mean of the other routes of the same type in the same week, and the difference to it.

    The group totals come from a partially aggregated `groupBy` joined back, not from a
    window: a window would put all routes of a week and type into one task. `df` is read
    twice, so pass a staged table where it is costly. A route without a type has no peers.
    """
    require_columns(df, [*WEEK_KEY, "route_type", "cost_per_tonne_km"], "similar routes")
    peer_key = ["week_of", "route_type"]
    cost = no_nan(F.col("cost_per_tonne_km"))
    totals = df.groupBy(*peer_key).agg(
        F.sum(cost).alias("_peer_sum"), F.count(cost).alias("_peer_count")
    )
    others = F.col("_peer_count") - 1
    out = df.join(totals, peer_key, "left").withColumn(
        "similar_route_baseline", F.when(others > 0, (F.col("_peer_sum") - cost) / others)
    )
    return out.withColumn(
        "vs_similar_routes_pct", pct_difference(cost, F.col("similar_route_baseline"))
    ).select(*df.columns, "similar_route_baseline", "vs_similar_routes_pct")


def detect_anomalies(df: DataFrame, threshold_pct: float = THRESHOLD_PCT) -> DataFrame:
    """Flag rises of at least the threshold on either comparison; a missing one is no rise."""
    require_columns(df, ["vs_own_history_pct", "vs_similar_routes_pct"], "anomalies")

    def rises(pct: str):
        return F.coalesce(no_nan(F.col(pct)) >= threshold_pct, F.lit(False))

    return (
        df.withColumn("anomaly_own_history", rises("vs_own_history_pct"))
        .withColumn("anomaly_similar_routes", rises("vs_similar_routes_pct"))
        .withColumn(
            "is_candidate_anomaly",
            F.col("anomaly_own_history") | F.col("anomaly_similar_routes"),
        )
    )


def candidates(df: DataFrame) -> DataFrame:
    return df.filter("is_candidate_anomaly")


def first_weeks(df: DataFrame) -> DataFrame:
    """Earliest row of every route."""
    position = F.row_number().over(Window.partitionBy("route").orderBy("week_of"))
    return df.withColumn("_p", position).filter("_p = 1").drop("_p")


def score_route_weeks(weekly: DataFrame, threshold_pct: float = THRESHOLD_PCT) -> DataFrame:
    """Both baselines and the flags; pass a staged weekly table."""
    scored = similar_route_baseline(own_history_baseline(weekly))
    return detect_anomalies(scored, threshold_pct)
