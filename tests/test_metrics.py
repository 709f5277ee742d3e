import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from costwatch.operators import metrics, prepare, quality

SHIPMENTS = (
    "shipment_id string, origin string, destination string, route_type string, material string, "
    "quantity_tonnes double, distance_km double, freight_cost_inr decimal(18,2), "
    "shipment_date date, transporter string"
)
WEEKLY = "route string, week_of date, route_type string, cost_per_tonne_km double"


def shipment(n, day, origin="Porto", quantity=10.0, km=100.0, freight="500.00", kind="Short"):
    from decimal import Decimal

    return (
        f"S{n}", origin, "Faro ", kind, None, float(quantity), float(km), Decimal(freight),
        dt.date.fromisoformat(day), None,
    )


def weekly(spark, costs, kind="Short", start="2025-01-06", skip=()):
    first = dt.date.fromisoformat(start)
    return spark.createDataFrame(
        [
            (route, first + dt.timedelta(weeks=i), kind, c)
            for route, series in costs.items()
            for i, c in enumerate(series)
            if i not in skip
        ],
        WEEKLY,
    )


def by_week(df, column, route="A"):
    rows = df.filter(F.col("route") == route).orderBy("week_of").collect()
    return [r[column] for r in rows]


def test_weekly_cost_is_the_ratio_of_sums(spark):
    rows = [
        shipment(1, "2025-01-06", quantity=10, km=100, freight="1000.00", kind="Long"),
        shipment(2, "2025-01-12", quantity=30, km=50, freight="1500.00"),
        shipment(3, "2025-01-13", freight="700.00"),
        shipment(4, "2025-01-07", origin=" Lisboa", freight="0.00"),
    ]
    out = metrics.weekly_metrics(
        prepare.prepare_shipments(spark.createDataFrame(rows, SHIPMENTS))
    )
    got = {(r["route"], r["week_of"].isoformat()): r for r in out.collect()}
    assert set(got) == {
        ("Porto-Faro", "2025-01-06"),
        ("Porto-Faro", "2025-01-13"),
        ("Lisboa-Faro", "2025-01-06"),
    }
    first = got[("Porto-Faro", "2025-01-06")]
    assert first["cost_per_tonne_km"] == 2500.0 / 2500.0
    assert (first["shipment_count"], first["route_type"]) == (2, "Long")
    assert got[("Lisboa-Faro", "2025-01-06")]["cost_per_tonne_km"] == 0.0


def test_own_history_uses_previous_observed_rows_only(spark):
    series = [2.0 + 0.1 * i for i in range(12)]
    out = metrics.own_history_baseline(weekly(spark, {"A": series, "B": [2.5] * 12}))
    base = by_week(out, "own_history_baseline")
    assert base[0] is None and base[1] == 2.0
    assert base[11] == pytest.approx(sum(series[3:11]) / 8)
    pct = by_week(out, "vs_own_history_pct")
    assert pct[11] == pytest.approx((series[11] - base[11]) / base[11] * 100)
    assert by_week(out, "vs_own_history_pct", "B")[1:] == [0.0] * 11
    # a missing week does not count: the window is over rows
    gap = metrics.own_history_baseline(weekly(spark, {"A": series}, skip=(5,)))
    kept = [c for i, c in enumerate(series) if i != 5]
    assert by_week(gap, "own_history_baseline")[-1] == pytest.approx(sum(kept[2:10]) / 8)


def test_zero_history(spark):
    scored = metrics.detect_anomalies(
        metrics.similar_route_baseline(
            metrics.own_history_baseline(weekly(spark, {"A": [0.0, 0.0, 3.0]}))
        )
    )
    assert by_week(scored, "vs_own_history_pct") == [None, None, math.inf]
    assert by_week(scored, "is_candidate_anomaly") == [False, False, True]


def test_peers_exclude_the_route_itself(spark):
    both = weekly(spark, {"A": [4.0], "B": [2.0], "C": [3.0]}).union(
        weekly(spark, {"D": [9.0]}, kind="Long")
    )
    untyped = spark.createDataFrame([("E", dt.date(2025, 1, 6), None, 7.0)], WEEKLY)
    out = metrics.similar_route_baseline(both.union(untyped))
    got = {r["route"]: r["similar_route_baseline"] for r in out.collect()}
    assert got == {"A": 2.5, "B": 3.5, "C": 3.0, "D": None, "E": None}


def test_threshold_is_inclusive_and_missing_is_no_rise(spark):
    rows = [(20.0, None), (19.999, 5.0), (None, 20.0), (None, None), (math.nan, math.nan), (-50.0, 1.0)]
    frame = spark.createDataFrame(rows, "vs_own_history_pct double, vs_similar_routes_pct double")
    flags = [r["is_candidate_anomaly"] for r in metrics.detect_anomalies(frame).collect()]
    assert flags == [True, False, True, False, False, False]


def test_one_route_with_most_shipments(spark):
    hot = spark.range(30_000).select(
        F.lit("H").alias("route"), F.lit("Short").alias("route_type"),
        F.date_add(F.lit("2025-01-06").cast("date"), (F.col("id") % 2 * 7).cast("int")).alias("week_of"),
        F.lit(1.0).alias("quantity_tonnes"), F.lit(2.0).alias("distance_km"),
        F.lit("3.00").cast("decimal(18,2)").alias("freight_cost_inr"),
    )
    out = metrics.weekly_metrics(hot).collect()
    assert sorted(r["shipment_count"] for r in out) == [15_000, 15_000]
    assert {r["cost_per_tonne_km"] for r in out} == {1.5}


def test_checks(spark):
    rows = [
        shipment(1, "2025-01-06", quantity=-1.0),
        shipment(2, "2025-01-06", quantity=math.nan, km=0.0),
        shipment(3, "2025-01-06", freight="-2.00"),
        shipment(4, "2025-01-06", origin=None),
    ]
    frame = spark.createDataFrame(rows, SHIPMENTS)
    found = {r["check"]: r["violations"] for r in quality.shipment_checks(frame).collect()}
    assert {c for c, n in found.items() if n} == {
        "quantity_not_positive",
        "missing_quantity_tonnes",
        "distance_not_positive",
        "freight_negative",
        "missing_origin",
    }
    with pytest.raises(ValueError, match="freight_negative=1"):
        quality.enforce(quality.shipment_checks(frame))
    empty = quality.shipment_checks(frame.limit(0))
    with pytest.raises(ValueError, match="empty=1"):
        quality.enforce(empty)
    with pytest.raises(ValueError, match="material"):
        quality.shipment_checks(frame.drop("material"))
