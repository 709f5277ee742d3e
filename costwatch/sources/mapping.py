"""Benchmark tables as inputs: shipments, notes, labelled cases, usage and retrieval inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costwatch.functions.measures import monday
from costwatch.functions.text import word_count
from costwatch.staging import spread

# Note sentences per class `doc_id % 10`. Classes 0, 1, 2 and 9 are valid
# evidence, 3 and 4 negative, 5 and 6 say nothing on costs, 7 and 8 both.
NOTE_SENTENCES = [
    "Carriers added a surcharge on this lane after a port strike.",
    "Fuel prices on the corridor have increased again this week.",
    "Diversions led to higher trip costs for most trucks.",
    "Roadworks caused short queues; costs were not affected.",
    "Market report: stable demand and no major disruption.",
    "A bridge reopened and traffic flows as usual.",
    "Deep snow closed two depots for a day.",
    "Hauliers discussed a surcharge but agreed on no surcharge for now.",
    "Toll increase announced, absorbed without a rate change.",
    "Rates increased due to high demand at the terminals.",
]


# Column types of the benchmark tables. Stating them spares every query a job
# that reads file footers to find them out.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
    "events": "ts timestamp_ntz, user_id bigint, value double",
    "documents": "doc_id bigint, text string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def _places(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """Nation with its region. Both tables have a fixed number of rows at every scale."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(
        F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"]
    ).select(
        F.col("n_nationkey").alias(f"{prefix}_nation"),
        F.col("r_regionkey").alias(f"{prefix}_region"),
        F.col("r_name").alias(f"{prefix}_name"),
    )


def shipments(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Line items as shipments from the supplier's to the customer's region.

    The customer chain is joined to orders before the line items, so the largest table is
    shuffled once for orders and, unless suppliers fit a broadcast, once for suppliers.
    """
    line = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    orders = table(spark, sf_dir, "orders")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    to_places, from_places = _places(spark, sf_dir, "to"), _places(spark, sf_dir, "from")
    destinations = customer.join(
        F.broadcast(to_places), F.col("c_nationkey") == F.col("to_nation")
    ).drop("c_nationkey")
    origins = supplier.join(
        F.broadcast(from_places), F.col("s_nationkey") == F.col("from_nation")
    ).drop("s_nationkey")
    ordered = orders.join(destinations, orders["o_custkey"] == destinations["c_custkey"])
    gap = F.abs(F.col("from_region") - F.col("to_region"))
    return (
        # Compressed file sizes make the line items look small enough to broadcast.
        line.join(ordered.hint("merge"), line["l_orderkey"] == ordered["o_orderkey"])
        .join(origins, line["l_suppkey"] == origins["s_suppkey"])
        .select(
            F.concat_ws(
                "-",
                *["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                F.date_format("l_shipdate", "yyyyMMdd"),
                F.round(F.col("l_extendedprice") * 100).cast("bigint"),
            ).alias("shipment_id"),
            F.col("from_name").alias("origin"),
            F.col("to_name").alias("destination"),
            F.when(gap == 0, "Short").when(gap <= 2, "Medium").otherwise("Long").alias("route_type"),
            F.col("l_returnflag").alias("material"),
            F.col("l_quantity").alias("quantity_tonnes"),
            (100.0 + 50.0 * F.abs(F.col("from_nation") - F.col("to_nation"))).alias("distance_km"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("freight_cost_inr"),
            F.col("l_shipdate").cast("date").alias("shipment_date"),
            F.col("s_name").alias("transporter"),
            *keep,
        )
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, whole, as a dated note for one route or (each 26th) for all routes."""
    docs, region = documents(spark, sf_dir), table(spark, sf_dir, "region")
    start = region.select(F.col("r_regionkey").alias("_a"), F.col("r_name").alias("_from"))
    end = region.select(F.col("r_regionkey").alias("_b"), F.col("r_name").alias("_to"))
    slot = F.pmod("doc_id", F.lit(26))
    sentences = F.array(*[F.lit(s) for s in NOTE_SENTENCES])
    return (
        docs.withColumn("_slot", slot)
        .join(F.broadcast(start), F.floor(F.col("_slot") / 5) == F.col("_a"), "left")
        .join(F.broadcast(end), F.col("_slot") % 5 == F.col("_b"), "left")
        .select(
            F.concat(
                F.lit("D"),
                F.when(F.col("doc_id") > 999999, F.col("doc_id").cast("string")).otherwise(
                    F.lpad(F.col("doc_id").cast("string"), 6, "0")
                ),
            ).alias("note_id"),
            F.date_add(
                F.lit("1995-01-02").cast("date"), (F.col("doc_id") * 7919 % 2490).cast("int")
            ).alias("date"),
            F.when(F.col("_slot") == 25, "All Routes")
            .otherwise(F.concat("_from", F.lit("-"), "_to"))
            .alias("applies_to"),
            F.concat_ws(
                " ", sentences[F.pmod("doc_id", F.lit(10)).cast("int")], F.col("text")
            ).alias("note"),
        )
    )


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One case per note; the expectation follows the note's text class only."""
    source = notes(spark, sf_dir).withColumn("k", F.substring("note_id", 2, 18).cast("bigint"))
    names = table(spark, sf_dir, "region").agg(
        F.concat(F.min("r_name"), F.lit("-"), F.max("r_name")).alias("route")
    )
    k, valid = F.col("k"), (F.col("k") % 10).isin(0, 1, 2, 9)
    other_route = (k % 3 == 0) | (F.col("applies_to") == "All Routes")
    return source.select(
        F.concat(F.lit("E"), "note_id").alias("case_id"),
        F.when(other_route, names.scalar()).otherwise(F.col("applies_to")).alias("route"),
        F.date_add(monday(F.col("date")), (7 * (k % 4 - 1)).cast("int")).alias("week_of"),
        F.when(k % 11 == 0, None).when(k % 13 == 0, "missing").otherwise(F.col("note_id")).alias("note_id"),
        valid.alias("expected_valid"),
        F.when(valid, "justified").otherwise("unexplained").alias("expected_verdict"),
        F.lit("derived").alias("description"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as usage records: words in, words out, one model per conversation."""
    words = word_count(F.col("text"))
    return (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id")
        .agg(
            F.coalesce(F.sum(F.when(F.col("role") != "assistant", words)), F.lit(0)).alias(
                "input_tokens"
            ),
            F.coalesce(F.sum(F.when(F.col("role") == "assistant", words)), F.lit(0)).alias(
                "output_tokens"
            ),
        )
        .withColumn("model", F.concat(F.lit("m"), (F.col("conv_id") % 3).cast("string")))
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).withColumnRenamed("doc_id", "document_id")


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def vectors(spark: SparkSession, sf_dir: str, id_name: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias(id_name), "embedding")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "conversations")
        .filter("role = 'user'")
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")
    )


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second domain for the time-series operators: value per event, user groups, days."""
    group = F.col("user_id") % 20
    return table(spark, sf_dir, "events").select(
        group.cast("string").alias("route"),
        (group % 4).cast("string").alias("route_type"),
        F.col("ts").cast("date").alias("week_of"),
        F.lit(1.0).alias("quantity_tonnes"),
        F.lit(1.0).alias("distance_km"),
        F.col("value").cast("decimal(18,6)").alias("freight_cost_inr"),
    )
