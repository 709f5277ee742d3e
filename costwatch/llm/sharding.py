"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number from the key; the shard with the least `-ln(u) / weight` gets the
record. A shard that is added takes records only into itself, one that is removed gives only
its own away, and a changed weight moves records only into or out of that shard. The law is
`key`: nothing but the key and the list of shards decides.

Null keys are a key like any other. Rows with equal keys share a shard. An empty table gives
an empty one. Columns of the caller keep their names; the new ones replace columns of the same
name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_BUCKETS = 1024  # parts of a shard that are numbered on their own


def rendezvous(key: Column, shards: Sequence[tuple[int, float]]) -> Column:
    """Number of the shard that wins `key`; shards are (number, weight) with weight > 0."""
    if not shards or any(weight <= 0 for _, weight in shards):
        raise ValueError("shards need positive weights")
    table = F.array(
        *[
            F.struct(F.lit(int(n)).alias("shard"), F.lit(float(w)).alias("weight"))
            for n, w in shards
        ]
    )

    def draw(shard: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, shard["shard"]), 11)
        unit = (bits.cast("double") + 0.5) * 2.0**-53
        return F.struct((-F.log(unit) / shard["weight"]).alias("draw"), shard["shard"])

    return F.array_min(F.transform(table, draw))["shard"]


def assign_shards(
    records: DataFrame, key: str, shards: Sequence[tuple[int, float]], name: str = "shard"
) -> DataFrame:
    """`records` with the column `name`: a projection, without a shuffle."""
    return records.withColumn(name, rendezvous(F.col(key), shards))


def number_slots(
    sharded: DataFrame, key: str, order: Sequence[str], buckets: int = SLOT_BUCKETS
) -> DataFrame:
    """`sharded` with `slot`: gapless from 0 within each value of `shard`.

    A shard is cut into buckets by a hash of `key` and `order`; rows are numbered within a bucket
    and start at the number of rows in the buckets before it, so no task sorts a whole shard, and
    rows without a key, or with one that is repeated, are dealt over all buckets of theirs.
    `order` breaks ties of the key; rows equal in all of them share a bucket, where they are
    interchangeable.
    """
    # The row travels as one column, so no name of the caller can meet these.
    parts = sharded.select(
        F.col("shard").alias("_shard"),
        F.pmod(F.xxhash64(key, *order, F.lit("slot")), F.lit(buckets)).cast("int").alias("_bucket"),
        F.struct("*").alias("_of"),
    )
    before = Window.partitionBy("_shard").orderBy("_bucket")
    begins = (
        parts.groupBy("_shard", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_shard", "_bucket", (F.sum("_n").over(before) - F.col("_n")).alias("_begin"))
    )
    by = [F.col("_of").getField(name) for name in (key, *order)]
    within = Window.partitionBy("_shard", "_bucket").orderBy(*by)
    kept = [F.col("_of").getField(c).alias(c) for c in sharded.columns if c != "slot"]
    return (
        parts.withColumn("_row", F.row_number().over(within))
        .join(begins, ["_shard", "_bucket"])
        .select(*kept, (F.col("_begin") + F.col("_row") - 1).alias("slot"))
    )


def shard_documents(documents: DataFrame, n_shards: int, key: str = "doc_id") -> DataFrame:
    """Digest of documents in `n_shards` equal shards, and where one more would put them.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard. A null text has no bytes.
    """
    text = F.coalesce("text", F.lit(""))
    equal = [(n, 1.0) for n in range(n_shards)]
    narrow = documents.select(
        F.col(key),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), equal).alias("shard"),
        rendezvous(F.col(key), [*equal, (n_shards, 1.0)]).alias("grown_shard"),
    )
    return number_slots(narrow, key, ["text_crc32", "size"])
