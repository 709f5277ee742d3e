"""Mixing sources to target weights by blocks of a fixed number of words.

The words of a source's documents form one sequence, cut into blocks of `block_words`. Each
source has a target number of words; its slots (uses of a block) are dealt to output shards by
a multinomial draw, so that a shard's composition given its length is multinomial with the
weights of the mix. Slot j of a source is position `j mod blocks` of epoch `j div blocks`; a
pseudorandom permutation of the block numbers, another one for each source and epoch, maps the
position to a block, and a join on (source, block) brings in the words. The last slot of a
source is cut so that its words add up to the target, rounded.

Offsets of documents in their source are sums over buckets of documents, then running sums in a
bucket, so that a source with a third of all rows is numbered in many tasks.

Null texts and texts without words have size 0 and are taken 0 times. A null source is a source
of its own. Rows equal in doc_id, source and text are interchangeable. An empty table gives an
empty result. Other columns of the input are ignored by the digest and kept by `mix_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costwatch.functions.text import let
from costwatch.llm.words import SPARK_WORD, mix
from costwatch.staging import stage

BLOCK_WORDS = 256
MOST_REPEATS = 3
WEIGHT_CYCLE = 3
OUTPUT_SHARDS = 64
PACK_BUCKETS = 1024
CHUNK_SLOTS = 1 << 16


def measured(documents: DataFrame) -> DataFrame:
    """Narrow rows: doc_id, source, size in words, and a hash that tells texts apart."""
    return documents.select(
        "doc_id",
        "source",
        F.xxhash64("doc_id", "text").alias("_uid"),
        F.coalesce(F.regexp_count("text", F.lit(SPARK_WORD)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(narrow: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_ix, source_size, target: words of each source in the mix.

    Sources by code point, null last, weigh 1, 2, 3, repeating. A target is
    `min(most * size, level * weight)`; the level makes them add up to all words, which is where
    passing on what exceeds a limit ends. Sources sorted by the level at which they are full
    give it in one pass.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("_full", "source_ix")
    done = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    return (
        narrow.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_ix", F.row_number().over(everything).cast("long") - 1)
        .withColumn("_weight", F.col("source_ix") % WEIGHT_CYCLE + 1)
        .withColumn("_cap", F.col("source_size") * most)
        .withColumn("_full", F.col("_cap") / F.col("_weight"))
        .withColumn("_left", F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(done), F.lit(0)))
        .withColumn("_level", F.col("_left") / F.sum("_weight").over(ahead))
        .withColumn("_fits", F.when(F.col("_level") <= F.col("_full"), F.struct("_full", "source_ix", "_level")))
        .withColumn("_at", F.coalesce(F.min("_fits").over(whole)["_level"], F.max("_full").over(whole)))
        .select(
            "source",
            "source_ix",
            "source_size",
            F.least(F.col("_cap").cast("double"), F.col("_at") * F.col("_weight")).alias("target"),
        )
    )


def packed(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """`narrow` with source_ix, source_size, target and `_start`, its first word's place."""
    keyed = narrow.join(
        targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    keyed = keyed.withColumn("_bucket", F.pmod("_uid", F.lit(PACK_BUCKETS)).cast("int"))
    before = Window.partitionBy("source_ix").orderBy("_bucket")
    begins = (
        keyed.groupBy("source_ix", "_bucket")
        .agg(F.sum("size").alias("_n"))
        .select("source_ix", "_bucket", (F.sum("_n").over(before) - F.col("_n")).alias("_begin"))
    )
    within = Window.partitionBy("source_ix", "_bucket").orderBy("_uid", "doc_id", "size")
    running = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        keyed.withColumn("_start", running - F.col("size"))
        .join(begins, ["source_ix", "_bucket"])
        .withColumn("_start", F.col("_start") + F.col("_begin"))
        .drop("_bucket", "_begin")
    )


def permute(index: np.ndarray, size: np.ndarray, seed: np.ndarray, back: bool = False) -> np.ndarray:
    """Pseudorandom permutation of 0 .. size - 1, or its inverse, value by value.

    A Feistel network over the least even number of bits that hold `size`; values that leave
    the range are mapped again until they are back in it.
    """
    size, seed = size.astype(np.uint64), seed.astype(np.uint64)
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.uint64) + 1) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        h, m, s = half[todo], low[todo], seed[todo]
        left, right = out[todo] >> h, out[todo] & m
        for turn in (3, 2, 1, 0) if back else (0, 1, 2, 3):
            if back:
                left, right = right ^ (mix(mix(s + np.uint64(turn)) ^ left) & m), left
            else:
                left, right = right, left ^ (mix(mix(s + np.uint64(turn)) ^ right) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def _seeds(source_ix: np.ndarray, epoch: np.ndarray, seed: int) -> np.ndarray:
    place = source_ix.astype(np.uint64) * np.uint64(1 << 20) + epoch.astype(np.uint64)
    return mix(mix(place) + np.uint64(seed))


def slot_plan(
    targets: DataFrame, block_words: int = BLOCK_WORDS, shards: int = OUTPUT_SHARDS, seed: int = 0
) -> DataFrame:
    """Slots of the mix: source_ix, shard, slot, epoch, block, limit (words used of the block)."""

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                size, want = int(row.source_size), int(np.floor(row.target + 0.5))
                if size == 0 or want == 0:
                    continue
                blocks = -(-size // block_words)
                tail = size - (blocks - 1) * block_words
                epochs, rest = divmod(want, size)
                ix, last = np.array([row.source_ix]), np.array([epochs])
                at = int(permute(np.array([blocks - 1]), np.array([blocks]), _seeds(ix, last, seed), True)[0])
                short = block_words - tail
                if rest <= at * block_words:
                    used = -(-rest // block_words)
                elif rest <= at * block_words + tail:
                    used = at + 1
                else:
                    used = -(-(rest + short) // block_words)
                total = epochs * blocks + used
                before = (used - 1) * block_words - (short if used - 1 > at else 0)
                cut = rest - before if used else 0
                rng = np.random.default_rng([seed, int(row.source_ix)])
                counts = rng.multinomial(total, np.full(shards, 1 / shards))
                firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
                yield pd.DataFrame(
                    {
                        "source_ix": row.source_ix, "shard": np.arange(shards), "first": firsts,
                        "n": counts, "blocks": blocks, "cut_slot": total - 1 if used else -1, "cut": cut,
                    }
                )

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            epoch, position = np.divmod(f["slot"].to_numpy(), f["blocks"].to_numpy())
            ix = f["source_ix"].to_numpy()
            block = permute(position, f["blocks"].to_numpy(), _seeds(ix, epoch, seed))
            limit = np.where(f["slot"] == f["cut_slot"], f["cut"], block_words)
            yield pd.DataFrame(
                {"source_ix": ix, "shard": f["shard"], "slot": f["slot"], "epoch": epoch, "block": block, "limit": limit}
            )

    schema = "source_ix long, shard long, first long, n long, blocks long, cut_slot long, cut long"
    dealt = targets.select("source_ix", "source_size", "target").mapInPandas(draw, schema)
    end = F.col("first") + F.col("n")
    slots = (
        dealt.filter("n > 0")
        .withColumn("_from", F.explode(F.sequence("first", end - 1, F.lit(CHUNK_SLOTS))))
        .withColumn("_to", F.least(F.col("_from") + CHUNK_SLOTS, end))
        .repartition("source_ix", "_from")
        .withColumn("slot", F.explode(F.sequence("_from", F.col("_to") - 1)))
        .select("source_ix", "shard", "slot", "blocks", "cut_slot", "cut")
    )
    return slots.mapInPandas(
        place, "source_ix long, shard long, slot long, epoch long, block long, limit long"
    )


def mix_pieces(
    placed: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Parts of documents that the mix uses: one row per document, slot and epoch.

    `_low`, `_high`: words of the document, from 0, upper bound excluded.
    """
    ends = F.col("_start") + F.col("size")
    parts = placed.filter("size > 0").withColumn(
        "block",
        F.explode(F.sequence(F.floor(F.col("_start") / block_words), F.floor((ends - 1) / block_words))),
    )
    begin = F.col("block") * block_words
    return (
        parts.join(slots.hint("merge"), ["source_ix", "block"])  # grows with the mix: no broadcast
        .withColumn("_low", F.greatest(begin, F.col("_start")) - F.col("_start"))
        .withColumn("_high", F.least(begin + F.col("limit"), ends) - F.col("_start"))
        .filter(F.col("_high") > F.col("_low"))
    )


def plan_mix(
    documents: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Placed documents and the pieces of them that make up the mix."""
    narrow = stage(measured(documents), "mix_sizes")
    targets = stage(source_targets(narrow), "mix_targets")
    placed = stage(packed(narrow, targets), "mix_placed")
    return placed, mix_pieces(placed, slot_plan(targets, block_words, seed=seed), block_words)


def mix_digest(documents: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken and uses: the words of each document in the mix.

    `uses` lists slot, output shard and words of each use by slot (empty if there is none); a
    document has no more of them than its blocks times `MOST_REPEATS`. `taken` is their sum.
    """
    placed, pieces = plan_mix(documents, block_words, seed)
    columns = ["source_ix", "_start", "_uid", "doc_id", "size", "source_size", "target"]
    words = (F.col("_high") - F.col("_low")).cast("long").alias("words")
    use = F.struct("slot", "shard", words)
    unused = placed.select(*columns, F.lit(None).cast("struct<slot: long, shard: long, words: long>").alias("use"))
    return (
        pieces.select(*columns, use.alias("use"))
        .unionByName(unused.filter("size > 0"))
        .groupBy(*columns)
        .agg(F.array_sort(F.collect_list("use")).alias("uses"))
        .unionByName(unused.filter("size = 0").select(*columns, F.slice(F.array("use"), 1, 0).alias("uses")))
        .withColumn("taken", F.aggregate("uses", F.lit(0).cast("long"), lambda n, u: n + u["words"]))
        .select("doc_id", "size", "source_size", "target", "taken", "uses")
    )


def mix_documents(documents: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """The mix as documents: a row for each document and epoch in which words of it are used.

    A document used whole keeps its text; else the used words are joined by blanks and n_chars,
    if there, is counted anew. Other columns are kept.
    """
    _, pieces = plan_mix(documents, block_words, seed)
    uses = (
        pieces.groupBy("source_ix", F.col("source").alias("_source"), "_start", "_uid", "size", "epoch")
        .agg(F.array_sort(F.collect_list(F.struct("_low", "_high"))).alias("_ranges"))
        .drop("source_ix", "_start", "epoch")
    )
    used = F.aggregate("_ranges", F.lit(0).cast("long"), lambda n, r: n + r["_high"] - r["_low"])
    words = F.regexp_extract_all("text", F.lit(SPARK_WORD), F.lit(0))

    def cut_from(words: Column) -> Column:
        count = lambda r: (r["_high"] - r["_low"]).cast("int")
        parts = F.transform("_ranges", lambda r: F.slice(words, (r["_low"] + 1).cast("int"), count(r)))
        return F.array_join(F.flatten(parts), " ")

    part = let(words, cut_from)  # the words of a text are found once, not for each range
    # The row travels as one column, so no name of the caller can meet one of these. One id and
    # text may occur in several sources: each use takes a row of its own source.
    texts = documents.select(
        F.xxhash64("doc_id", "text").alias("_uid"), F.col("source").alias("_of_source"), F.struct("*").alias("_of"), "text"
    )
    same = (F.col("_uid") == F.col("_used")) & F.col("_source").eqNullSafe(F.col("_of_source"))
    mixed = texts.dropDuplicates(["_uid", "_of_source"]).join(uses.withColumnRenamed("_uid", "_used"), same)
    text = F.when(used == F.col("size"), F.col("text")).otherwise(part)
    mixed = mixed.select("_of", text.alias("_new"))
    columns = {name: F.col("_of").getField(name) for name in documents.columns}
    columns["text"] = F.col("_new")
    if "n_chars" in columns:
        columns["n_chars"] = F.length("_new").cast(documents.schema["n_chars"].dataType)
    return mixed.select(*[column.alias(name) for name, column in columns.items()])
