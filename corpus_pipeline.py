"""A corpus from the table `documents`: five stages, each written as Parquet and read again.

1. quality: documents that the classifier rejects go.
2. neardup: one document of each group of near-duplicates stays (five-word shingles, 80 %).
3. decontaminate: documents that hold a part of a benchmark item go.
4. mix: words of each source up to its target, as documents; a row for each use of a document.
5. shard: the shard of each row, from its doc_id alone.

All stages but the last return the columns of `documents`. Null texts count as empty ones: they
are scored, are near-duplicates of nothing, hold no benchmark item, and have no words for the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costwatch.llm import decontaminate, mixing, neardup, quality, sharding
from costwatch.staging import stage

SHARDS = 40
SHINGLE_WORDS = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least the cut; labels of other documents are unused."""
    model, _ = quality.train_on(docs, _table(spark, sf_dir, "labels"))
    return docs.filter(quality.text_scores(docs["text"], model) >= quality.CUT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; equal rows leave one."""
    return neardup.drop_duplicates(docs, SHINGLE_WORDS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with an item of `benchmark`."""
    return decontaminate.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources; a document used more than once has a row for each use."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with the columns `shard` and `slot`, its place in the shard."""
    sharded = sharding.assign_shards(docs, "doc_id", [(n, 1.0) for n in range(SHARDS)])
    return sharding.number_slots(sharded, "doc_id", ["source", "n_chars", "text"])


STAGES = [
    ("quality", filter_quality),
    ("neardup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("mix", mix_sources),
    ("shard", shard),
]

#: A fitted classifier and hashes decide, which SQL cannot express; tests/llm compares the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written and read back by the next one."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
