"""Queries of the dealt operators: whole tables in, whole results out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from costwatch.llm import brown, chat, decontaminate, html, mixing, neardup, quality, repair, rules, search, sharding, tokens, warc

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op2_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), n_shards=40)


@query
def op10_mixing(spark, sf_dir):
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark, sf_dir):
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_rules(spark, sf_dir):
    return rules.rule_digest(table(spark, sf_dir, "documents"))


@query
def op8_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), n=2)


@query
def op3_decontaminate(spark, sf_dir):
    return decontaminate.leak_digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op7_tokens(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.read_pieces(VOCABULARY))


@query
def op9_chat(spark, sf_dir):
    return chat.chat_turns(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op9_chat"] = chat.CHAT_SQL


@query
def op4_brown(spark, sf_dir):
    return brown.scored(table(spark, sf_dir, "documents"), brown.training())


@query
def op11_repair(spark, sf_dir):
    return repair.repair_digest(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op11_repair"] = repair.REPAIR_SQL


@query
def op12_search(spark, sf_dir):
    return search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_search"] = search.SEARCH_SQL


@query
def op13_warc(spark, sf_dir):
    return warc.archive_digest(table(spark, sf_dir, "pages"))


ORACLE_SQL["op13_warc"] = warc.WARC_SQL


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
