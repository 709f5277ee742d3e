"""Catalogue queries against their check SQL at the smallest scale.

By default a part of the queries runs; COSTWATCH_ALL=1 runs all of them.
"""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from costwatch.plans import oracle
from costwatch.plans.queries import QUERIES

SF_DIR = os.environ.get("COSTWATCH_SF_DIR", "/root/testdata/sf0.001")
PART = [
    "shipments_prepared",
    "shipment_checks",
    "weekly_metrics",
    "weekly_checks",
    "anomalies",
    "event_daily_anomalies",
    "evidence_flags",
    "results_shaped",
    "label_eval",
    "bm25_topk",
    "tfidf_topk",
    "encode_hash",
    "dense_topk",
    "rerank_topk",
    "retrieval_recall",
    "usage_cost",
    "roundtrip_json",
    "roundtrip_csv",
    "roundtrip_reasons",
    "roundtrip_indented",
    "qa_prompts",
    "bm25_padded",
    "contained_words",
    "hybrid_topk",
]
NAMES = sorted(QUERIES) if os.environ.get("COSTWATCH_ALL") else PART

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert compare(frame, connection, contract.oracle_sql()[name]) == ""
