"""Terms cut, counted and hashed in numpy, against plain Python; and that no row is made for each term."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from costwatch.functions import terms, text
from costwatch.operators import dense, lexical


@pytest.mark.parametrize("limit", [1, 5, 1 << 23])
def test_counts_and_cells(monkeypatch, limit):
    monkeypatch.setattr(terms, "SLICE_BYTES", limit)
    monkeypatch.setattr(terms, "SLICE_CELLS", limit)
    chance = random.Random(1)
    texts = ["".join(chance.choices("ab1- é١-", k=chance.randint(0, 9))) for _ in range(400)]
    texts += ["", "-a", "a-", "-", "b", "a--b-c"]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["document_id", "content"])
    counted = pa.Table.from_batches(list(terms.count_terms(terms.token_slices(batch)))).combine_chunks()
    rows = counted.to_pylist()
    assert [r["document_id"] for r in rows] == list(range(len(texts)))
    for t, r in zip(texts, rows):
        want = Counter(re.findall(text.LEXICAL_TOKEN, t))
        assert [(p["term"], p["tf"]) for p in r["counts"]] == sorted(want.items())
        assert (r["length"], r["n_terms"]) == (sum(want.values()), len(want))
    lists = counted.select(["document_id", "counts"]).to_batches()[0]
    cells = [c for _, part in terms.hashed_cells(terms.list_slices(lists), 8) for c in part.to_pylist()]
    for r, got in zip(rows, cells, strict=True):
        want = np.zeros(8, int)
        for p in r["counts"]:
            digest = hashlib.md5(p["term"].encode()).hexdigest()
            want[int(digest[:8], 16) % 8] += (1 - 2 * (int(digest[8], 16) % 2)) * p["tf"]
        assert got == want.tolist()


def test_no_row_for_each_term(spark):
    docs = spark.createDataFrame([(1, "A-b a a"), (None, None), (1, "c")], "document_id bigint, text string")
    index = lexical.lexical_index(docs)
    held = {(r["document_id"], r["length"]): [tuple(c) for c in r["counts"]] for r in index.counted.collect()}
    assert held == {(1, 3): [("a", 2), ("a-b", 1)], (None, 0): [], (1, 1): [("c", 1)]}
    encoded = dense.encode_counted(index.counted)
    assert "Generate" not in encoded._jdf.queryExecution().toString()
    rows = {r["document_id"]: np.array(r["embedding"]) for r in encoded.collect()}
    assert set(rows) == {1, None} and not rows[None].any() and np.linalg.norm(rows[1]) == pytest.approx(1)


def test_blanks(spark):
    chance = random.Random(2)
    rows = [("".join(chance.choices(text.WHITESPACE + " " * 9 + "aB", k=9)),) for _ in range(300)]
    got = spark.createDataFrame(rows, "t string").select("t", text.normalize_text(F.col("t")).alias("n"))
    for r in got.collect():
        assert r["n"] == re.sub(f"[{text.WHITESPACE}]+", " ", r["t"].lower()).strip(" ")
