"""The pipeline's stages against brute force on a small corpus with planted cases."""

import random
from collections import Counter

import pytest
from small import documents, hard_rows, text, words

import corpus_pipeline
from costwatch.llm import sharding


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    items = [(k, text(rng, 30)) for k in range(6)]
    rows, kinds = [], {}

    def add(body, kind):
        rows.append((100 + len(rows), body, rng.choice(["en", "de"]), rng.choice("aaab")))
        kinds[rows[-1][0]] = kind

    for _ in range(150):
        add(text(rng, rng.randint(60, 90)), "clean")
    for _ in range(60):
        add(text(rng, rng.randint(30, 70)).replace(" ", "### ").upper(), "junk")
    for row in rows[:10]:
        add(row[1], "copy")
        body = row[1].split()
        body[3] = "changed"
        add(" ".join([*body, *body[:1]]), "copy")
    for k, item in items:
        body = words(rng, 40)
        body[20:20] = item.split()
        add(" ".join(body), "leak")
    labels = [(i, int(kind != "junk"), 0) for i, kind in kinds.items() if i % 2]
    folder = str(tmp_path_factory.mktemp("corpus"))
    write = lambda frame, name: frame.write.parquet(f"{folder}/{name}.parquet")
    write(documents(spark, rows), "documents")
    write(spark.createDataFrame(items, "item_id long, text string"), "benchmark")
    write(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "labels")
    return folder, rows, kinds


def test_decisions(spark, corpus):
    folder, rows, kinds = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder).cache()
        if name != "shard":
            assert out.columns == docs.columns
        seen[name] = out.collect()
        docs = out
    ids = lambda name: Counter(r["doc_id"] for r in seen[name])
    alive = {i for i, kind in kinds.items() if kind != "junk"}
    assert len(alive - set(ids("quality"))) <= 2 and len(set(ids("quality")) - alive) <= 2
    want = {i for i in ids("quality") if kinds[i] != "copy"}
    assert set(ids("neardup")) == want and max(ids("neardup").values()) == 1
    want = {i for i in want if kinds[i] != "leak"}
    assert set(ids("decontaminate")) == want
    assert set(ids("mix")) <= want
    whole = {i: len(t.split()) for i, t, _, _ in rows}
    taken, size = Counter(), sum(whole[i] for i in want)
    for r in seen["mix"]:
        taken[r["doc_id"]] += len(r["text"].split())
    assert all(n <= 3 * whole[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - size) <= 2
    assert ids("shard") == ids("mix")
    shards = [(n, 1.0) for n in range(corpus_pipeline.SHARDS)]
    keys = spark.createDataFrame([(i,) for i in ids("mix")], "doc_id long")
    home = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(keys, "doc_id", shards).collect()}
    assert all(r["shard"] == home[r["doc_id"]] for r in seen["shard"])


def test_run_with_hard_and_extra_columns(spark, corpus, tmp_path):
    folder, _, _ = corpus
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    documents(spark, hard_rows(), extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= {i for i, *_ in hard_rows()}
    assert out


def test_empty(spark, corpus, tmp_path):
    folder, _, _ = corpus
    for name in ("benchmark", "labels", "documents"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
