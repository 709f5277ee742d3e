import os
import random

import numpy as np
import pytest
from small import documents, hard_rows, text

from costwatch.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def isotonic_by_hand(counts, positives):
    """Min-max formula of the monotone least-squares fit."""
    at = [k for k in range(len(counts)) if counts[k]]
    rate = lambda a, b: sum(positives[k] for k in at[a:b]) / sum(counts[k] for k in at[a:b])
    return [max(min(rate(a, b) for b in range(k + 1, len(at) + 1)) for a in range(k + 1)) for k in range(len(at))]


def test_isotonic():
    rng = np.random.default_rng(0)
    for _ in range(50):
        counts = rng.integers(0, 4, 12).astype(float)
        positives = np.array([rng.integers(0, c + 1) for c in counts]).astype(float)
        places, rates = quality.isotonic(counts, positives)
        assert (np.diff(rates) > 0).all() and (np.diff(places) > 0).all()
        want = isotonic_by_hand(counts, positives)
        assert sorted(set(np.round(want, 9))) == sorted(set(np.round(rates, 9)))


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    waves = rng.normal(size=(d, 4000)) / np.sqrt(d)
    model = quality.Model(np.zeros(d), np.ones(d), waves, rng.uniform(0, 2 * np.pi, 4000), None, None, None)
    x = rng.normal(size=(6, d))
    z = model.cosines(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * d))
    assert np.abs(z @ z.T - want).max() < 0.08


def make():
    rng, rows, labels = random.Random(5), [], []
    for i in range(400):
        good = i % 3 != 0
        body = text(rng, rng.randint(20, 80))
        rows.append((i, body if good else body.replace(" ", "### ").upper(), rng.choice(["en", "de"]), "a"))
        if i % 2:
            labels.append((i, int(good), 0))
    return rows, labels + [(2, None, 0), (None, 1, 0), (99_999, 1, 0)]


def test_learns_and_holds_out(spark):
    rows, labels = make()
    frame = documents(spark, rows + hard_rows(), extra=True)
    out = quality.quality_digest(frame, spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(rows) + len(hard_rows())
    truth = {i: int(i % 3 != 0) for i in range(10, 400)}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 40
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    flipped = [(i, 1 - q if q is not None and i is not None and i % 5 == 9 else q, t) for i, q, t in labels]
    assert flipped  # held-out labels do not matter:
    held_ids = {r["doc_id"] for r in out if r["held_out"]}
    other = [(i, 1 - q if i in held_ids and q is not None else q, t) for i, q, t in labels]
    again = quality.quality_digest(frame, spark.createDataFrame(other, LABELS)).collect()
    key = lambda r: (str(r["doc_id"]), round(r["score"], 9))
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], LABELS)
    frame = documents(spark, hard_rows())
    assert {r["score"] for r in quality.quality_digest(frame, none).collect()} == {0.5}
    assert quality.quality_digest(documents(spark, []), none).count() == 0


def test_scores_as_a_column(spark):
    rows, labels = make()
    frame = documents(spark, rows + hard_rows())
    table = spark.createDataFrame(labels, LABELS)
    model, _ = quality.train_on(frame, table)
    direct = [r[0] for r in frame.select(quality.text_scores(frame["text"], model)).collect()]
    by_table = [r["score"] for r in quality.quality_digest(frame, table).collect()]
    assert np.allclose(sorted(direct), sorted(by_table))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_held_out_accuracy_on_the_given_table(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    out = quality.quality_digest(read("documents"), read("labels")).filter("held_out")
    rows = out.join(read("labels"), "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
