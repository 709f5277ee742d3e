import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from small import documents, hard_rows, words

from costwatch.llm import brown
from costwatch.llm.words import word_slices


def tokens(t):
    return (t or "").encode().lower().split()


def trained(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1


def make():
    """Two languages and a strict order of word kinds: a class model must beat word frequencies."""
    rng, rows = random.Random(11), []
    kinds = [[words(rng, 12) for _ in range(3)] for _ in range(2)]
    for lang in range(2):
        kinds[lang] = [[f"{w}{lang}{k}" for w in kind] for k, kind in enumerate(kinds[lang])]
    for i in range(20, 320):
        lang = rng.randrange(2)
        rows.append((i, " ".join(rng.choice(kinds[lang][k % 3]) for k in range(rng.randint(5, 40))), "en", "a"))
    return rows + [(9_000 + k, f"never seen{k} before", "en", "a") for k in range(6)]


def hash_of(word):
    ((_, _, w),) = list(word_slices(pa.array([word.decode()])))
    return w.hashes()[0]


def test_scores_by_hand(spark):
    rows = make() + hard_rows()
    frame = documents(spark, rows, extra=True)
    out = brown.scored(frame, brown.training()).collect()
    assert len(out) == len(rows)
    counts, texts = Counter(), 0
    for i, t, _, _ in rows:
        if trained(i):
            counts.update(tokens(t))
            texts += 1
    n_all, n_types = sum(counts.values()) + texts, len(counts) + 1
    base = lambda c: math.log10((c + 0.5) / (n_all + 0.5 * (n_types + 1)))
    want = sorted(
        (
            str(i), not trained(i), len(tokens(t)) + 1, sum(counts[w] > 0 for w in tokens(t)) + 1, n_all,
            round(sum(base(counts[w]) for w in tokens(t)) + base(texts), 6),
        )
        for i, t, _, _ in rows
    )
    got = sorted(
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in out
    )
    assert got == want
    held = [r for r in out if r["held_out"] and 20 <= (r["doc_id"] or 0) < 320]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.3 * len(held)

    # The model's own numbers, word by word.
    model, _ = brown.train(frame, brown.training())
    by_id = {r["doc_id"]: r["score"] for r in out}
    for i, t, _, _ in rows[:40] + rows[300:306]:
        score, before = 0.0, 0
        for w in tokens(t):
            of = int(model.classes[int(hash_of(w)) >> 48])
            score += model.transitions[before, of] + float(model.known(np.array([counts[w]]), np.array([of]))[0])
            before = of
        assert math.isclose(by_id[i], score + model.transitions[before, 0], rel_tol=1e-9)

    # Probabilities after any class add up to one: known words and an unknown one for each class.
    of = np.array([int(model.classes[int(hash_of(w)) >> 48]) for w in counts])
    emitted = 10 ** model.known(np.array(list(counts.values())), of)
    per_class = np.bincount(of, weights=emitted, minlength=brown.CLASSES)
    unknown = 10 ** model.known(np.zeros(brown.CLASSES, int), np.arange(brown.CLASSES))
    mass = np.where(model.class_tokens > 0, per_class + unknown, 1)
    mass[0] = 1
    assert np.allclose((10**model.transitions) @ mass, 1)

    # Words outside the dictionary are joined; the result is the same.
    small = brown.scored(frame, brown.training(), dictionary=40).collect()
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6))
    assert sorted(map(key, small)) == sorted(map(key, out))


def test_exchange_finds_the_kinds():
    rng = np.random.default_rng(2)
    kind = np.arange(30) % 3
    bigrams = np.zeros((32, 32))
    before = 30
    for _ in range(6000):
        if before == 30:
            word = int(rng.integers(10)) * 3
        else:
            word = int(rng.integers(10)) * 3 + (kind[before] + 1) % 3
        word = 30 if before != 30 and rng.random() < 0.05 else word
        bigrams[before, word] += 1
        before = word
    found = brown.exchange(bigrams, 30, 4)
    assert len({(a, b) for a, b in zip(kind, found)}) == 3


def test_gains_are_differences_of_the_likelihood():
    rng = np.random.default_rng(5)
    f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    total = lambda g: f(g) - f(g.sum(0)) - f(g.sum(1))
    grid = rng.integers(0, 50, (5, 5)).astype(float)
    right, left, own = rng.integers(0, 9, 5).astype(float), rng.integers(0, 9, 5).astype(float), 2.0
    gains = brown.class_gains(grid, right, left, own)
    totals = []
    for b in range(5):
        moved = grid.copy()
        moved[b] += right
        moved[:, b] += left
        moved[b, b] += own
        totals.append(total(moved))
    assert np.allclose(gains - gains[0], np.array(totals) - totals[0])


def test_without_training_rows(spark):
    frame = documents(spark, hard_rows()[:2])
    out = brown.scored(frame, brown.F.lit(False)).collect()
    assert {r["train_tokens"] for r in out} == {0} and {r["n_known"] for r in out} == {0}
    assert {r["base_score"] for r in out} == {0.0}
    assert brown.scored(documents(spark, []), brown.training()).count() == 0


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Workers that start in another folder, without a path to the package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from costwatch.llm import brown
rows = [(i, "some words of text " + str(i % 3)) for i in range(40)]
out = brown.scored(spark.createDataFrame(rows, "doc_id long, text string"), brown.training()).collect()
assert len(out) == 40, out
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-2000:]
