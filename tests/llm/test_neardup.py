import math
import random

import numpy as np
import pytest
from small import documents, hard_rows, words

from costwatch.llm import neardup


def shingles(t, n):
    w = (t or "").encode().lower().split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components_by_hand(rows, n):
    sets = [shingles(t, n) for _, t, _, _ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((str(doc), len(sets[i]), least, doc == least))
    return sorted(out, key=str)


def edited(rng, body, share):
    return [w if rng.random() > share else "new" + str(rng.randrange(999)) for w in body]


def make(seed, groups=12, most=9):
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        body = words(rng, rng.randint(3, 70))
        for _ in range(rng.randint(1, most)):
            rows.append(edited(rng, body, rng.choice([0, 0.02, 0.05, 0.1])))
            body = rng.choice([body, rows[-1]])  # chains as well as stars
    rng.shuffle(rows)
    return [(10 + k, " ".join(b), "en", "a") for k, b in enumerate(rows)]


@pytest.mark.parametrize(("seed", "n"), [(1, 2), (2, 5)])
def test_components_by_hand(spark, seed, n):
    rows = make(seed) + (hard_rows() if n == 2 else [])
    out = neardup.near_duplicates(documents(spark, rows, extra=True), n).collect()
    found = sorted(
        ((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in out), key=str
    )
    assert found == components_by_hand(rows, n)


def test_one_large_group_of_chained_copies(spark):
    rng = random.Random(9)
    body, rows = words(rng, 60), []
    for k in range(150):
        rows.append((k, " ".join(body), "en", "a"))
        body = body[:]
        body[rng.randrange(60)] = f"new{k}"
    out = neardup.near_duplicates(documents(spark, rows), 2).collect()
    assert {r["component_id"] for r in out} == {0}
    kept = neardup.drop_duplicates(documents(spark, rows + rows[:3], extra=True), 2)
    assert [r["doc_id"] for r in kept.collect()] == [0]


def test_empty(spark):
    assert neardup.near_duplicates(documents(spark, []), 2).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(4)
    for shared in (0.7, 0.8, 0.9, 0.97):
        errors = []
        for _ in range(40):
            pool = rng.integers(1, 1 << 62, 2000).astype(np.uint64)
            n_shared = int(1000 * 2 * shared / (1 + shared))
            a, b = pool[:1000], np.concatenate([pool[:n_shared], pool[1000 : 2000 - n_shared]])
            bits = [neardup.odd_sketch(neardup.minhash(x)).view(np.uint64) for x in (a, b)]
            errors.append(int(np.bitwise_count(bits[0] ^ bits[1]).sum()))
        assert abs(np.mean(errors) - neardup.most_differing_bits(shared)) < 5
        if shared == 0.8:
            assert max(errors) < neardup.most_differing_bits(0.8 - neardup.SLACK)


def sketch_miss(similarity, limit):
    """Exact probability that the sketches of a pair differ in more than `limit` bits."""
    samples, bits = neardup._SAMPLES, neardup.SKETCH_BITS
    ways = np.arange(bits + 1)
    odd, miss = np.eye(1, bits + 1)[0], 0.0
    for differing in range(samples + 1):
        for _ in range(2 * (differing > 0)):
            up, down = odd * (bits - ways) / bits, odd * ways / bits
            odd = np.append(0, up[:-1]) + np.append(down[1:], 0)
        share = math.comb(samples, differing) * (1 - similarity) ** differing * similarity ** (samples - differing)
        miss += share * odd[limit + 1 :].sum()
    return miss


def test_sketch_misses_less_than_bands():
    limit = neardup.most_differing_bits(neardup.THRESHOLD / 100 - neardup.SLACK)
    bands = (1 - 0.8**neardup.ROWS) ** neardup.BANDS
    assert sketch_miss(0.8, limit) < bands / 50


def test_pairs_with_unlucky_sketches(spark):
    # Four of five shingles shared; their sketches differ in 134, 146 and 138 bits, 93 on average.
    rows = []
    for k in (31452, 63901, 68832):
        for n in (5, 6):
            rows.append((len(rows), " ".join(f"w{k}x{i}" for i in range(n)), "en", "a"))
    out = neardup.near_duplicates(documents(spark, rows), 2).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in out) == [(i, i // 2 * 2) for i in range(6)]


def test_rows_kept_by_id_and_text(spark):
    rng = random.Random(6)
    one, two, three, four = (" ".join(words(rng, 40)) for _ in range(4))
    rows = [
        (1, one, "en", "a"),
        (5, one, "en", "a"),  # a copy under an id that has a clean text as well
        (5, two, "en", "a"),
        (5, two, "en", "a"),
        (6, three, "en", "a"),
        (6, three + " end", "en", "a"),
        (None, one + " end", "en", "a"),  # a near copy of a row with an id
        (None, four, "en", "a"),
        (None, four + " end", "en", "a"),
        (None, None, "en", "a"),
        (8, "", "en", "a"),
        (8, None, "en", "a"),
    ]
    for parts in (1, 4):
        out = neardup.drop_duplicates(documents(spark, rows, extra=True).repartition(parts), 2)
        found = sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect())
        third = [f for f in found if f[0] == "6"]
        assert len(third) == 1 and third[0][1] in (three, three + " end")
        rest = [rows[0], rows[2], *rows[7:]]
        assert [f for f in found if f[0] != "6"] == sorted((str(i), str(t)) for i, t, _, _ in rest)


def test_bitmaps_of_whole_sets_bound_the_difference_from_below():
    rng = np.random.default_rng(3)
    for size in (1, 30, 31, 33, 500, 5000):
        base = rng.integers(0, 1 << 62, size, dtype=np.uint64)
        for changed in (0, 1, size // 5, size):
            other = base.copy()
            other[:changed] = rng.integers(0, 1 << 62, changed, dtype=np.uint64)
            other = other[: max(1, int(size * 0.9))]
            x, y = neardup.parity_bitmap(base), neardup.parity_bitmap(other)
            while len(x) > len(y):
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            bits = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
            apart = len(np.setxor1d(base, other))
            assert bits <= apart and (bits - apart) % 2 == 0


def test_candidates_are_dropped_only_below_the_threshold(spark):
    rng = np.random.default_rng(4)
    rows, true = [], []
    for k, size in enumerate((1, 5, 31, 32, 33, 63, 64, 65, 200, 1000, 6000)):
        for share in (0.0, 0.05, 0.1, 0.11, 0.112, 0.2, 0.5, 1.0):
            a = rng.integers(0, 1 << 62, size, dtype=np.uint64)
            b = a.copy()
            cut = round(size * share)
            b[:cut] = rng.integers(0, 1 << 62, cut, dtype=np.uint64)
            b = b[: max(1, size - round(size * share / 4))]
            row = []
            for one in (a, b):
                bits = neardup.odd_sketch(neardup.minhash(one)), neardup.parity_bitmap(one)
                row += [len(one), *[part.tolist() for part in bits]]
            rows.append((len(rows), *row))
            true.append(100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)))
    schema = "id int, n_x long, sketch_x array<long>, parity_x array<long>, n_y long, sketch_y array<long>, parity_y array<long>"
    table = spark.createDataFrame(rows, schema)
    both = table.select("id", neardup._may_link("{}_x", "{}_y").alias("xy"), neardup._may_link("{}_y", "{}_x").alias("yx"))
    found = {r.id: (r.xy, r.yx) for r in both.collect()}
    assert all(found[i] == (True, True) for i, linked in enumerate(true) if linked)
    assert sum(found[i][0] for i, linked in enumerate(true) if not linked) <= 5
    assert all(x == y for x, y in found.values())


def test_members_stay_narrow(spark, monkeypatch):
    """Rows of bucket and member carry no sketch and no bitmap from round to round."""
    written, stage = [], neardup.stage

    def noted(df, name):
        written.append((name, df.schema.simpleString()))
        return stage(df, name)

    monkeypatch.setattr(neardup, "stage", noted)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[: 119 - 3 * (i % 10)])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in neardup.near_duplicates(docs).collect()} == {0}
    opened = [kind for name, kind in written if name.startswith("neardup_open")]
    assert opened and not any("sketch" in kind or "parity" in kind for kind in opened)
