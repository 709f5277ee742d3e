import random
from collections import Counter

from small import documents, hard_rows, text

from costwatch.llm import rules


def by_hand(t):
    words = (t or "").encode().split()
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often, inside = Counter(windows), set()
    for k, w in enumerate(windows):
        if often[w] > 1:
            inside.update(range(k, k + 5))
    lines = [x for x in (t or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in t or ""),
        len(lines) - len(set(lines)),
        len(inside),
    )


def rows():
    rng, out = random.Random(6), hard_rows()
    for i in range(100, 220):
        kind = i % 6
        body = text(rng, rng.randint(5, 60))
        if kind == 1:
            body = "\n".join([body, text(rng, 4), body])
        elif kind == 2:
            body = body.replace(" ", "*** ")
        elif kind == 3:
            body = "\n\n \n".join(["a b", "a b", " a b", body])
        elif kind == 4:
            body = "la " * rng.randint(1, 40)
        out.append((i, body, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None])))
    return out


def test_counts_by_hand(spark):
    frame = documents(spark, rows(), extra=True)
    out = rules.rule_digest(frame).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in out) == sorted(
        (str(i), *by_hand(t)) for i, t, _, _ in rows()
    )
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_bounds_follow_the_source(spark):
    rng, table = random.Random(7), []
    for i in range(400):  # source "code" is full of symbols, "prose" is not
        body = text(rng, 50)
        table.append((i, body.replace(" ", " | ") if i % 2 else body, "en", "code" if i % 2 else "prose"))
    table.append((1000, text(rng, 50).replace(" ", " | "), "en", "prose"))
    table.append((1001, text(rng, 50).replace(" ", "*** "), "en", "code"))
    kept = {r["doc_id"]: r["kept"] for r in rules.rule_digest(documents(spark, table)).collect()}
    assert not kept[1000] and not kept[1001]
    assert sum(kept.values()) >= 390


def test_sketches_merge_and_plans_are_native(spark):
    frame = documents(spark, rows())
    rated = rules.with_ratios(rules.measures(frame))
    both = rules.source_sketches(rated)
    assert rules.thresholds(both).count() == both.count()
    plan = rules.rule_digest(frame)._jdf.queryExecution().toString()
    for plain in (plan, rated._jdf.queryExecution().toString()):
        assert "Python" not in plain and "Pandas" not in plain and "Arrow" not in plain


def test_empty(spark):
    assert rules.rule_digest(documents(spark, [])).count() == 0


def test_sketch_decides_about_repeats_below_the_base_rule(spark):
    rng = random.Random(8)
    plain = [(i, text(rng, 60), "en", "a") for i in range(60)]
    run = text(rng, 5)
    mild = (900, f"{run} {text(rng, 28)} {run} {text(rng, 28)}", "en", "a")
    out = {r["doc_id"]: r for r in rules.rule_digest(documents(spark, [*plain, mild])).collect()}
    assert out[900]["n_repeat_words"] == 10 and not out[900]["base_failed"]
    assert not out[900]["kept"]
    assert sum(out[i]["kept"] for i in range(60)) >= 58
