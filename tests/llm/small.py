"""Small tables for the operator tests."""

import random

VOCABULARY = [a + b for a in "ka le mi no ru sta tre vo".split() for b in "na pe si tu wox yl".split()]


def words(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(VOCABULARY) for _ in range(n)]


def text(rng: random.Random, n: int) -> str:
    return " ".join(words(rng, n))


def documents(spark, rows, extra=False):
    """rows: (doc_id, text, lang, source); `extra` adds columns whose names operators might use."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]
    frame = spark.createDataFrame(full, schema)
    if extra:
        names = "_uid _of node root size shard slot score n label _row _bucket block epoch stats".split()
        frame = frame.selectExpr("*", *[f"doc_id AS {name}" for name in names])
    return frame


def hard_rows():
    """Nulls in every column, empty, blank and long texts, repeated rows and ids."""
    long = " ".join(f"w{i}" for i in range(30_000))
    return [
        (1, "plain words stand here for a test of rows that are common", "en", "a"),
        (1, "plain words stand here for a test of rows that are common", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "b"),
        (4, " \n\t ", "de", None),
        (None, "a text without any number of its own is here", "en", "a"),
        (None, None, "en", "a"),
        (5, long, "fr", "b"),
        (6, "x" * 50_000, "fr", "b"),
        (7, "one", "en", "c"),
        (7, "two other", "en", "c"),
        (8, "über ça ✓ 漢字 🙂 \x00 nul", "es", "d"),
    ]
