"""Benchmark decontamination by spaced seeds.

A seed hashes successive words, those where its mask has a 1; words under a 0 may differ. Items of
13 words or more have seeds of five words: two texts with at least 80 % equal words over 13 words
share one. Items of 5 to 12 words must be found whole, with equal words at both ends; their four
masks of four words meet every choice of words that 80 % allows to differ. An item of fewer words
is a seed itself, as no word of it may differ. Only masks that some item needs are looked up.

Seeds of the documents that are in a Bloom filter of all test seeds (fixed size; it only saves
work) are joined with the test seeds by hash. A hit gives an alignment of one document with one
test item; around it the longest stretch with at least 80 % equal words is taken, and it counts
from 13 words on, or from the whole item where that is shorter. A hit of an item that is a seed
itself needs no more proof; its first place in a document counts.

Null and empty texts have no words and never match. Items may be repeated; each row of the result
names one. Rows equal in id and text give one row. Without items or documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costwatch.llm.words import mix, word_slices
from costwatch.staging import stage

LEAST_WORDS = 13
LEAST_PERCENT = 80
WHOLE_WORDS = 4  # items of up to so many words are looked up whole
WHOLE_MASKS = tuple("1" * n for n in range(1, WHOLE_WORDS + 1))
SHORT_MASKS = ("1111", "11011", "10111", "11101")  # for items below LEAST_WORDS
LONG_MASKS = ("11111", "110001011", "11110001")
MASKS = WHOLE_MASKS + SHORT_MASKS + LONG_MASKS
BITMAP_BITS = 1 << 22
BITMAP_SHIFTS = (0, 21, 42)  # three parts of a seed; one alone lets through too many


def masks_of(n_words: np.ndarray) -> np.ndarray:
    """For each mask (row), whether items of so many words are looked up by it."""
    whole = [n_words == len(mask) for mask in WHOLE_MASKS]
    short = (n_words > WHOLE_WORDS) & (n_words < LEAST_WORDS)
    rest = [short] * len(SHORT_MASKS) + [n_words >= LEAST_WORDS] * len(LONG_MASKS)
    return np.array(whole + rest)


def seeds(
    hashes: np.ndarray, first: np.ndarray, numbers: Sequence[int]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each mask: its number, hash at each word, whether it fits into the word's text there."""
    ends = np.repeat(first[1:], np.diff(first))
    for number in numbers:
        mask = MASKS[number]
        room = len(hashes) - len(mask) + 1
        if room <= 0:
            continue
        seed = np.full(room, number + 1, np.uint64)
        for place in (i for i, c in enumerate(mask) if c == "1"):
            seed = mix(seed * np.uint64(3) ^ hashes[place : place + room])
        yield number, seed, np.arange(len(mask), len(mask) + room) <= ends[:room]


def _list(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def seeded(texts: DataFrame, masks: Sequence[int] = (), bitmap=None) -> DataFrame:
    """uid, words (hashes), the places and hashes of the seeds of each text, and their masks.

    Without a bitmap the texts are items, and their lengths choose the masks. With one (broadcast),
    seeds of `masks` that are in it are returned, and only texts with such seeds; of a seed that is
    a whole item only the first place, and words only where other seeds were found.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = bitmap is None
        allowed = None if items else np.unpackbits(bitmap.value).view(bool)
        for batch in batches:
            for low, high, words in word_slices(batch.column(1)):
                hashes, owner = words.hashes(), words.document()
                counts = np.diff(words.first)
                chosen = masks_of(counts) if items else None
                places, found, kinds = [], [], []
                for number, seed, fits in seeds(hashes, words.first, range(len(MASKS)) if items else masks):
                    if items:
                        fits &= chosen[number][owner[: len(seed)]]
                    else:
                        for shift in BITMAP_SHIFTS:
                            fits &= allowed[(seed >> np.uint64(shift)) & np.uint64(BITMAP_BITS - 1)]
                    at = np.flatnonzero(fits)
                    if number < WHOLE_WORDS:
                        order = np.lexsort((seed[at], owner[at]))  # stable, so first places first
                        o, h = owner[at][order], seed[at][order]
                        new = np.ones(len(at), bool)
                        new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
                        at = at[order[new]]
                    places.append(at)
                    found.append(seed[at])
                    kinds.append(np.full(len(at), number))
                at = np.concatenate(places) if places else np.empty(0, np.int64)
                found = np.concatenate(found) if found else np.empty(0, np.uint64)
                kinds = np.concatenate(kinds) if kinds else np.empty(0, np.int64)
                order = np.argsort(owner[at], kind="stable")
                at, found, kinds = at[order], found[order], kinds[order]
                per_text = np.bincount(owner[at], minlength=high - low)
                rows = np.flatnonzero(per_text)
                aligned = np.zeros(high - low, bool)
                aligned[owner[at[kinds >= WHOLE_WORDS]]] = True
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low).take(pa.array(rows)),
                        _list(hashes[aligned[owner]], np.where(aligned, counts, 0)[rows]),
                        _list(at - words.first[owner[at]], per_text[rows]),
                        _list(found, per_text[rows]),
                        _list(kinds, per_text[rows]),
                    ],
                    ["uid", "words", "places", "seeds", "masks"],
                )

    schema = "uid long, words array<long>, places array<long>, seeds array<long>, masks array<long>"
    return texts.select("uid", "text").mapInArrow(scan, schema)


def seed_bitmap(tests: DataFrame):
    """Bits of all test seeds; its size does not depend on the number of tests."""
    bits = np.zeros(BITMAP_BITS, np.uint8)
    parts = [F.shiftright("seed", shift).bitwiseAND(BITMAP_BITS - 1) for shift in BITMAP_SHIFTS]
    places = tests.select(F.explode(F.array(*parts)).alias("bit"))
    bits[places.distinct().toPandas()["bit"].to_numpy(np.int64)] = 1
    return tests.sparkSession.sparkContext.broadcast(np.packbits(bits))


def longest_stretch(equal: np.ndarray, least: int) -> tuple[int, int] | None:
    """Bounds of the longest run with enough equal words, from one equal word to another."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 100 - LEAST_PERCENT, -LEAST_PERCENT))])
    # The lowest score before an equal word so far; it falls, so the first one that is not above
    # the score of an end can be searched.
    lowest = np.minimum.accumulate(np.where(equal, score[:-1], np.iinfo(np.int64).max))
    ends = np.flatnonzero(equal) + 1
    if not len(ends):
        return None
    begins = np.searchsorted(-lowest, -score[ends], "left")
    best = int(np.argmax(ends - begins))
    begin, end = int(begins[best]), int(ends[best])
    return (begin, end) if end - begin >= least else None


def overlaps(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Verified overlaps, the longest one for each document and item.

    uid, doc_id, item_id, doc_start, item_start, n_words, n_equal; places count words from 0.
    """
    own = F.xxhash64("doc_id", "text").alias("uid")
    tests = stage(
        seeded(items.select(F.xxhash64("item_id", "text").alias("uid"), "text").distinct()), "test_seeds"
    )
    exploded = F.explode(F.arrays_zip("places", "seeds", "masks")).alias("s")
    flat = tests.select(F.col("uid").alias("item"), exploded).select(
        "item",
        F.col("s.places").alias("item_place"),
        F.col("s.seeds").alias("seed"),
        F.col("s.masks").alias("mask"),
    )
    masks = [row["mask"] for row in flat.select("mask").distinct().collect()]  # at most len(MASKS)
    found = stage(
        seeded(documents.select(own, "text"), masks, seed_bitmap(flat)).dropDuplicates(["uid"]), "seed_hits"
    )
    hits = found.select("uid", exploded).select(
        "uid", F.col("s.places").alias("place"), F.col("s.seeds").alias("seed")
    )
    met = hits.join(flat, "seed")
    aligned = (
        met.filter(F.col("mask") >= WHOLE_WORDS)
        .select("uid", "item", (F.col("place") - F.col("item_place")).alias("shift"))
        .distinct()
    )
    n_words = (F.col("mask") + 1).alias("n_words")  # a whole item of n words is mask n - 1
    whole = met.filter(F.col("mask") < WHOLE_WORDS).select(
        "uid", "item", F.col("place").alias("doc_start"), F.lit(0).cast("long").alias("item_start"),
        n_words, n_words.alias("n_equal"),
    )
    item_words = tests.select(F.col("uid").alias("item"), F.col("words").alias("item_words"))
    begin = F.greatest("shift", F.lit(0).cast("long"))
    pairs = (
        aligned.join(item_words, "item")
        .join(found.select("uid", "words"), "uid")
        .select(
            "uid",
            "item",
            begin.alias("doc_start"),
            F.size("item_words").alias("n_item"),
            F.slice("words", (begin + 1).cast("int"), F.size("item_words")).alias("x"),
            F.slice("item_words", (begin - F.col("shift") + 1).cast("int"), F.size("item_words")).alias("y"),
            (begin - F.col("shift")).alias("item_start"),
        )
    )

    def prove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                size = min(len(r.x), len(r.y))
                equal = np.asarray(r.x[:size]) == np.asarray(r.y[:size])
                stretch = longest_stretch(equal, min(LEAST_WORDS, r.n_item))
                if stretch:
                    a, b = stretch
                    rows.append((r.uid, r.item, r.doc_start + a, r.item_start + a, b - a, int(equal[a:b].sum())))
            yield pd.DataFrame(rows, columns=["uid", "item", "doc_start", "item_start", "n_words", "n_equal"])

    kept = pairs.mapInPandas(
        prove, "uid long, item long, doc_start long, item_start long, n_words long, n_equal long"
    ).unionByName(whole)
    best = (
        kept.groupBy("uid", "item")
        .agg(F.max(F.struct("n_words", "n_equal", -F.col("doc_start"), -F.col("item_start"))).alias("b"))
        .select(
            "uid",
            "item",
            (-F.col("b.col3")).alias("doc_start"),
            (-F.col("b.col4")).alias("item_start"),
            F.col("b.n_words").alias("n_words"),
            F.col("b.n_equal").alias("n_equal"),
        )
    )
    best = stage(best, "leaks")
    names = documents.select(own, "doc_id").join(best.select("uid").distinct(), "uid", "left_semi").distinct()
    item_names = items.select(F.xxhash64("item_id", "text").alias("item"), "item_id").distinct()
    return best.join(names, "uid").join(item_names, "item").drop("item")


def leak_digest(documents: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each contaminated document and the item found in it; clean documents have none."""
    return overlaps(documents, items).select(
        "doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal"
    )


def clean_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """`documents` without those that hold a part of an item; all columns are kept."""
    leaks = overlaps(documents, items).select(F.col("uid").alias("_uid")).distinct()
    # The row travels as one column, so no name of the caller can meet these.
    keyed = documents.select(F.xxhash64("doc_id", "text").alias("_uid"), F.struct("*").alias("_of"))
    return keyed.join(leaks, "_uid", "left_anti").select("_of.*")
