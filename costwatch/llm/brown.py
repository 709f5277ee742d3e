"""Brown class-based bigrams: exchange clustering of words, then smoothed perplexity.

P(word | past) = P(class | class before) * P(word | class). A word's class is that of its hash
bucket (65,536 of them), so that the class table has a fixed size however large the vocabulary
grows; emission counts stay exact for every word.

1. Words of the training texts are counted over all data (partial counts, one shuffle).
2. The `HEAD` heaviest buckets are clustered by the exchange algorithm: a bucket moves to the
   class with the largest gain in likelihood until no bucket moves. It needs only the bigram counts
   of the head, a matrix of fixed size.
3. `SWEEPS` parallel exchange steps over the whole corpus place all buckets: the classes to the left
   and right of each bucket are counted and each bucket takes its best class.
4. Class bigrams are counted over all training texts.

Emission takes the discount d = n1 / (n1 + 2 n2) off every word count; what it frees in a class
is the probability of an unknown word there (split by class of its bucket, so that all
probabilities add up to at most 1). Transitions are smoothed towards the class frequencies.
Scoring walks a text once; up to `DICTIONARY` of the heaviest words are looked up in a broadcast
table, all others are joined with the word counts by hash.

Words are known by 64-bit hashes. Null and empty texts have only the end token. Without training
rows every word is unknown. Equal texts get equal scores, equal rows a row each. An empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch.llm.words import slices, word_slices
from costwatch.staging import stage

BUCKETS = 1 << 16
CLASSES = 32  # class 0 is the end token, which also stands before the first word
HEAD = 768
SWEEPS = 2
DICTIONARY = 1 << 17
PULL = 20.0  # weight of the class frequencies in transitions
CHUNK_WORDS = 1 << 20
_SHIFT = np.uint64(48)


def training(doc_id: str = "doc_id") -> Column:
    """Rows to learn from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 != 1


def word_counts(texts: DataFrame) -> DataFrame:
    """word (hash) and n over all texts."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [words.hashes() for _, _, words in word_slices(batch.column(0))]
            hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            word, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"]
            )

    counts = texts.select("text").mapInArrow(partial, "word long, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def bucket_sequences(texts: DataFrame) -> DataFrame:
    """Each text as the buckets of its words, two bytes a word."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for low, high, words in word_slices(batch.column(0)):
                codes = (words.hashes() >> _SHIFT).astype(np.uint16)
                rows += [
                    codes[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:], strict=True)
                ]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["codes"])

    return texts.select("text").mapInArrow(walk, "codes binary")


def _neighbours(batch: pa.RecordBatch, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Codes of many texts in a row: bucket (or -1 at an end), value of `table` before and after."""
    rows = [np.frombuffer(row.as_py(), np.uint16) for row in batch.column(0)]
    bounds = np.concatenate([[0], np.cumsum([len(row) + 1 for row in rows], dtype=np.int64)])
    for low, high in slices(bounds, CHUNK_WORDS):
        codes = np.full(int(bounds[high] - bounds[low]) + 1, -1, np.int32)
        inside = np.ones(len(codes), bool)
        inside[bounds[low : high + 1] - bounds[low]] = False
        codes[inside] = np.concatenate(rows[low:high])
        yield codes, table[codes[:-1]], table[codes[1:]]


def _table(classes: np.ndarray, end: int) -> np.ndarray:
    """Lookup by bucket; the code -1 of an end finds the last entry."""
    return np.append(classes, end).astype(np.int64)


def pair_counts(sequences: DataFrame, classes: np.ndarray, size: int, end: int) -> np.ndarray:
    """Counts of successive values over all texts: a `size` by `size` matrix."""
    table = _table(classes, end)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for _, before, after in _neighbours(batch, table):
                total += np.bincount(before * size + after, minlength=size * size)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    cells = sequences.mapInArrow(partial, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(size * size, np.int64)
    found = cells.toPandas()  # at most size * size rows
    out[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out.reshape(size, size)


def context_counts(sequences: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Per bucket: how often each class stands before it and after it (two matrices side by side)."""
    table = _table(classes, 0)
    width = 2 * (CLASSES + 1)  # the last class of each side: not placed yet

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * width, np.int32)

        waiting: list[np.ndarray] = []
        held = 0

        def flush() -> None:
            if waiting:
                more = np.bincount(np.concatenate(waiting), minlength=len(total))
                np.add(total, more, out=total, casting="unsafe")
                waiting.clear()

        for batch in batches:
            for codes, before, after in _neighbours(batch, table):
                own = codes.astype(np.int64)
                word = own[1:] >= 0
                waiting.append(own[1:][word] * width + before[word])
                word = own[:-1] >= 0
                waiting.append(own[:-1][word] * width + (CLASSES + 1) + after[word])
                held += len(own)
                if held > 1 << 21:
                    flush()
                    held = 0
        flush()
        rows = total.reshape(BUCKETS, width)
        used = np.flatnonzero(rows.any(1))
        for at in range(0, len(used), 4096):
            part = used[at : at + 4096]
            columns = [pa.array(part.astype(np.int32)), *[pa.array(rows[part, j].astype(np.int64)) for j in range(width)]]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", *[f"c{j}" for j in range(width)]])

    names = [f"c{j}" for j in range(width)]
    schema = "bucket int, " + ", ".join(f"{c} long" for c in names)
    summed = sequences.mapInArrow(partial, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names])
    found = summed.toPandas()  # at most BUCKETS rows
    out = np.zeros((BUCKETS, width), np.int64)
    if len(found):
        out[found["bucket"].to_numpy(np.int64)] = found[names].to_numpy(np.int64)
    return out


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, words: int, classes: int, rounds: int = 20) -> np.ndarray:
    """Classes 1 .. classes - 1 of the first `words` rows of a bigram count matrix.

    Row and column `words` are the end token (class 0), the next ones all other words, which stay
    in a class of their own behind the others.
    """
    size = classes + 1
    own = np.append(np.arange(words) % (classes - 1) + 1, [0, classes])
    counts = bigrams.astype(float)
    member = np.zeros((words + 2, size))
    member[np.arange(words + 2), own] = 1
    grid = member.T @ counts @ member
    for _ in range(rounds):
        moved = 0
        for w in range(words):
            right, left = counts[w] @ member, counts[:, w] @ member
            self_count = counts[w, w]
            a = own[w]
            right[a] -= self_count
            left[a] -= self_count
            grid[a] -= right
            grid[:, a] -= left
            grid[a, a] -= self_count
            gain = class_gains(grid, right, left, self_count)
            b = int(np.argmax(gain[1:classes])) + 1
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            grid[b] += right
            grid[:, b] += left
            grid[b, b] += self_count
            member[w, a], member[w, b], own[w] = 0, 1, b
        if not moved:
            break
    return own[:words]


def class_gains(grid: np.ndarray, right: np.ndarray, left: np.ndarray, self_count: float) -> np.ndarray:
    """Gain in log likelihood from putting a word with these contexts into each class."""
    rows = (_f(grid + right) - _f(grid)).sum(1)
    columns = (_f(grid + left[:, None]) - _f(grid)).sum(0)
    own = np.diag(grid)
    cross = _f(own + right + left + self_count) - _f(own + right) - _f(own + left) + _f(own)
    # The word also adds to the totals of its neighbours' classes, wherever it goes itself.
    out, into = grid.sum(1) + left, grid.sum(0) + right
    total_out, total_in = right.sum() + self_count, left.sum() + self_count
    return rows + columns + cross - (_f(out + total_out) - _f(out)) - (_f(into + total_in) - _f(into))


def place_buckets(contexts: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """The best class of each bucket given the classes around it; unseen ones take the largest."""
    out, into = grid.sum(1), grid.sum(0)
    row_log = np.log((grid + 0.1) / (out[:, None] + 0.1 * len(grid)))  # class -> next class
    before, after = contexts[:, :CLASSES], contexts[:, CLASSES + 1 : 2 * CLASSES + 1]
    # log P(class | before) and log P(after | class), summed over the places of the bucket.
    fit = before @ row_log + after @ row_log.T
    # The bucket's share of its class: in a large class it is rarer.
    fit -= before.sum(1, keepdims=True) * np.log(np.maximum(into, 1))
    fit[:, 0] = -np.inf
    best = fit.argmax(1)
    empty = contexts.sum(1) == 0
    best[empty] = int(np.argmax(into[1:])) + 1
    return best


@dataclass
class BrownModel:
    classes: np.ndarray  # class of each bucket
    transitions: np.ndarray  # log10 P(class | class before)
    class_tokens: np.ndarray  # training tokens of each class
    class_types: np.ndarray
    discount: float
    tokens: int  # with ends
    types: int
    texts: int

    def known(self, n: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 P(word | class) of words counted n times; unknown ones have n = 0."""
        size = self.class_tokens[of]
        free = np.where(size > 0, self.discount * self.class_types[of], 1.0)
        part = np.where(n > 0, n - self.discount, free)
        return np.log10(part / np.maximum(size, 1))

    def base(self, n: np.ndarray | int) -> np.ndarray:
        return np.log10((n + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def train(documents: DataFrame, learn: Column) -> tuple[BrownModel, DataFrame]:
    """The model and the written word counts it goes with."""
    texts = documents.filter(learn).select("text")
    counts = stage(word_counts(texts), "brown_words")
    sequences = stage(bucket_sequences(texts), "brown_codes")
    bucket = F.shiftrightunsigned("word", 48).cast("int").alias("bucket")
    per_bucket = counts.groupBy(bucket).agg(
        F.sum("n").alias("tokens"),
        F.count(F.lit(1)).alias("types"),
        F.sum((F.col("n") == 1).cast("long")).alias("once"),
        F.sum((F.col("n") == 2).cast("long")).alias("twice"),
    )
    rows = per_bucket.toPandas()  # at most BUCKETS rows
    at = rows["bucket"].to_numpy(np.int64)
    bucket_tokens, bucket_types = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    bucket_tokens[at], bucket_types[at] = rows["tokens"], rows["types"]
    once, twice = int(rows["once"].sum()), int(rows["twice"].sum())
    texts_read = sequences.count()

    heavy = np.argsort(-bucket_tokens, kind="stable")[:HEAD]
    heavy = heavy[bucket_tokens[heavy] > 0]
    spot = np.full(BUCKETS, len(heavy) + 1)
    spot[heavy] = np.arange(len(heavy))
    size = len(heavy) + 2
    classes = np.full(BUCKETS, CLASSES)
    classes[heavy] = exchange(pair_counts(sequences, spot, size, len(heavy)), len(heavy), CLASSES)
    for _ in range(SWEEPS):
        grid = pair_counts(sequences, classes, CLASSES + 1, 0)[:CLASSES, :CLASSES]
        contexts = context_counts(sequences, classes)
        classes = place_buckets(contexts, grid.astype(float))
    grid = pair_counts(sequences, classes, CLASSES, 0).astype(float)
    tokens = np.bincount(classes, weights=bucket_tokens, minlength=CLASSES)
    types = np.bincount(classes, weights=bucket_types, minlength=CLASSES)
    share = grid.sum(0) + 1
    share /= share.sum()
    transitions = np.log10((grid + PULL * share) / (grid.sum(1, keepdims=True) + PULL))
    discount = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5
    model = BrownModel(
        classes.astype(np.uint8), transitions, tokens, types, discount,
        int(bucket_tokens.sum()) + texts_read, int(bucket_types.sum()) + (texts_read > 0), texts_read,
    )
    return model, counts


def heaviest(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent words, `most` of them at the outside: those above a bound on n.

    The bound comes from counts of words by the size of n, so no task sends a list of its own.
    """
    size = F.floor(F.log2("n") * 16).cast("int")
    bound, total = 0, 0
    sizes = counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("words")).collect()
    for row in sorted(sizes, reverse=True):  # 16 rows for each doubling of n
        total += row["words"]
        bound = row["size"]
        if total > most:
            bound += 1
            break
    return counts.filter(size >= bound)


def scored(documents: DataFrame, learn: Column, dictionary: int = DICTIONARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each whole text."""
    model, counts = train(documents, learn)
    heavy = heaviest(counts, dictionary).toPandas()
    order = np.argsort(heavy["word"].to_numpy(np.int64))
    shared = documents.sparkSession.sparkContext.broadcast(
        # Plain arrays: a class of this package in a broadcast would have to be found by executors.
        (heavy["word"].to_numpy(np.int64)[order], heavy["n"].to_numpy(np.int64)[order], astuple(model))
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, listed_n, parts = shared.value
        model = BrownModel(*parts)
        end_known, end_base = int(model.texts > 0), float(model.base(model.texts))
        for batch in batches:
            for low, high, words in word_slices(batch.column(2)):
                texts, owner = high - low, words.document()
                hashes = words.hashes()
                of = model.classes[hashes >> _SHIFT].astype(np.int64)
                opening, closing = words.first[:-1], words.first[1:]
                filled = closing > opening
                before = np.empty(len(of), np.int64)
                before[1:] = of[:-1]
                before[opening[filled]] = 0
                steps = np.bincount(owner, weights=model.transitions[before, of], minlength=texts)
                last = np.zeros(texts, np.int64)
                last[filled] = of[closing[filled] - 1]
                steps += model.transitions[last, 0]
                keys = hashes.view(np.int64)
                spot = np.minimum(np.searchsorted(listed, keys), max(len(listed) - 1, 0))
                hit = listed[spot] == keys if len(listed) else np.zeros(len(keys), bool)
                n = listed_n[spot[hit]]
                sums = [
                    np.bincount(owner[hit], weights=w, minlength=texts)
                    for w in (np.ones(len(n)), model.base(n), model.known(n, of[hit]))
                ]
                rest = ~hit
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner[rest], minlength=texts))])
                ends = pa.array(ends.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, texts),
                        batch.column(1).slice(low, texts),
                        pa.array(np.diff(words.first) + 1),
                        pa.array(sums[0].astype(np.int64) + end_known),
                        pa.array(sums[1] + end_base),
                        pa.array(sums[2] + steps),
                        pa.ListArray.from_arrays(ends, pa.array(keys[rest])),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, "
        "score double, rest array<long>"
    )
    rows = documents.select("doc_id", (~learn).alias("held_out"), "text").mapInArrow(walk, schema)
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "brown_rows")
    return _with_rare_words(rows, counts, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def _with_rare_words(rows: DataFrame, counts: DataFrame, model: BrownModel) -> DataFrame:
    """Adds the words that the dictionary lacks: counted per text, joined with all word counts."""

    @F.pandas_udf("base double, score double")
    def worth(word: pd.Series, n: pd.Series) -> pd.DataFrame:
        n = n.to_numpy(np.int64)
        of = model.classes[word.to_numpy(np.int64).view(np.uint64) >> _SHIFT].astype(np.int64)
        return pd.DataFrame({"base": model.base(n), "score": model.known(n, of)})

    rare = rows.select("_row", F.explode("rest").alias("word")).groupBy("_row", "word").agg(
        F.count(F.lit(1)).alias("times")
    )
    n = F.coalesce("n", F.lit(0)).cast("long")
    priced = rare.join(counts, "word", "left").select(
        "_row", "times", n.alias("n"), worth("word", n).alias("w")
    )
    added = priced.groupBy("_row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * F.col("w.base")).alias("_base"),
        F.sum(F.col("times") * F.col("w.score")).alias("_score"),
    )
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return rows.drop("rest").join(added, "_row", "left").select(
        "doc_id", "held_out", "n_tokens",
        plus("n_known", "_known"), plus("base_score", "_base"), plus("score", "_score"),
    )
