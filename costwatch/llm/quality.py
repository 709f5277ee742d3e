"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Statistics of each whole text are standardized and mapped to `FEATURES` random cosines, whose
inner products approximate a Gaussian kernel. Every partition of labelled rows adds up its part
of the normal equations; parts are added in groups before the driver solves one small system.
Scores of labelled rows held back from the fit are counted in `BINS` bins, and an isotonic step
function through the bins' label rates, interpolated, turns scores into probabilities.

Only texts enter a score: labels are read for training rows alone, language, source and id never.
Empty and null texts have all statistics 0 and are scored like others. Rows with a null label or
without a document are ignored, several labels of one document count one by one. Without any
training row every score is 0.5. Equal texts get equal scores. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch.llm.words import Words, mix, text_bytes, find_words, slices
from costwatch.staging import stage

FEATURES = 192
RIDGE = 1e-2
GROUPS = 32
BINS = 1024
HELD_BACK = 4  # one in so many training rows calibrates
CUT = 0.3
STATISTICS = (
    "log_words word_bytes symbols shouts digits capitals marks wide lines distinct top_word "
    "distinct_pairs repeats short pipes log_line"
).split()


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that must not be learnt from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def _class_of_bytes() -> list[np.ndarray]:
    code = np.arange(256)
    chosen = lambda chars: np.isin(code, list(chars))
    return [
        chosen(b"#*$%&<>"),
        chosen(b"!"),
        (code >= 48) & (code <= 57),
        (code >= 65) & (code <= 90),
        chosen(b".,;:?'\"()-"),
        code >= 192,
        chosen(b"\n"),
        chosen(b"|"),
    ]


def _runs(sorted_keys: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of distinct keys and the largest number of equal ones."""
    distinct, largest = np.zeros(texts), np.zeros(texts)
    if len(sorted_keys):
        new = np.ones(len(sorted_keys), bool)
        new[1:] = (sorted_keys[1:] != sorted_keys[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        lengths = np.diff(np.append(at, len(sorted_keys)))
        distinct = np.bincount(owner[at], minlength=texts).astype(float)
        np.maximum.at(largest, owner[at], lengths)
    return distinct, largest


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of `STATISTICS` for each text between the byte offsets."""
    words: Words = find_words(data, offsets)
    texts = len(offsets) - 1
    raw = data[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    counts = []
    for table in _class_of_bytes():
        total = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(table[raw], out=total[1:])
        counts.append((total[bounds[1:]] - total[bounds[:-1]]).astype(float))
    symbols, shouts, digits, capitals, marks, wide, breaks, pipes = counts
    n = np.diff(words.first).astype(float)
    sizes = np.diff(bounds).astype(float)
    hashes, owner = words.hashes(), words.document()
    lengths = words.ends - words.starts
    order = np.lexsort((hashes, owner))
    distinct, top = _runs(hashes[order], owner, texts)
    inner = owner[1:] == owner[:-1] if len(owner) else np.empty(0, bool)
    pairs = mix(hashes[:-1] ^ (hashes[1:] * np.uint64(3)))[inner]
    pair_owner = owner[1:][inner]
    order = np.lexsort((pairs, pair_owner))
    distinct_pairs, _ = _runs(pairs[order], pair_owner, texts)
    same = np.bincount(owner[1:][inner & (hashes[1:] == hashes[:-1])], minlength=texts)
    short = np.bincount(owner[lengths == 1], minlength=texts)
    word_bytes = np.bincount(owner, weights=lengths, minlength=texts)
    per_word, per_byte = 1 / np.maximum(n, 1), 1 / np.maximum(sizes, 1)
    # Repetition grows with length by itself; divide by what the square root leaves.
    spread = np.sqrt(np.maximum(n, 1))
    columns = [
        np.log1p(n),
        np.log1p(word_bytes * per_word),
        np.log1p(8 * symbols * per_word),
        np.log1p(8 * shouts * per_word),
        np.log1p(20 * digits * per_byte),
        np.log1p(20 * capitals * per_byte),
        np.log1p(8 * marks * per_word),
        wide * per_byte,
        np.log1p(breaks * per_word * 20),
        np.log1p(distinct / spread),
        top * per_word,
        distinct_pairs * per_word,
        same * per_word,
        short * per_word,
        np.log1p(8 * pipes * per_word),
        np.log1p(n / (breaks + 1)),
    ]
    return np.where(n[:, None] > 0, np.stack(columns, 1), 0.0)


def _batch_statistics(column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    parts = [statistics(data, offsets[low : high + 1]) for low, high in slices(offsets)]
    return np.concatenate(parts) if parts else np.empty((0, len(STATISTICS)))


def document_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and the statistics of its whole text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _batch_statistics(batch.column(1))
            flat = pa.array(rows.astype(np.float32).ravel())
            ends = pa.array(np.arange(0, rows.size + 1, len(STATISTICS), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, flat)], ["doc_id", "stats"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        measure, f"doc_id {kind}, stats array<float>"
    )


@dataclass
class Model:
    """Everything a score needs; a few hundred numbers."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    shift: np.ndarray
    weights: np.ndarray  # the last is the constant
    knots: np.ndarray
    rates: np.ndarray

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        plain = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(plain @ self.waves + self.shift) * np.sqrt(2 / self.waves.shape[1])
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), self.knots, self.rates), 0, 1)


def _matrix(column: pd.Series) -> np.ndarray:
    rows = np.array(column.to_list(), dtype=float)
    return rows if len(column) else rows.reshape(0, len(STATISTICS))


def _normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products of features, and of features and labels, over the rows to fit."""
    size = FEATURES + 1

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squares, sides, part = np.zeros((size, size)), np.zeros(size), 0
        for frame in frames:
            z = model.cosines(_matrix(frame["stats"]))
            squares += z.T @ z
            sides += z.T @ frame["label"].to_numpy(float)
            part = int(frame["part"].iloc[0]) if len(frame) else part
        yield pd.DataFrame({"part": [part], "sums": [np.append(squares.ravel(), sides).tobytes()]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size * size + size)
        for sums in frame["sums"]:
            total += np.frombuffer(sums)
        return pd.DataFrame({"part": frame["part"].iloc[:1], "sums": [total.tobytes()]})

    schema = "part int, sums binary"
    rows = train.withColumn("part", F.spark_partition_id() % GROUPS).select("part", "stats", "label")
    parts = rows.mapInPandas(partial, schema).groupBy("part").applyInPandas(add, schema)
    total = np.zeros(size * size + size)
    for row in sorted(parts.collect()):  # one row for each of GROUPS
        total += np.frombuffer(row["sums"])
    return total[: size * size].reshape(size, size), total[size * size :]


def isotonic(counts: np.ndarray, positives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising rates through the non-empty bins: places (bin numbers) and rates of the blocks."""
    blocks: list[list[float]] = []  # weight, positives, weighted place
    for place in np.flatnonzero(counts):
        blocks.append([counts[place], positives[place], counts[place] * place])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top, strict=True)]
    table = np.array(blocks).reshape(-1, 3)
    return table[:, 2] / table[:, 0], table[:, 1] / table[:, 0]


def fit(stats: DataFrame, labels: DataFrame, seed: int = 5) -> Model:
    """Learn from the labelled rows that are not held out; `stats` should be a written table."""
    known = labels.select(
        F.col("doc_id"), F.col("quality").cast("double").alias("label")
    ).filter("label is not null")
    train = stage(stats.filter(~held_out()).join(known, "doc_id"), "quality_train")
    d = len(STATISTICS)
    sums = train.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(d)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(d)],
    ).first()
    rng = np.random.default_rng(seed)
    waves, shift = rng.normal(size=(d, FEATURES)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, FEATURES)
    none = np.empty(0)
    if not sums["n"]:
        return Model(np.zeros(d), np.ones(d), waves, shift, np.zeros(FEATURES + 1), none, none)
    mean = np.array([sums[f"m{i}"] for i in range(d)])
    scale = np.array([sums[f"s{i}"] for i in range(d)])
    model = Model(mean, np.where(scale > 1e-6, scale, 1.0), waves, shift, none, none, none)
    back = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(HELD_BACK)) == 0
    squares, sides = _normal_equations(train.filter(~back), model)
    model.weights = np.linalg.solve(squares + RIDGE * np.eye(FEATURES + 1), sides)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw = model.raw(_matrix(frame["stats"]))
            bins = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            yield pd.DataFrame({"bin": bins, "label": frame["label"]})

    binned = train.filter(back).select("stats", "label").mapInPandas(place, "bin int, label double")
    counts, positives = np.zeros(BINS), np.zeros(BINS)
    for row in binned.groupBy("bin").agg(F.count("label").alias("n"), F.sum("label").alias("y")).collect():
        counts[row["bin"]], positives[row["bin"]] = row["n"], row["y"]
    if not counts.any():  # too few rows to hold any back: scores as they are
        model.knots, model.rates = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return model
    places, rates = isotonic(counts, positives)
    model.knots, model.rates = (places + 0.5) / BINS * 2 - 0.5, rates
    return model


def text_scores(text: Column, model: Model) -> Column:
    """The score of each whole text, on Arrow batches and without a shuffle."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            column = pa.array(part, pa.large_string(), from_pandas=True)
            stats = _batch_statistics(column).astype(np.float32)
            yield pd.Series(model.score(stats.astype(float)))

    return scored(text.cast("string"))


def train_on(documents: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """A model from these documents and labels, and the written statistics of all documents."""
    stats = stage(document_statistics(documents), "quality_stats")
    return fit(stats, labels), stats


def quality_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.3) of every document."""
    model, stats = train_on(documents, labels)

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "held_out": frame["held_out"], "score": model.score(_matrix(frame["stats"]))}
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = stats.select("doc_id", held_out().alias("held_out"), "stats")
    return rows.mapInPandas(apply, f"doc_id {kind}, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )
