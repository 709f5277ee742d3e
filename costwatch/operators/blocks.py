"""Exact top-k search in bounded blocks of documents that bounds let a query skip.

Documents are dealt into blocks of bounded size; each block has an upper bound of the score that
a query can reach in it. A query first visits the blocks that promise most. The k-th score found
there is a floor: of the other blocks only those whose bound reaches it are visited, so results
are exact. Queries travel to the blocks they visit; a task takes up one block after another and
lets the visiting queries stream by, so it never holds more than one block and a batch of
queries. Neither (query, document) pairs nor copies of postings are shuffled.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import dataset, fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch.functions.grams import unpack_sorted
from costwatch.operators import packed
from costwatch.operators.ranking import SCORE_DECIMALS, best_hits, top_k
from costwatch.staging import absolute, fresh_path, stage

POSTING_BLOCK = 200_000  # (document, term) rows per block
VECTOR_BLOCK = 32_768  # vectors per block
SCORE_CELLS = 1_000_000  # scores held at a time inside a task
SEED_BLOCKS = 2  # blocks that a query visits before bounds are held against its k-th score
SLACK = 1e-6  # bounds and scores are sums of doubles in different orders
VISIT_TASKS = 4_096
SWEPT_BLOCK = 2_000_000  # cells of sparse vectors per block that all queries pass by
SWEEP_BATCH = 4_096  # queries that a task reads at a time
SWEPT_CELLS = 262_144  # postings, or scores, of some of these queries held at a time: near the cores' caches
OFTEN, OFTEN_TERMS = 10, 128  # at most so many terms, in each so-manieth document at least, are a matrix
# Below these sizes a block is not split further to occupy idle cores.
MIN_POSTING_BLOCK = 20_000
MIN_VECTOR_BLOCK = 4_096


def block_count(df: DataFrame, rows: int, largest: int, smallest: int) -> int:
    """Blocks for `rows` rows: about `largest` rows at most, and two per core if not tiny."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(2 * cores, -(-rows // smallest)), -(-rows // largest))


def bounded_top_k(
    seeds: DataFrame,
    others: Callable[[DataFrame], DataFrame],
    visit: Callable[[DataFrame], DataFrame],
    k: int,
) -> DataFrame:
    """The `k` best hits: (query_id, document_id, score, rank).

    `seeds` are the (query_id, block) pairs to visit first. `others` gets (query_id, floor), the
    k-th score of each query that has one, and returns the other pairs whose bound reaches it.
    `visit` scores pairs and returns at most `k` hits for each.
    """
    first = stage(best_hits(visit(seeds), "score", k), "first_hits")
    floors = first.filter(F.col("rank") == k).select("query_id", (F.col("score") - SLACK).alias("floor"))
    rest = visit(others(floors))
    return best_hits(first.drop("rank").unionByName(rest), "score", k)


def _take_best(scores: np.ndarray, k: int, at_least: float) -> np.ndarray:
    """Positions of the `k` largest scores above `at_least`, ties to the lower position."""
    if len(scores) > k:
        at_least = max(at_least, np.nextafter(np.partition(scores, -k)[-k], -np.inf))
    found = np.flatnonzero(scores > at_least)
    return found[np.argsort(-scores[found], kind="stable")[:k]]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(block, kind, rows) of neighbouring rows that agree in both."""
    block, kind = (batch.column(c).to_numpy() for c in ("block", "kind"))
    cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        if high > low:
            yield int(block[low]), int(kind[low]), batch.slice(low, high - low)


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of a column of lists, one after another, and the length of each list."""
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten(), lengths


def _visited(
    block_rows: DataFrame, query_rows: DataFrame, n_blocks: int, holder: Callable, schema: str
) -> DataFrame:
    """Hits of queries in the blocks they visit; `holder()` takes up a block and scores queries.

    Both sides have a column `block`; the rows of a block come before the queries that visit it.
    """
    rows = block_rows.withColumn("kind", F.lit(0)).unionByName(
        query_rows.withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    dealt = rows.repartition(min(n_blocks, VISIT_TASKS), "block").sortWithinPartitions("block", "kind")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None
        for batch in batches:
            for block, kind, part in _runs(batch):
                if block != current:
                    current, held = block, holder()
                if kind == 0:
                    held.add(part)
                else:
                    for ids, hits in held.score(part):
                        yield pa.record_batch([ids, *hits], ["query_id", "document_id", "score"])

    return dealt.mapInArrow(stream, schema)


def _hit_schema(queries: DataFrame, docs: DataFrame) -> str:
    kinds = [f.schema[c].dataType.simpleString() for f, c in ((queries, "query_id"), (docs, "document_id"))]
    return f"query_id {kinds[0]}, document_id {kinds[1]}, score double"


class _Hits:
    """Hits of some queries, collected into Arrow columns."""

    def __init__(self, queries: pa.Array, ids: np.ndarray):
        self.queries, self.ids, self.rows, self.docs, self.scores = queries, ids, [], [], []

    def add(self, row: int, scores: np.ndarray, k: int) -> None:
        best = _take_best(scores, k, -np.inf)
        self.rows.append(np.full(len(best), row))
        self.docs.append(best)
        self.scores.append(scores[best])

    def columns(self, kind: pa.DataType) -> tuple[pa.Array, list[pa.Array]]:
        rows, docs, scores = (np.concatenate(c) if c else np.empty(0) for c in (self.rows, self.docs, self.scores))
        found = pa.array(self.ids[docs.astype(np.int64)].tolist(), kind)
        return self.queries.take(pa.array(rows.astype(np.int64))), [found, pa.array(scores, pa.float64())]


# Terms


def blocked_postings(weighted: DataFrame, block: Column) -> DataFrame:
    """(block, document_id, term, weight), written; `weighted` has what `block` needs."""
    return stage(weighted.select(block.alias("block"), "document_id", "term", "weight"), "blocked_postings")


def term_bounds(query_terms: DataFrame, postings: DataFrame) -> DataFrame:
    """(query_id, block, bound): the most a query can reach in each block that holds a term of it.

    A document may lack a term, so a weight counts as 0 at least.
    """
    largest = postings.groupBy("block", "term").agg(F.max("weight").alias("most"))
    reach = query_terms.join(largest, "term")
    most = F.col("weight") * F.greatest("most", F.lit(0.0))
    return reach.groupBy("query_id", "block").agg(F.sum(most).alias("bound"))


def seed_pairs(bounds: DataFrame) -> DataFrame:
    order = [F.col("bound").desc(), F.col("block").asc()]
    return top_k(bounds, SEED_BLOCKS, order).select("query_id", "block")


def open_pairs(bounds: DataFrame, seeds: DataFrame, floors: DataFrame) -> DataFrame:
    """Pairs not yet visited whose bound reaches the floor of the query, or that has none."""
    left = bounds.join(seeds, ["query_id", "block"], "left_anti").join(floors, "query_id", "left")
    return left.filter(F.col("floor").isNull() | (F.col("bound") >= F.col("floor"))).select("query_id", "block")


class _TermBlock:
    """The posting lists of a block, and scores of queries against them."""

    def __init__(self, k: int, positive: bool):
        self.k, self.positive, self.parts, self.lists = k, positive, [], None

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append([part.column(c) for c in ("term", "document_id", "weight")])

    def _ready(self) -> None:
        terms, ids, weights = (pa.concat_arrays(c) for c in zip(*self.parts))
        self.kind, self.parts = ids.type, [None]
        coded = terms.dictionary_encode()
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        self.ids, place = np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)
        self.place, self.weights = place[order], weights.to_numpy()[order]
        starts = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1)).tolist()
        self.lists = {t: slice(*starts[i : i + 2]) for i, t in enumerate(coded.dictionary.to_pylist())}

    def score(self, part: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
        if not self.parts:
            return
        if self.lists is None:
            self._ready()
        hits = _Hits(part.column("query_id"), self.ids)
        total, hit = np.zeros(len(self.ids)), np.zeros(len(self.ids), dtype=bool)
        for row, asked in enumerate(part.column("term").to_pylist()):
            total[:], hit[:] = 0.0, False
            for pair in json.loads(asked):
                cells = self.lists.get(pair["term"])
                if cells is not None:
                    places = self.place[cells]
                    total[places] += pair["weight"] * self.weights[cells]
                    hit[places] = True
            found = hit & (total > 0) if self.positive else hit
            hits.add(row, np.where(found, np.round(total, SCORE_DECIMALS), -np.inf), self.k)
        yield hits.columns(self.kind)


def sparse_top_k(
    query_terms: DataFrame, postings: DataFrame, n_blocks: int, k: int, positive: bool = False
) -> DataFrame:
    """Best documents by the sum over common terms of query weight times document weight.

    `query_terms` is (query_id, term, weight) with weights above 0 and unique (query_id, term);
    `postings` comes from `blocked_postings`. Documents without a common term are no hits, with
    `positive` also those whose sum is not above 0 (before it is rounded).
    """
    bounds = stage(term_bounds(query_terms, postings), "block_bounds")
    seeds = seed_pairs(bounds)
    # The terms of a query as one text in the column `term`: Arrow writes columns of lists that
    # are mostly null many times more slowly than texts.
    pairs = F.array_sort(F.collect_list(F.struct("term", "weight")))
    asked = query_terms.groupBy("query_id").agg(F.to_json(pairs).alias("term"))
    schema = _hit_schema(query_terms, postings)

    def visit(pairs: DataFrame) -> DataFrame:
        return _visited(postings, pairs.join(asked, "query_id"), n_blocks, lambda: _TermBlock(k, positive), schema)

    return bounded_top_k(seeds, lambda floors: open_pairs(bounds, seeds, floors), visit, k)


# Sparse vectors against many queries


def _queries_of(where: str, batch_rows: int) -> Iterator[pa.RecordBatch]:
    """The written queries, batch by batch; tasks read them themselves."""
    store, root = fs.FileSystem.from_uri(where)
    written = dataset.dataset(root, filesystem=store, format="parquet")
    yield from written.to_batches(batch_size=batch_rows, use_threads=False, batch_readahead=1, fragment_readahead=1)


def _pairs_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes and weights of a column of lists of both, and the row of each."""
    pairs, lengths = _lists(column)
    codes, weights = (pairs.field(i).to_numpy(zero_copy_only=False) for i in range(2))
    return codes, weights, np.repeat(np.arange(len(lengths)), lengths)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of spans, one span after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _row_ranges(sizes: np.ndarray, cells: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes and cells, so many for each row, are bounded, or single rows."""
    ends, low = np.append(0, np.cumsum(sizes)), 0
    step = max(1, SWEPT_CELLS // max(cells, 1))
    while low < len(sizes):
        high = int(np.searchsorted(ends, ends[low] + SWEPT_CELLS, "right")) - 1
        yield low, (low := min(max(low + 1, high), low + step, len(sizes)))


class _SweptBlock:
    """The posting lists of a block of sparse vectors, which all queries pass by."""

    def __init__(self, ids: pa.Array, codes: np.ndarray, counts: np.ndarray, rows: np.ndarray, weights: np.ndarray, lengths: np.ndarray, k: int):
        """Cells (rows, weights) in order of their distinct codes, which have `counts` of them each;
        rows of one id are one document, whose squared `lengths` add up and whose cells count once."""
        self.k, self.kind, self.codes = k, ids.type, codes
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        named = ids.filter(pa.array(known)).to_numpy(zero_copy_only=False)
        self.ids, of = np.unique(named, return_inverse=True)
        place = np.full(len(ids), -1)
        place[known] = of
        n = self.n_docs = len(self.ids)
        length = np.sqrt(np.bincount(of, lengths[known], minlength=n))
        term, place = np.repeat(np.arange(len(codes)), counts), place[rows]
        if len(named) < len(ids):
            term, place, weights = (c[place >= 0] for c in (term, place, weights))
        keys = term * n + place
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
        if n < len(named):
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
            keys, weights = keys[first], np.maximum.reduceat(weights, first) if len(first) else weights
        term, self.place = np.divmod(keys, max(n, 1))
        self.keys, self.weights = keys, weights / length[self.place]
        self.sizes = np.bincount(term, minlength=len(codes))
        self.starts = np.cumsum(self.sizes) - self.sizes
        held = np.flatnonzero(self.sizes)
        self.most = np.zeros(len(codes))
        self.most[held] = np.maximum.reduceat(self.weights, self.starts[held]) if len(held) else 0.0
        often = held[self.sizes[held] * OFTEN >= n]
        often = often[np.argsort(-self.sizes[often], kind="stable")[:OFTEN_TERMS]]
        self.line = np.full(len(codes), -1)
        self.line[often] = np.arange(len(often))
        self.lines = np.zeros((len(often), n))
        cells = _spans(self.starts[often], self.sizes[often])
        self.lines[np.repeat(np.arange(len(often)), self.sizes[often]), self.place[cells]] = self.weights[cells]
        self.rare = np.where(self.line < 0, self.sizes, 0)

    def score(self, part: pa.RecordBatch) -> tuple[pa.Array, list[pa.Array]]:
        """Hits that reach the floor of their query, `k` at most."""
        asked, weights, rows = _pairs_of(part.column("pairs"))
        asked, n_rows = asked.view(np.uint64), part.num_rows
        floors = part.column("floor").to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(self.codes, asked), len(self.codes) - 1)
        reach = np.bincount(rows, np.where(self.codes[at] == asked, weights * self.most[at], 0.0), n_rows)
        open_ = (reach > 0) & ~(reach < floors)  # without a floor (NaN) all
        held = np.flatnonzero((self.codes[at] == asked) & open_[rows])
        number = np.cumsum(open_) - 1
        at, weights, rows, origin = at[held], weights[held], number[rows[held]], np.flatnonzero(open_)
        hits = [(origin[row], place, score) for row, place, score in self._hits(at, weights, rows, floors[open_])]
        row, place, score = (np.concatenate(c) for c in zip(*hits)) if hits else (np.empty(0, np.int64),) * 3
        found = pa.array(self.ids[place].tolist(), self.kind)
        return part.column("query_id").take(pa.array(row)), [found, pa.array(score.astype(np.float64))]

    def _hits(self, at: np.ndarray, weights: np.ndarray, rows: np.ndarray, floors: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, place, score) of some rows at a time: frequent terms by a matrix product, others by their postings."""
        n, ends = self.n_docs, np.searchsorted(rows, np.arange(len(floors) + 1))
        for low, high in _row_ranges(np.bincount(rows, self.rare[at], len(floors)).astype(np.int64), n):
            own = slice(ends[low], ends[high])
            term, weight, row = at[own], weights[own], rows[own] - low
            sizes = self.rare[term]
            cells = _spans(self.starts[term], sizes)
            keys = np.repeat(row * n, sizes) + self.place[cells]
            total = np.bincount(keys, np.repeat(weight, sizes) * self.weights[cells], (high - low) * n)
            total = total.astype(np.float64, copy=False).reshape(high - low, n)  # sums of no cells are whole numbers
            if len(self.lines):
                often = np.flatnonzero(self.line[term] >= 0)
                asked = np.zeros((high - low, len(self.lines)))
                asked[row[often], self.line[term[often]]] = weight[often]
                total += asked @ self.lines
            least = floors[low:high].copy()
            unknown = np.isnan(least)
            if unknown.any():
                least[unknown] = 0.0 if n <= self.k else np.partition(total[unknown], n - self.k, axis=1)[:, n - self.k] - SLACK
            found = np.flatnonzero(total >= np.maximum(least, np.finfo(float).tiny)[:, None])
            row, place = np.divmod(found, n)
            yield self._best(row + low, place, total.ravel()[found])

    def _best(self, row: np.ndarray, place: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, ...]:
        """The `k` best of each row, by rounded scores and then the smaller id."""
        score = np.round(score, SCORE_DECIMALS)
        order = np.lexsort((place, -score, row))
        row, place, score = row[order], place[order], score[order]
        new = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)])
        rank = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row))))
        return row[rank < self.k], place[rank < self.k], score[rank < self.k]


def _swept_block(parts: list[tuple[int, pa.Buffer]], n_docs: int, k: int) -> _SweptBlock:
    """A block from the parts of a chunk (kind, data)."""
    by = {kind: [data for kd, data in parts if kd == kind] for kind in (packed.IDS, packed.SUMS, packed.CELLS)}
    ids = packed.from_bytes(by[packed.IDS][0])
    lengths = np.zeros(len(ids))
    for data in by[packed.SUMS]:
        lengths += np.frombuffer(data, np.float64)
    cells = sorted((unpack_sorted(data) for data in by[packed.CELLS]), key=lambda c: c[0][0])
    empty = [np.empty(0, kind) for kind in (np.uint64, *[np.int64] * 4)]
    codes, counts, df, rows, n = (np.concatenate(c) for c in zip(*cells)) if cells else empty
    weights = np.repeat(packed.smooth_idf(n_docs, df.astype(np.int64)), counts) * n
    return _SweptBlock(ids, codes, counts, rows, weights, lengths, k)


def swept_top_k(queries: DataFrame, parts: DataFrame, id_type: str, n_docs: int, k: int) -> DataFrame:
    """Best documents by inner product of sparse vectors, products above 0 only.

    `queries` is (query_id, pairs) with arrays of (code, weight), weights
    above 0; `parts` the written parts of documents (`packed.weighed_parts`). A task holds
    a block, which a chunk's parts make up, and reads the written queries along it, so neither
    queries nor (query, block) pairs are shuffled. Some blocks, the square root of their number,
    are swept first: their k-th score is a query's floor in the others, which so return few hits
    and skip queries that cannot reach it.
    """
    spark = queries.sparkSession
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, document_id {id_type}, score double"
    chunks = sorted(r[0] for r in parts.filter(F.col("kind") == packed.IDS).select("chunk").collect())
    step = max(1, math.isqrt(len(chunks)))
    parts = parts.filter(F.col("kind").isin(packed.IDS, packed.SUMS, packed.CELLS))

    def sweep(chosen: list[int], asked: DataFrame) -> DataFrame:
        path = fresh_path(spark, "swept_queries")
        asked.write.parquet(path)
        where = absolute(spark, path)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = (x for b in batches for x in zip(b.column("chunk").to_pylist(), b.column("kind").to_pylist(), b.column("data")))
            for _, same_chunk in itertools.groupby(rows, key=lambda x: x[0]):
                held = _swept_block([(kind, data.as_buffer()) for _, kind, data in same_chunk], n_docs, k)
                if not len(held.keys):
                    continue
                for part in _queries_of(where, SWEEP_BATCH):
                    found, hits = held.score(part)
                    yield pa.record_batch([found, *hits], ["query_id", "document_id", "score"])

        # Blocks in turns, as a hash would give some tasks several and others none
        turns = spark.createDataFrame(list(zip(chosen, range(len(chosen)))), "chunk bigint, turn int")
        dealt = parts.join(F.broadcast(turns), "chunk").repartitionById(max(1, min(len(chosen), VISIT_TASKS)), "turn")
        return dealt.sortWithinPartitions("chunk").mapInArrow(score, schema)

    found = sweep(chunks[::step], queries.withColumn("floor", F.lit(float("nan"))))
    if step == 1:
        return best_hits(found, "score", k)
    found = stage(best_hits(found, "score", k), "first_hits")
    floors = found.filter(F.col("rank") == k).select("query_id", (F.col("score") - SLACK).alias("floor"))
    asked = queries.join(floors, "query_id", "left").fillna(float("nan"), ["floor"])
    rest = sweep([c for i, c in enumerate(chunks) if i % step], asked)
    return best_hits(found.drop("rank").unionByName(rest), "score", k)


# Vectors

MAX_CENTROIDS = 1_024
SAMPLE_PER_CENTROID = 16  # of the documents that come first by hash, to place the centroids
PLACING_ROUNDS = 5


def _matrix(column: pa.Array) -> np.ndarray:
    values, lengths = _lists(column)
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lengths), -1)


def _nearest_centroid(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and distance of the centroid next to each vector."""
    near = np.argmin((centroids**2).sum(axis=1) - 2.0 * vectors @ centroids.T, axis=1)
    return near, np.linalg.norm(vectors - centroids[near], axis=1)


def place_centroids(corpus: DataFrame, n: int) -> np.ndarray:
    """About `n` means of a sample of bounded size; where they lie decides speed, never results."""
    sample = corpus.orderBy(F.xxhash64("document_id")).limit(n * SAMPLE_PER_CENTROID).select("embedding")
    vectors = np.array([r[0] for r in sample.collect()], dtype=np.float64)
    centroids = vectors[:n].copy()
    for _ in range(PLACING_ROUNDS):
        near, _ = _nearest_centroid(vectors, centroids)
        for c in np.unique(near):
            centroids[c] = vectors[near == c].mean(axis=0)
    return centroids


def vector_blocks(corpus: DataFrame, corpus_rows: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(document_id, embedding, block), written, and the centroid and radius of each block.

    Vectors go to the next centroid; those of a centroid that has too many are split by a hash.
    """
    centroids = place_centroids(corpus, min(MAX_CENTROIDS, block_count(corpus, corpus_rows, VECTOR_BLOCK, MIN_VECTOR_BLOCK)))
    sent = corpus.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near, away = _nearest_centroid(_matrix(batch.column("embedding")), sent.value)
                yield pa.record_batch([*batch.columns, pa.array(near), pa.array(away)], [*batch.schema.names, "near", "away"])

    rows = corpus.select("document_id", "embedding")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    near = stage(rows.mapInArrow(assign, f"{kinds}, near bigint, away double"), "assigned_vectors")
    held = near.groupBy("near").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
    parts, middles, radii = [], [], []
    for r in held.collect():  # a row for each centroid
        n = -(-r["n"] // VECTOR_BLOCK)
        parts.append((r["near"], len(radii), n))
        middles += [centroids[r["near"]]] * n
        radii += [r["radius"]] * n
    numbers = corpus.sparkSession.createDataFrame(parts, "near bigint, first bigint, parts bigint")
    block = F.col("first") + F.pmod(F.xxhash64("document_id"), F.col("parts"))
    near = near.join(F.broadcast(numbers), "near")
    return near.select("document_id", "embedding", block.alias("block")), np.array(middles), np.array(radii)


def _vector_pairs(queries: DataFrame, sent, seeds: bool) -> DataFrame:
    """(query_id, block) to visit: the blocks that promise most, or others that reach `floor`.

    A vector's product with a query is at most that of its centroid plus radius times the
    length of the query.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middles, radii = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            asked = _matrix(batch.column("embedding"))
            bounds = asked @ middles.T + np.linalg.norm(asked, axis=1, keepdims=True) * radii
            best = np.argsort(-bounds, axis=1, kind="stable")[:, :SEED_BLOCKS]
            chosen = np.zeros(bounds.shape, dtype=bool)
            np.put_along_axis(chosen, best, True, axis=1)
            if not seeds:
                floor = batch.column("floor").to_numpy(zero_copy_only=False)
                chosen = ~chosen & ~(bounds < floor[:, None])  # without a floor (NaN) all
            row, block = np.nonzero(chosen)
            ids = batch.column("query_id").take(pa.array(row))
            yield pa.record_batch([ids, pa.array(block.astype(np.int64))], ["query_id", "block"])

    kind = queries.schema["query_id"].dataType.simpleString()
    return queries.mapInArrow(choose, f"query_id {kind}, block bigint")


class _VectorBlock:
    def __init__(self, k: int):
        self.k, self.parts, self.vectors = k, [], None

    def add(self, part: pa.RecordBatch) -> None:
        self.kind = part.column("document_id").type
        ids = part.column("document_id").to_numpy(zero_copy_only=False)
        self.parts.append((ids, _matrix(part.column("embedding"))))

    def score(self, part: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
        if not self.parts:
            return
        if self.vectors is None:
            ids, vectors = (np.concatenate(c) for c in zip(*self.parts))
            order = np.argsort(ids, kind="stable")
            self.ids, self.vectors, self.parts = ids[order], vectors[order], [None]
        asked = _matrix(part.column("embedding"))
        hits = _Hits(part.column("query_id"), self.ids)
        step = max(1, SCORE_CELLS // len(self.ids))
        for low in range(0, len(asked), step):  # a batch of queries, bounded in cells
            for row, scores in enumerate(np.round(asked[low : low + step] @ self.vectors.T, SCORE_DECIMALS), low):
                hits.add(row, scores, self.k)
        yield hits.columns(self.kind)


def dense_top_k(queries: DataFrame, corpus: DataFrame, corpus_rows: int, k: int) -> DataFrame:
    """Best documents by inner product of `embedding`s of one length."""
    schema = _hit_schema(queries, corpus)
    if not corpus_rows:
        return queries.sparkSession.createDataFrame([], schema + ", rank int")
    asked = queries.select("query_id", "embedding")
    if block_count(corpus, corpus_rows, VECTOR_BLOCK, MIN_VECTOR_BLOCK) == 1:  # nothing to skip
        one = corpus.select("document_id", "embedding", F.lit(0).cast("bigint").alias("block"))
        asked = asked.withColumn("block", F.lit(0).cast("bigint"))
        return best_hits(_visited(one, asked, 1, lambda: _VectorBlock(k), schema), "score", k)
    blocks, middles, radii = vector_blocks(corpus, corpus_rows)
    sent = queries.sparkSession.sparkContext.broadcast((middles, radii))

    def visit(pairs: DataFrame) -> DataFrame:
        return _visited(blocks, pairs.join(asked, "query_id"), len(radii), lambda: _VectorBlock(k), schema)

    def others(floors: DataFrame) -> DataFrame:
        return _vector_pairs(asked.join(floors, "query_id", "left"), sent, seeds=False)

    seeds = _vector_pairs(asked, sent, seeds=True)
    if len(radii) <= SEED_BLOCKS:  # all of them
        return best_hits(visit(seeds), "score", k)
    return bounded_top_k(seeds, others, visit, k)
