"""Ranked lexical search over bags: documents with one bag of item terms are scored once.

Terms are maximal runs of ASCII letters, digits and other than ASCII characters, A-Z in lower
case. A document's bag is its term frequencies restricted to the terms of the items, in order of
the term; with m, which depends on its length, it decides every score. Documents are grouped by a
hash of bag and m and by bag and m themselves, so a group holds equal ones only; a group is scored
once against the items. Of an item's best groups (as many as hits are asked for: each holds a
document, so no other group can reach the list) the members with the smallest ids are looked up
and ranked. Groups of any size are pre-aggregated, and members cut per group before a shuffle.

Items are dealt into blocks of about `BLOCK_TERMS` (item, term) rows, and a block is broadcast;
the items are the stated queries, so a block meets all groups. Scores are sums of integers below
2**53, for which matrix products of doubles are exact; where they could be larger, of integers.

Null and empty texts have no term and are no hit. Rows are documents of their own, also with equal
ids; rows without an id come last among equal scores. Rows of one item_id are one item with the
terms of all of them; a null item_id is an item as well. An item without a term, or of terms that
weigh nothing, has no row. Empty tables give an empty one. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costwatch.llm.words import word_slices
from costwatch.operators.ranking import top_k
from costwatch.staging import stage

TOP = 10
BLOCK_TERMS = 20_000  # (item, term) rows of a block of items
SCORE_CELLS = 2_000_000  # cells of a group-by-term matrix in a task
PENDING = 50_000  # hits a task holds before it cuts them to the best of each item
# Fixed values of the score.
WEIGHT_SCALE = 1_000
SATURATION_SCALE = 1_000_000_000
LENGTH_SHARE = 90  # of 100
FREQUENCY_SCALE = 1_000
LENGTH_SCALE = 8
LARGEST_ID = 2**63 - 1


def _term_bytes() -> np.ndarray:
    """For each byte whether it belongs to a term; bytes of longer characters all do."""
    byte = np.arange(256)
    digit, letter = (byte >= 0x30) & (byte <= 0x39), ((byte | 32) >= 0x61) & ((byte | 32) <= 0x7A)
    return digit | letter | (byte >= 0x80)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): 64-bit hashes of the distinct terms of each item."""
    inside = _term_bytes()

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, words in word_slices(batch.column("text"), inside=inside):
                rows = batch.column("item_id").take(pa.array(low + words.document()))
                hashes = pa.array(words.hashes().view(np.int64))
                yield pa.record_batch([rows, hashes], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(terms, f"item_id {kind}, term bigint").distinct()


def document_bags(documents: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, bag): number of all terms, and pairs of term number and frequency as bytes.

    `vocabulary` is a broadcast sorted array of term hashes; the place there is the term's number.
    """
    inside = _term_bytes()

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for low, high, words in word_slices(batch.column("text"), inside=inside):
                hashes = words.hashes().view(np.int64)
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                held = known[place] == hashes
                cells = words.document()[held] * len(known) + place[held]
                cells, tf = np.unique(cells, return_counts=True)
                owner, term = np.divmod(cells, len(known))
                pairs = np.column_stack([term, tf]).astype("<i4")
                bounds = (np.searchsorted(owner, np.arange(high - low + 1)) * 8).astype(np.int32)
                bag = pa.Array.from_buffers(
                    pa.binary(), high - low, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(pairs.tobytes())]
                )
                ids = batch.column("doc_id").slice(low, high - low)
                n = pa.array(np.diff(words.first).astype(np.int64))
                yield pa.record_batch([ids, n, bag], ["doc_id", "n", "bag"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(bags, f"doc_id {kind}, n bigint, bag binary")


def _pairs(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term number and frequency of every pair of a column of bags."""
    lengths = np.fromiter((len(b) for b in bags.to_pylist()), np.int64, len(bags)) // 8
    pairs = np.frombuffer(b"".join(bags.to_pylist()), "<i4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(bags)), lengths), pairs[:, 0], pairs[:, 1]


def document_frequencies(bags: DataFrame, n_terms: int) -> DataFrame:
    """(term, df) by term number; tasks count before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(_pairs(batch.column("bag"))[1], minlength=n_terms)
        term = np.flatnonzero(df)
        yield pa.record_batch([pa.array(term.astype(np.int64)), pa.array(df[term])], ["term", "df"])

    counts = bags.select("bag").mapInArrow(count, "term bigint, df bigint")
    return counts.groupBy("term").agg(F.sum("df").alias("df"))


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def bag_classes(bags: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """`bags` that hold an item term, with m and the hash of bag and m."""
    m = F.expr(f"{100 - LENGTH_SHARE} + (({LENGTH_SHARE} * n * {n_docs}L) div {n_terms}L)").alias("m")
    held = bags.filter(F.length("bag") > 0).select("doc_id", "bag", m)
    return held.withColumn("h", F.xxhash64("bag", "m"))


class _Best:
    """The best groups of each item so far; ties go to the group with the smaller id."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.kept, self.new, self.waiting = None, [], 0

    def add(self, scores: np.ndarray, m: np.ndarray, first: np.ndarray, bags: list) -> None:
        """`scores`: groups by items."""
        group, item = np.nonzero(scores >= self.least)
        if len(group):
            own = np.fromiter((bags[g] for g in group), object, len(group))
            self.new.append((item, scores[group, item], first[group], m[group], own))
            self.waiting += len(group)
            if self.waiting > PENDING:
                self.cut()

    def cut(self) -> None:
        parts = ([self.kept] if self.kept else []) + self.new
        if not parts:
            return
        item, score, first, m, bag = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((first, -score, item))
        item = item[order]
        starts = np.searchsorted(item, item)
        place = np.arange(len(item)) - starts
        last = place == self.k - 1
        self.least[item[last]] = score[order][last]
        chosen = order[place < self.k]
        self.kept = (item[place < self.k], score[chosen], first[chosen], m[chosen], bag[chosen])
        self.new, self.waiting = [], 0


def score_classes(classes: DataFrame, block, n_items: int, k: int) -> DataFrame:
    """(item, score, first, m, bag): the `k` best groups of each item of a block, task by task.

    `classes` has m, bag and first, the smallest id of a group; `block` is a broadcast of the
    number of terms and of (term, item, weight) arrays.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_terms, term, item, weight = block.value
        largest = int(np.bincount(item, weight, n_items).max()) * SATURATION_SCALE // FREQUENCY_SCALE
        exact = np.float64 if largest < 2**53 else np.int64
        weights = np.zeros((n_terms, n_items), exact)
        weights[term, item] = weight
        best = _Best(n_items, k)
        step = max(1, SCORE_CELLS // max(n_terms, n_items))
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                m = part.column("m").to_numpy()
                row, number, tf = _pairs(part.column("bag"))
                share = (SATURATION_SCALE * tf) // (FREQUENCY_SCALE * tf + LENGTH_SCALE * m[row])
                cells = np.zeros((part.num_rows, n_terms), exact)
                cells[row, number] = share
                scores = (cells @ weights).astype(np.int64)
                best.add(scores, m, part.column("first").to_numpy(), part.column("bag").to_pylist())
        best.cut()
        if best.kept:
            item, score, first, m, bag = best.kept
            yield pa.record_batch(
                [pa.array(item.astype(np.int64)), pa.array(score), pa.array(first), pa.array(m), pa.array(list(bag), pa.binary())],
                ["item", "score", "first", "m", "bag"],
            )

    schema = "item bigint, score bigint, first bigint, m bigint, bag binary"
    return classes.select("m", "bag", "first").mapInArrow(score, schema)


def _search_block(terms: list, documents: DataFrame, k: int) -> DataFrame | None:
    """Hits of the items whose (item_id, term) rows are given; None where no document has a term."""
    spark = documents.sparkSession
    ids = list(dict.fromkeys(r["item_id"] for r in terms))
    number = {x: i for i, x in enumerate(ids)}
    known = np.unique(np.array([r["term"] for r in terms], np.int64))
    bags = stage(document_bags(documents, spark.sparkContext.broadcast(known)), "bags")
    total = bags.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        return None
    held = document_frequencies(bags, len(known)).collect()  # at most the terms of the block
    weight = np.zeros(len(known), np.int64)
    for r in held:
        weight[r["term"]] = term_weight(total["docs"], r["df"])
    term = np.searchsorted(known, np.array([r["term"] for r in terms], np.int64))
    item = np.array([number[r["item_id"]] for r in terms], np.int64)
    block = spark.sparkContext.broadcast((len(known), term, item, weight[term]))

    marked = bag_classes(bags, total["docs"], total["terms"])
    classes = marked.groupBy("h", "m", "bag").agg(
        F.coalesce(F.min("doc_id").cast("bigint"), F.lit(LARGEST_ID)).alias("first")
    )
    scored = score_classes(classes, block, len(ids), k)
    order = [F.col("score").desc(), F.col("first").asc(), F.col("m").asc(), F.col("bag").asc()]
    winners = stage(top_k(scored, k, order, group=["item"]).drop("rank", "first"), "best_bags")
    winners = winners.withColumn("h", F.xxhash64("bag", "m"))

    key = ["h", "m", "bag"]
    # At most `k` groups an item: the build side is bounded by the block.
    members = marked.join(F.broadcast(winners.select(*key).distinct()), key, "left_semi")
    by_id = [F.col("doc_id").asc_nulls_last()]
    members = stage(top_k(members, k, by_id, group=key).drop("rank"), "best_members")
    hits = winners.join(members, key)
    ranked = top_k(hits, k, [F.col("score").desc(), *by_id], group=["item"])
    named = spark.createDataFrame(
        [(i, x) for x, i in number.items()], f"item bigint, item_id {_kind(ids)}"
    )
    return ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def _kind(ids: list) -> str:
    return "string" if any(isinstance(x, str) for x in ids) else "bigint"


def search(items: DataFrame, documents: DataFrame, k: int = TOP) -> DataFrame:
    """The `k` best documents of each item: item_id, rank (from 1), doc_id, score (above 0).

    `items` has item_id and text, `documents` doc_id (an integer) and text.
    """
    terms = stage(item_terms(items), "item_terms")
    n_blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    dealt = terms.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)))
    found = None
    for n in range(n_blocks):
        rows = dealt.filter(F.col("_block") == n).select("item_id", "term").collect()
        hits = _search_block(rows, documents, k) if rows else None
        if hits is not None:
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        kinds = [f.schema[c].dataType.simpleString() for f, c in ((items, "item_id"), (documents, "doc_id"))]
        schema = f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint"
        return documents.sparkSession.createDataFrame([], schema)
    return found


SEARCH_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
total AS (
  SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM docs WHERE len(terms) > 0),
held AS (
  SELECT row, doc_id, any_value(len(terms))::BIGINT AS size, term, count(*)::BIGINT AS tf
  FROM (SELECT row, doc_id, terms, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY row, doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, total GROUP BY term),
scores AS (
  SELECT item_id, row, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n) // l))))::BIGINT AS score
  FROM held JOIN items USING (term) JOIN weights USING (term), total
  GROUP BY item_id, row, doc_id),
placed AS (
  SELECT item_id, doc_id, score, (row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""
