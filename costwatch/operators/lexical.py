"""Inverted index, BM25 and TF-IDF search."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costwatch.functions.terms import count_terms, list_slices, token_slices
from costwatch.functions.text import tokenize
from costwatch.operators import blocks, packed
from costwatch.operators.blocks import block_count, blocked_postings, sparse_top_k, swept_top_k
from costwatch.operators.ranking import best_hits, top_k
from costwatch.operators.shared import shared_cut, shared_top_k
from costwatch.settings import QUESTION_TOP_K, TOP_K
from costwatch.staging import join_side, stage

# Okapi parameters; a negative idf is replaced by EPSILON times the mean idf.
K1 = 1.5
B = 0.75
EPSILON = 0.25

ID_RANGE = 16_384  # ids whose matches are counted together


@dataclass(frozen=True)
class LexicalIndex:
    """Written tables of an index, and what is known of them.

    counted: (document_id, length, n_terms, counts), a row for each document with its (term, tf)
    pairs and their number;
    terms: (term, df).
    """

    counted: DataFrame
    terms: DataFrame
    tokens: Callable[[Column], Column]

    @property
    def postings(self) -> DataFrame:
        """(document_id, length, term, tf), taken out of the rows of the documents."""
        return self.counted.select("document_id", "length", F.inline("counts"))

    @property
    def documents(self) -> DataFrame:
        """(document_id, length), also of documents without a term."""
        return self.counted.select("document_id", "length")

    def blocks(self) -> tuple[Column, int]:
        """The block of a document, from its id and length, and the number of blocks.

        Documents of like length share blocks, so that their weights, which depend on the
        length, are alike; a class of lengths has blocks in proportion to its postings.
        """
        size = F.floor(F.log2(F.col("length") + 1)).cast("int")
        held = self.counted.groupBy(size.alias("size")).agg(F.sum("n_terms").alias("n"))
        sizes = [(r["size"], r["n"]) for r in held.collect()]  # at most 63 classes
        total = sum(n for _, n in sizes)
        wanted = block_count(self.counted, total, blocks.POSTING_BLOCK, blocks.MIN_POSTING_BLOCK)
        number, first = F.lit(0).cast("bigint"), 0
        for s, n in sizes:
            parts = max(1, round(wanted * n / max(total, 1)))
            number = F.when(size == s, first + F.pmod(F.xxhash64("document_id"), F.lit(parts))).otherwise(number)
            first += parts
        return number, max(first, 1)


def lexical_index(
    docs: DataFrame, text_col: str = "text", tokens: Callable[[Column], Column] = tokenize
) -> LexicalIndex:
    """Build and stage the index of `docs` (unique document_id). Each text is read once.

    A document's terms are counted inside its row, in numpy, so that only (term, count) rows,
    summed up in each task, are shuffled.
    """
    text = F.col(text_col)
    if tokens is tokenize:  # cut in numpy too: a match at a time costs many times more
        content, none, cut = F.lower(text), F.lit(""), token_slices
    else:
        content, none, cut = tokens(text), F.array().cast("array<string>"), list_slices

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from count_terms(cut(batch))

    kind = docs.schema["document_id"].dataType.simpleString()
    schema = f"document_id {kind}, length bigint, counts array<struct<term:string,tf:bigint>>, n_terms int"
    rows = docs.select("document_id", F.coalesce(content, none).alias("content"))
    counted = stage(rows.mapInArrow(counts, schema), "counted")
    terms = counted.select(F.explode("counts.term").alias("term"))
    df = stage(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "terms")
    return LexicalIndex(counted, df, tokens)


def corpus_stats(index: LexicalIndex) -> DataFrame:
    """One row: number of documents, of tokens, of distinct terms, and the mean length."""
    docs = index.documents.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("n_tokens"),
        F.avg("length").alias("avg_length"),
    )
    n_terms = index.terms.agg(F.count(F.lit(1)).alias("n")).scalar()
    return docs.withColumn("n_terms", n_terms)


def query_terms(queries: DataFrame, tokens: Callable[[Column], Column], text_col: str = "text"):
    """(query_id, term, qtf); a query without a token has no row."""
    return (
        queries.select("query_id", F.explode(tokens(F.col(text_col))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def okapi_idf(index: LexicalIndex) -> DataFrame:
    """(term, df, idf) with idf = ln(N - df + 0.5) - ln(df + 0.5), floored if negative."""
    n = index.documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    raw = index.terms.withColumn("_raw", F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    mean = raw.agg(F.avg("_raw").alias("m")).scalar()
    return raw.select(
        "term", "df", F.when(F.col("_raw") < 0, mean * EPSILON).otherwise(F.col("_raw")).alias("idf")
    )


def bm25_search(
    queries: DataFrame, index: LexicalIndex, k: int = TOP_K, pad: bool = False
) -> DataFrame:
    """`k` best documents per query: (query_id, document_id, score, rank).

    A term counts as often as it occurs in the query. Only terms that occur in some query
    leave the index. With `pad`, documents without a common term take part with score 0, in
    id order; they come before documents with a negative score.
    """
    terms = stage(query_terms(queries, index.tokens), "query_terms")
    wanted = okapi_idf(index).join(terms.select("term").distinct(), "term", "left_semi")
    wanted = stage(wanted, "query_vocabulary")
    length_norm = (
        1
        - B
        + B
        * F.col("length")
        / index.documents.agg(F.avg("length").alias("a")).scalar()
    )
    weight = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * F.col("_norm"))
    asked = terms.select("query_id", "term", F.col("qtf").cast("double").alias("weight"))

    def held(*columns: Column) -> DataFrame:
        """Weighted postings; length and `columns` are worked out once for each document."""
        per_doc = index.counted.select("document_id", *columns, length_norm.alias("_norm"), "counts")
        postings = per_doc.select(*[c for c in per_doc.columns if c != "counts"], F.inline("counts"))
        weighted = postings.join(join_side(wanted), "term").withColumn("weight", weight)
        return weighted.drop("_norm", "tf", "df", "idf")

    cut = shared_cut(asked, wanted)
    if cut:
        hits = shared_top_k(asked, held(), cut, k)
    else:
        block, n_blocks = index.blocks()
        postings = blocked_postings(held(block.alias("block")), F.col("block"))
        hits = sparse_top_k(asked, postings, n_blocks, k)
    if not pad:
        return hits
    hits = stage(hits, "hits")
    blanks = unmatched(terms, hits, index, k).withColumn("score", F.lit(0.0))
    return best_hits(hits.drop("rank").unionByName(blanks), "score", k)


def id_ordinals(documents: DataFrame) -> DataFrame:
    """(document_id, ordinal), written: the place of each id in id order, from 0."""
    ordered = documents.select("document_id").repartitionByRange("document_id")
    ordered = ordered.sortWithinPartitions("document_id").select(
        "document_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    )
    ordered = stage(ordered, "ordered_ids")
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    past, offsets = 0, []
    for r in parts.orderBy("part").collect():  # a row for each task
        offsets.append((r["part"], past - r["first"]))
        past += r["n"]
    carried = documents.sparkSession.createDataFrame(offsets, "part int, past bigint")
    placed = ordered.join(F.broadcast(carried), "part")
    return stage(placed.select("document_id", (F.col("at") + F.col("past")).alias("ordinal")), "ordinals")


def unmatched(terms: DataFrame, hits: DataFrame, index: LexicalIndex, k: int) -> DataFrame:
    """The `k` smallest ids without a common term, for queries with fewer than `k` positive hits.

    Ids are numbered in order and the numbers cut into ranges. Matches are counted by query and
    range; the free ids of a query lie in its first ranges that are not full, `k` of them at
    most, and there in the gaps between the matched numbers.
    """
    width = max(ID_RANGE, k)  # so that the first free range holds all that are wanted
    full = hits.filter("score > 0").groupBy("query_id").count().filter(F.col("count") >= k)
    open_ = terms.select("query_id").distinct().join(full, "query_id", "left_anti")
    open_ = stage(open_, "queries_to_pad")
    ordinals = id_ordinals(index.documents)
    n = ordinals.count()
    matched = (
        terms.join(open_, "query_id", "left_semi")
        .join(index.postings.select("document_id", "term"), "term")
        .select("query_id", "document_id")
        .distinct()
        .join(ordinals, "document_id")
        .select("query_id", "ordinal", F.expr(f"ordinal div {width}").alias("range"))
    )
    matched = stage(matched, "matched_ordinals")

    # The ranges a query matches without a gap from the first one on, and the first it does not
    per_range = matched.groupBy("query_id", "range").agg(F.count(F.lit(1)).alias("taken"))
    in_order = Window.partitionBy("query_id").orderBy("range")
    per_range = per_range.withColumn("place", F.row_number().over(in_order) - 1).filter(F.col("range") == F.col("place"))
    size = F.least(F.lit(width), n - F.col("range") * width)
    free = (size - F.col("taken")).alias("free")
    per_range = stage(per_range.select("query_id", "range", free), "matched_ranges")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("free").over(earlier), F.lit(0))
    partly = per_range.withColumn("before", before).filter((F.col("free") > 0) & (F.col("before") < k))
    first_free = open_.join(per_range.groupBy("query_id").agg(F.max("range").alias("last")), "query_id", "left")
    start = (F.coalesce(F.col("last") + 1, F.lit(0)) * width).cast("bigint")
    untouched = first_free.withColumn("start", start).filter(F.col("start") < n)
    whole = untouched.select(
        "query_id", F.explode(F.sequence(F.col("start"), F.least(F.col("start") + k, F.lit(n)) - 1)).alias("ordinal")
    )

    # Gaps between matched numbers of the ranges that are partly free; one more row than matches
    edges = partly.select("query_id", "range", F.least((F.col("range") + 1) * width, F.lit(n)).alias("ordinal"))
    inside = matched.join(partly.select("query_id", "range"), ["query_id", "range"], "left_semi")
    along = Window.partitionBy("query_id", "range").orderBy("ordinal")
    gap = F.coalesce(F.lag("ordinal").over(along) + 1, F.col("range") * width)
    gaps = inside.unionByName(edges).withColumn("start", gap).filter(F.col("start") < F.col("ordinal"))
    last = F.least(F.col("ordinal"), F.col("start") + k) - 1
    between = gaps.select("query_id", F.explode(F.sequence("start", last)).alias("ordinal"))
    chosen = top_k(whole.unionByName(between), k, [F.col("ordinal").asc()]).drop("rank")
    return chosen.join(ordinals, "ordinal").select("query_id", "document_id")


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


@dataclass(frozen=True)
class TfidfIndex:
    """Documents to search by words and word pairs, and what is known of them.

    documents: (document_id, contents), a row for each id with its texts in lower case; rows
    without an id stay apart. Terms are cut and counted when a search runs, and leave the tasks
    packed: a written index of all pairs of neighbouring words would be several times the texts.
    """

    documents: DataFrame
    stop_words: list[str]
    n_docs: int
    n_bytes: int


def tfidf_index(
    docs: DataFrame, stop_words: Sequence[str] | None = None, text_col: str = "text"
) -> TfidfIndex:
    """Index of words and word pairs without stop words, known by 64-bit hashes."""
    stop = default_stop_words() if stop_words is None else list(stop_words)
    size = F.sum(F.coalesce(F.octet_length(text_col), F.lit(0))).alias("bytes")
    per_id = docs.groupBy("document_id").agg(F.count(F.lit(1)).alias("n"), size)
    repeated = (F.col("n") > 1) & F.col("document_id").isNotNull()
    known = per_id.agg(F.sum("n"), F.sum("bytes"), F.count_if(repeated)).first()
    rows = docs.select("document_id", F.coalesce(F.lower(F.col(text_col)), F.lit("")).alias("content"))
    single = rows.select("document_id", F.array("content").alias("contents"))
    if known[2]:  # texts of one id come together, as they make up one vector
        twice = per_id.filter(repeated).select("document_id")
        single = single.join(twice, "document_id", "left_anti")
        several = rows.join(twice, "document_id").groupBy("document_id")
        single = single.unionByName(several.agg(F.collect_list("content").alias("contents")))
    return TfidfIndex(single, stop, known[0] or 0, known[1] or 0)


def tfidf_search(queries: DataFrame, index: TfidfIndex, k: int = QUESTION_TOP_K) -> DataFrame:
    """`k` best documents per question by cosine of tf-idf vectors, positive scores only.

    idf = ln((1 + n) / (1 + df)) + 1. Terms that the corpus lacks do not count. Document vectors
    have unit length by all their terms, but keep those that some question holds. Weights are
    never written: they follow from the counts, which leave the documents packed.
    """
    grams = packed.grams_of(queries.filter("query_id is not null"), "query_id", F.col("text"), index.stop_words)
    terms = stage(grams.groupBy("query_id", "code").agg(F.sum("n").alias("qtf")), "question_terms")
    # About a word and a pair in eight characters
    n_blocks = block_count(index.documents, index.n_bytes // 4, blocks.SWEPT_BLOCK, blocks.MIN_POSTING_BLOCK)
    codes = terms.select("code").distinct()
    parts = packed.weighed_parts(index.documents, codes, index.n_docs, index.n_bytes, n_blocks, index.stop_words)
    parts = stage(parts, "document_parts")
    idf = F.log((1 + index.n_docs) / (1 + F.col("df"))) + 1
    known = stage(packed.asked_terms(parts).select("code", idf.alias("idf")), "query_vocabulary")
    asked = terms.join(join_side(known), "code").select("query_id", "code", (F.col("qtf") * F.col("idf")).alias("weight"))
    asked = stage(_unit(asked, _norms(asked, "query_id"), "query_id"), "asked")
    asked = asked.groupBy("query_id").agg(F.collect_list(F.struct("code", "weight")).alias("pairs"))
    id_type = index.documents.schema["document_id"].dataType.simpleString()
    return swept_top_k(asked, parts, id_type, index.n_docs, k)


def _norms(terms: DataFrame, key: str) -> DataFrame:
    return terms.groupBy(key).agg(F.sqrt(F.sum(F.pow("weight", F.lit(2)))).alias("_n"))


def _unit(terms: DataFrame, norms: DataFrame, key: str) -> DataFrame:
    """Weights divided by the length of the whole vector."""
    return terms.join(norms, key).withColumn("weight", F.col("weight") / F.col("_n")).drop("_n")
