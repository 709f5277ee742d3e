"""Search by shared parts: what many queries have in common is scored once.

Queries made from one template share most of their terms. Terms that at least `cut` queries hold
with one weight form a query's shared part, the others are its own. Each distinct shared part is
scored once per document; own terms are joined to the postings. A query's best documents are
among those that match an own term and the best of its shared part alone, as own terms only add
to a score: so both together give exact results, and shuffled rows follow matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch.operators.ranking import SCORE_DECIMALS, best_hits, top_k
from costwatch.staging import join_side, stage

CUTS = [4**i for i in range(1, 9)]  # queries that hold a term, from which on it may be shared
LEAST_GAIN = 4  # matches saved by sharing, as a factor


def _held_by(query_terms: DataFrame) -> DataFrame:
    """`query_terms` with `held`, the number of queries that hold the term with this weight."""
    held = query_terms.groupBy("term", "weight").agg(F.count(F.lit(1)).alias("held"))
    return query_terms.join(held, ["term", "weight"])


def _part_id(chosen: Column) -> Column:
    """A digest of the chosen (term, weight) pairs; null without any."""
    pairs = F.array_sort(F.collect_list(F.when(chosen, F.struct("term", "weight"))))
    return F.when(F.size(pairs) > 0, F.sha2(F.to_json(pairs), 256))


def shared_cut(query_terms: DataFrame, idf: DataFrame) -> int | None:
    """The cut with the fewest matches to score, or None if sharing does not save most of them.

    Matches are counted from `idf` (term, df, idf) before any posting is read. A term that
    weighs less than nothing would break the rule that own terms only add: no sharing then.
    """
    counted = _held_by(query_terms.join(join_side(idf), "term"))
    per_query = counted.groupBy("query_id").agg(
        F.min("idf").alias("least"),
        F.sum("df").alias("all"),
        *[F.sum(F.when(F.col("held") < c, F.col("df"))).alias(f"own{c}") for c in CUTS],
        *[_part_id(F.col("held") >= c).alias(f"part{c}") for c in CUTS],
    )
    choice = [
        F.struct(F.lit(c).alias("cut"), F.col(f"part{c}").alias("part"), "all", F.col(f"own{c}").alias("own"), "least")
        for c in CUTS
    ]
    parts = per_query.select(F.inline(F.array(*choice))).fillna(0, ["own"]).groupBy("cut", "part")
    once = F.max(F.col("all") - F.col("own")).alias("once")  # the same for all queries of a part
    sums = [F.sum("own").alias("own"), F.sum("all").alias("all"), F.min("least").alias("least")]
    costs = parts.agg(once, *sums).groupBy("cut").agg(F.sum("once").alias("once"), *sums).collect()
    best = min(costs, key=lambda r: (r["once"] + r["own"], r["cut"]), default=None)
    if best is None or best["least"] < 0 or (best["once"] + best["own"]) * LEAST_GAIN > best["all"]:
        return None
    return best["cut"]


def shared_top_k(query_terms: DataFrame, postings: DataFrame, cut: int, k: int) -> DataFrame:
    """Best documents by the sum over common terms of query weight times document weight.

    `query_terms` is (query_id, term, weight), `postings` (document_id, term, weight), weights
    not below 0. Documents without a common term are no hits.
    """
    counted = stage(_held_by(query_terms), "held_terms")
    common = F.col("held") >= cut
    parts = stage(counted.groupBy("query_id").agg(_part_id(common).alias("part")), "query_parts")
    shared = counted.filter(common).join(parts, "query_id").select("part", "term", "weight").distinct()
    held = stage(postings.select("document_id", "term", F.col("weight").alias("_held")), "held_postings")
    product = F.sum(F.col("weight") * F.col("_held"))

    of_part = shared.join(held, "term").groupBy("part", "document_id").agg(product.alias("_shared"))
    of_part = stage(of_part, "shared_scores")
    own = counted.filter(~common).select("query_id", "term", "weight").join(held, "term")
    own = own.groupBy("query_id", "document_id").agg(product.alias("_own"))

    total = F.round(F.col("_own") + F.coalesce("_shared", F.lit(0.0)), SCORE_DECIMALS)
    matched = own.join(parts, "query_id").join(of_part, ["part", "document_id"], "left")
    matched = matched.select("query_id", "document_id", total.alias("score"))

    rounded = of_part.withColumn("score", F.round("_shared", SCORE_DECIMALS))
    order = [F.col("score").desc(), F.col("document_id").asc()]
    best = top_k(rounded, k, order, group=["part"]).select("part", "document_id", "score")
    alone = parts.join(best, "part").select("query_id", "document_id", "score")

    both = matched.unionByName(alone).groupBy("query_id", "document_id").agg(F.max("score").alias("score"))
    return best_hits(both, "score", k)
