"""Labelled evaluation, run-to-run comparison and retrieval recall."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costwatch import settings
from costwatch.functions.text import let, tokenize
from costwatch.operators.evidence import with_pair_flags, with_text_flags
from costwatch.operators.lexical import LexicalIndex
from costwatch.operators.ranking import top_k
from costwatch.staging import join_side, stage


def one_per_note_id(notes: DataFrame, order: Sequence[str]) -> DataFrame:
    """A single row per note id, the first in the given order of columns."""
    return top_k(notes, 1, [F.col(c) for c in order], group=["note_id"]).drop("rank")


def evaluate_cases(
    labeled: DataFrame, notes: DataFrame, days: int = settings.NOTE_WINDOW_DAYS
) -> DataFrame:
    """Check every labelled case against its note; a blank or unknown id is not found.

    Rules are evaluated on the raw note, once per note, before the join.
    """
    flagged = with_text_flags(notes).select(
        "note_id",
        F.col("date").alias("note_date"),
        "applies_to",
        "positive_evidence",
        "negative_evidence",
    )
    flagged = one_per_note_id(flagged, ["note_date", "applies_to"]).withColumn(
        "note_found", F.lit(True)
    )
    checked = with_pair_flags(labeled.join(flagged, "note_id", "left"), days, lenient=True)
    passed = (F.col("actual_valid") == F.col("expected_valid")) & (
        F.col("actual_verdict") == F.col("expected_verdict")
    )
    return (
        checked.withColumnsRenamed({"evidence_valid": "actual_valid", "verdict": "actual_verdict"})
        .withColumns(
            {
                "note_found": F.coalesce("note_found", F.lit(False)),
                "note_id": F.coalesce("note_id", F.lit("")),
                "passed": F.coalesce(passed, F.lit(False)),
            }
        )
        .select(
            "case_id",
            "route",
            "week_of",
            "note_id",
            "expected_valid",
            "actual_valid",
            "expected_verdict",
            "actual_verdict",
            "note_found",
            "passed",
            "description",
        )
    )


def evaluation_summary(evaluated: DataFrame) -> DataFrame:
    counts = evaluated.agg(
        F.count(F.lit(1)).alias("total_cases"), F.count_if("passed").alias("passed_cases")
    )
    total, passed = F.col("total_cases"), F.col("passed_cases")
    return counts.withColumns(
        {
            "failed_cases": total - passed,
            "pass_rate": F.when(total > 0, F.bround(passed / total, 4)).otherwise(0.0),
        }
    )


def compare_runs(
    a: DataFrame, b: DataFrame, columns: Sequence[str] = tuple(settings.COMPARED_COLUMNS)
) -> DataFrame:
    """Rows `(column, rows_a, rows_b, differences, passed)` for two result tables.

    Rows are aligned on route and week; a row without partner differs in every column.
    """
    for run in (a, b):
        missing = sorted(set(columns) - set(run.columns))
        if missing:
            raise ValueError(f"run lacks compared columns {missing}")
    key = ["route", "week_of"]

    def side(run: DataFrame, name: str) -> DataFrame:
        return run.select(*key, F.struct(*columns).alias(name))

    joined = side(a, "_a").join(side(b, "_b"), key, "full")
    in_a, in_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    counts = joined.agg(
        F.count_if(in_a).alias("rows_a"),
        F.count_if(in_b).alias("rows_b"),
        *[
            F.count_if(~(in_a & in_b & F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")))).alias(f"d_{c}")
            for c in columns
        ],
    )
    per_column = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"d_{c}").alias("differences")) for c in columns]
    )
    return counts.select("rows_a", "rows_b", F.inline(per_column)).withColumn(
        "passed", (F.col("rows_a") == F.col("rows_b")) & (F.col("differences") == 0)
    )


def reproducibility_report(runs: Sequence[DataFrame]) -> DataFrame:
    """Comparison of each run with the next, and whether all of them agree."""
    if len(runs) < 2:
        raise ValueError("at least two runs are needed")
    pairs = [
        compare_runs(a, b).withColumn("pair", F.lit(f"{i} vs {i + 1}"))
        for i, (a, b) in enumerate(zip(runs, runs[1:]), start=1)
    ]
    report = reduce(DataFrame.unionByName, pairs)  # a few rows per pair
    return report.withColumn("all_passed", F.min("passed").over(Window.partitionBy(F.lit(1))))


def retrieval_recall(hits: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Share of labelled queries with a labelled document among their first `k` hits."""
    found = (
        hits.filter(F.col("rank") <= k)
        .join(truth, ["query_id", "document_id"], "left_semi")
        .select("query_id")
        .distinct()
        .withColumn("_found", F.lit(1))
    )
    asked = truth.select("query_id").distinct().join(found, "query_id", "left")
    return asked.agg(
        F.count(F.lit(1)).alias("queries"),
        F.count("_found").alias("found"),
        F.round(F.count("_found") / F.count(F.lit(1)), 4).alias("recall"),
    )


GRAM = 3  # characters of a fingerprint
SHORT_TEXT = 64  # characters, up to which cutting runs out of a text is cheaper than splitting it


FEW_GRAMS = 64  # asked for; so many are looked up in whole texts, more are cut out of them


def character_grams(text: Column, n: int) -> Column:
    """The distinct runs of `n` characters of a text."""

    def runs(chars: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(chars) - n + 1)
        grams = F.transform(at, lambda i: F.concat(*[F.get(chars, i - 1 + k) for k in range(n)]))
        return F.when(F.size(chars) >= n, F.array_distinct(grams))

    size = F.char_length(text)
    at = F.sequence(F.lit(1), size - n + 1)
    cut = F.when(size >= n, F.array_distinct(F.transform(at, lambda i: F.substring(text, i, F.lit(n)))))
    return F.when(size <= SHORT_TEXT, cut).otherwise(let(F.split(text, ""), runs))


def gram_matches(parts: DataFrame, texts: DataFrame, text_col: str) -> DataFrame:
    """Rows of `texts` with the rows of `parts` (query_id, part) that may lie in their text.

    A text that holds a part holds its runs of `GRAM` characters (a shorter part: the part). Of a
    part's runs the one that is rarest among the texts is its fingerprint, joined to theirs:
    only runs that some part has are looked at, and nothing is compared with everything. An
    empty part lies in every text, and its fingerprint is the empty run.
    """
    length = F.least(F.char_length("part"), F.lit(GRAM))
    by_length = [F.when(length == n, character_grams(F.col("part"), n)) for n in range(1, GRAM + 1)]
    grams = F.coalesce(*by_length, F.array(F.lit("")))
    asked = stage(parts.select("query_id", "part", F.explode(grams).alias("gram")), "part_grams")
    known = join_side(stage(asked.select("gram").distinct(), "asked_grams"))
    text = F.col(text_col)
    few = [r["gram"] for r in known.limit(FEW_GRAMS + 1).collect()]
    if few and len(few) <= FEW_GRAMS:  # looked up in the texts, which need not be cut
        runs = F.filter(F.array(*[F.lit(g) for g in few]), lambda g: F.contains(text, g))
    else:
        every = [F.coalesce(character_grams(text, n), F.array().cast("array<string>")) for n in range(1, GRAM + 1)]
        runs = F.concat(F.array(F.lit("")), *every)
    keys = [c for c in texts.columns if c != text_col]
    held = texts.filter(text.isNotNull()).select(*keys, F.explode(runs).alias("gram"))
    held = stage(held.join(known, "gram", "left_semi"), "held_grams")
    seen = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        asked.join(seen, "gram")
        .groupBy("query_id", "part")
        .agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"), F.count(F.lit(1)).alias("known"))
    )
    # a part with a run that no text holds is in none
    all_runs = asked.groupBy("query_id", "part").agg(F.count(F.lit(1)).alias("known"))
    rarest = rarest.join(all_runs, ["query_id", "part", "known"], "left_semi")
    return rarest.select("query_id", "part", "gram").join(held, "gram").drop("gram")


def _wider_terms(short: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, term): terms one of which a document must hold, for queries of one or two tokens.

    `short` is ((query_id, words), side, part), a row for each token. Of the two sides that with
    fewer postings is taken.
    """
    vocabulary = terms.select("term", "df", F.col("term").alias("_term"))
    found = gram_matches(short.select("query_id", "part").distinct(), vocabulary, "_term")
    alone = F.size("query_id._words") == 1
    fits = F.when(alone, F.contains("term", "part")).when(F.col("side") == 0, F.endswith("term", "part"))
    fits = fits.otherwise(F.startswith("term", "part"))
    wider = stage(found.join(short.distinct(), ["query_id", "part"]).filter(fits), "wider_terms")
    costs = wider.groupBy("query_id", "side").agg(F.sum("df").alias("n"))
    side = costs.groupBy("query_id").agg(F.min(F.struct("n", "side"))["side"].alias("side"))
    return wider.join(side, ["query_id", "side"], "left_semi").select("query_id.query_id", "term")


def contained_passages(queries: DataFrame, docs: DataFrame, index: LexicalIndex) -> DataFrame:
    """(query_id, document_id) where the document holds the query text verbatim.

    A document that holds the text holds its inner tokens whole, so each query is joined on
    its rarest inner token and the few documents found are checked. Queries of one or two tokens
    have no inner token: the documents to check are those with a token that holds their first
    one, found by character runs among the distinct terms. Queries without a token are found by
    character runs of the documents.
    """
    words = tokenize(F.col("text"))
    asked = stage(queries.filter("text is not null").withColumn("_words", words), "passages")
    inner = F.slice("_words", 2, F.greatest(F.size("_words") - 2, F.lit(0)))
    anchors = (
        asked.select("query_id", F.explode(F.array_distinct(inner)).alias("term"))
        .join(index.terms, "term")
        .groupBy("query_id")
        .agg(F.min(F.struct("df", "term"))["term"].alias("term"))
    )
    texts = docs.select("document_id", F.col("text").alias("_doc"))
    few = asked.filter(F.size("_words").between(1, 2)).select(F.struct("query_id", "_words").alias("query_id"), "_words")
    first, last = F.struct(F.lit(0).alias("side"), F.col("_words")[0].alias("part")), F.struct(F.lit(1).alias("side"), F.get("_words", F.lit(1)).alias("part"))
    short = few.select("query_id", F.inline(F.array(first, last))).filter("part is not null")
    bare = asked.filter(F.size("_words") == 0).select("query_id", F.col("text").alias("part"))
    suspects = anchors
    if not short.isEmpty():
        suspects = anchors.unionByName(_wider_terms(short, index.terms))
    suspects = suspects.join(index.postings.select("document_id", "term"), "term").select("query_id", "document_id")
    if not bare.isEmpty():
        suspects = suspects.unionByName(gram_matches(bare, texts, "_doc").select("query_id", "document_id"))
    return (
        suspects.distinct()
        .join(texts, "document_id")
        .join(asked.select("query_id", F.col("text").alias("_query")), "query_id")
        .filter(F.contains("_doc", "_query"))
        .select("query_id", "document_id")
    )
