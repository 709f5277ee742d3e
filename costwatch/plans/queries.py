"""Query catalogue: each entry takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costwatch import settings
from costwatch.functions.text import bigrams, tokenize
from costwatch.operators import (
    corpus,
    dense,
    evaluate,
    evidence,
    explain,
    hybrid,
    lexical,
    metrics,
    prepare,
    quality,
    ranking,
    report,
    verdict,
)
from costwatch.plans import assess
from costwatch.sources import files, mapping
from costwatch.staging import fresh_path, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Stop words of the registered TF-IDF queries; the check SQL uses the same list.
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "it", "that", "for", "le", "la", "de", "et"]


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Doubles and decimals rounded, so that both engines print the same value."""
    fields = {
        f.name: F.round(F.col(f.name).cast("double") * 10.0**decimals) / 10.0**decimals
        for f in df.schema.fields
        if f.dataType.typeName() in ("double", "float", "decimal")
    }
    return df.withColumns(fields) if fields else df


def ranked(df: DataFrame) -> DataFrame:
    return rounded(df.withColumn("rank", F.col("rank").cast("bigint")))


# Shipments and weekly metrics


@query
def shipments_prepared(spark, sf_dir):
    return rounded(
        prepare.with_tonne_km(prepare.prepare_shipments(mapping.shipments(spark, sf_dir)))
    )


@query
def shipment_profile(spark, sf_dir):
    return report.profile_shipments(
        prepare.prepare_shipments(mapping.shipments(spark, sf_dir))
    )


def _bad_shipments(spark, sf_dir):
    key = F.col("l_orderkey")
    return (
        mapping.shipments(spark, sf_dir, keep=("l_orderkey",))
        .withColumns(
            {
                "quantity_tonnes": F.when(key % 97 == 0, -1).otherwise(1) * F.col("quantity_tonnes"),
                "shipment_date": F.when(key % 89 != 0, F.col("shipment_date")),
                "freight_cost_inr": F.when(key % 83 == 0, -1).otherwise(1)
                * F.col("freight_cost_inr"),
                "origin": F.when(key % 79 != 0, F.col("origin")),
            }
        )
        .drop("l_orderkey")
    )


@query
def shipment_checks(spark, sf_dir):
    return quality.shipment_checks(_bad_shipments(spark, sf_dir))


@query
def prepared_checks(spark, sf_dir):
    return quality.prepared_checks(prepare.prepare_shipments(_bad_shipments(spark, sf_dir)))


@query
def note_checks(spark, sf_dir):
    number = F.substring("note_id", 2, 18).cast("bigint")
    notes = mapping.notes(spark, sf_dir)
    return quality.note_checks(
        notes.withColumn("applies_to", F.when(number % 17 != 0, F.col("applies_to")))
    )


def _weekly(spark, sf_dir):
    return assess.weekly_table(mapping.shipments(spark, sf_dir))


def _scored(spark, sf_dir):
    return assess.scored_table(mapping.shipments(spark, sf_dir))


@query
def weekly_metrics(spark, sf_dir):
    shipments = prepare.prepare_shipments(mapping.shipments(spark, sf_dir))
    return rounded(metrics.weekly_metrics(shipments))


@query
def weekly_checks(spark, sf_dir):
    """Checks of the metrics, the baselines and the flags, with spoilt copies of each."""
    scored = _scored(spark, sf_dir)
    month = F.month("week_of")
    spoilt = scored.withColumns(
        {
            "cost_per_tonne_km": F.when(month == 1, float("inf"))
            .when(month == 2, float("nan"))
            .otherwise(F.col("cost_per_tonne_km")),
            "total_tonne_km": F.when(month == 3, 0.0).otherwise(F.col("total_tonne_km")),
            "own_history_baseline": F.coalesce("own_history_baseline", F.lit(0.0)),
            "similar_route_baseline": F.when(month == 4, 0.0).otherwise(
                F.col("similar_route_baseline")
            ),
            "is_candidate_anomaly": F.when(month == 5, False).otherwise(
                F.col("is_candidate_anomaly")
            ),
        }
    )
    checks = {
        "metrics": quality.weekly_checks,
        "baselines": quality.baseline_checks,
        "flags": quality.anomaly_checks,
    }
    parts = [check(spoilt).withColumn("part", F.lit(p)) for p, check in checks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


OWN = ["route", "week_of", "cost_per_tonne_km", "own_history_baseline", "vs_own_history_pct"]
PEER = [
    "route",
    "week_of",
    "route_type",
    "cost_per_tonne_km",
    "similar_route_baseline",
    "vs_similar_routes_pct",
]


@query
def own_history(spark, sf_dir):
    shipments = prepare.prepare_shipments(mapping.shipments(spark, sf_dir))
    return rounded(metrics.own_history_baseline(metrics.weekly_metrics(shipments)).select(*OWN))


@query
def first_weeks(spark, sf_dir):
    shipments = prepare.prepare_shipments(mapping.shipments(spark, sf_dir))
    return rounded(
        metrics.first_weeks(metrics.weekly_metrics(shipments)).select(
            "route", "week_of", "cost_per_tonne_km"
        )
    )


@query
def peer_baseline(spark, sf_dir):
    return rounded(metrics.similar_route_baseline(_weekly(spark, sf_dir)).select(*PEER))


FLAGS = ["anomaly_own_history", "anomaly_similar_routes", "is_candidate_anomaly"]


@query
def anomalies(spark, sf_dir):
    scored = metrics.score_route_weeks(_weekly(spark, sf_dir))
    return rounded(scored.select(*OWN, *PEER[4:], *FLAGS))


@query
def candidates(spark, sf_dir):
    scored = metrics.score_route_weeks(_weekly(spark, sf_dir))
    return rounded(metrics.candidates(scored).select(*OWN, *PEER[4:]))


@query
def event_daily_anomalies(spark, sf_dir):
    """The same operators on events: user groups as routes, days as periods."""
    daily = stage(metrics.weekly_metrics(mapping.event_readings(spark, sf_dir)), "daily")
    scored = metrics.score_route_weeks(daily)
    return rounded(scored.select(*OWN, *PEER[4:], "shipment_count", *FLAGS))


# Evidence and verdicts


@query
def evidence_flags(spark, sf_dir):
    return evidence.with_text_flags(mapping.notes(spark, sf_dir)).select(
        "note_id", "applies_to", "positive_evidence", "negative_evidence"
    )


def _candidates(spark, sf_dir):
    return metrics.candidates(_scored(spark, sf_dir))


def _evidence(spark, sf_dir, strategy):
    return hybrid.retrieve_evidence(
        _candidates(spark, sf_dir), mapping.notes(spark, sf_dir), strategy
    )


def _evidence_query(spark, sf_dir, strategy):
    return ranked(_evidence(spark, sf_dir, strategy))


QUERIES["retrieve_evidence_pre"] = partial(_evidence_query, strategy="pre")
QUERIES["retrieve_evidence_post"] = partial(_evidence_query, strategy="post")


@query
def first_valid_note(spark, sf_dir):
    best = ranking.first_valid(_evidence(spark, sf_dir, "pre"))
    return best.select(
        "route",
        "week_of",
        F.col("valid.note_id").alias("valid_note_id"),
        F.col("closest.note_id").alias("closest_note_id"),
        F.col("closest.note_date").alias("closest_note_date"),
    )


def _assessment(spark, sf_dir, strategy="pre"):
    return assess.assess(
        mapping.shipments(spark, sf_dir), mapping.notes(spark, sf_dir), strategy
    )


@query
def verdicts(spark, sf_dir):
    return _assessment(spark, sf_dir).verdicts.select(
        "route", "week_of", "flagged", "matched_note_id", "note_id", "note_date", "snippet"
    )


@query
def results_shaped(spark, sf_dir):
    return _assessment(spark, sf_dir).results


@query
def route_week_results(spark, sf_dir):
    """Flagship: shipments and notes to the result table, evidence by hybrid search."""
    return _assessment(spark, sf_dir, "post").results


@query
def verdict_summary(spark, sf_dir):
    return report.verdict_summary(_assessment(spark, sf_dir).results)


@query
def unexplained_by_route(spark, sf_dir):
    return report.unexplained_by_route(_assessment(spark, sf_dir).results)


@query
def route_options(spark, sf_dir):
    return report.route_options(_assessment(spark, sf_dir).results)


@query
def report_view(spark, sf_dir):
    return report.report_view(_assessment(spark, sf_dir).results)


@query
def filtered_results(spark, sf_dir):
    return report.filter_results(
        _assessment(spark, sf_dir).results, "ASIA-EUROPE", "Flagged (Needs Review)"
    )


@query
def investigation(spark, sf_dir):
    notes = mapping.notes(spark, sf_dir)
    return report.investigation_view(_assessment(spark, sf_dir).results, notes)


# Evaluation


@query
def label_eval(spark, sf_dir):
    return evaluate.evaluate_cases(mapping.labeled(spark, sf_dir), mapping.notes(spark, sf_dir))


@query
def label_eval_summary(spark, sf_dir):
    return evaluate.evaluation_summary(label_eval(spark, sf_dir))


@query
def run_diff(spark, sf_dir):
    """Results against themselves and against a copy with changed and missing rows."""
    first = stage(_assessment(spark, sf_dir).results, "run")
    month = F.month(F.col("week_of").cast("date"))
    changed = first.filter(month != 12).withColumns(
        {
            "flagged": F.when(month == 3, "Yes").otherwise(F.col("flagged")),
            "cost_per_tonne_km": F.col("cost_per_tonne_km") + F.when(month == 7, 1.0).otherwise(0.0),
        }
    )
    return evaluate.reproducibility_report([first, first, changed])


# Corpus and lexical search


@query
def note_docs(spark, sf_dir):
    return corpus.note_docs(mapping.notes(spark, sf_dir))


@query
def qa_corpus(spark, sf_dir):
    return corpus.qa_corpus(
        _assessment(spark, sf_dir).results, mapping.notes(spark, sf_dir)
    )


@query
def retrieval_queries(spark, sf_dir):
    return corpus.retrieval_queries(_candidates(spark, sf_dir))


@query
def tokens(spark, sf_dir):
    """Postings of the documents: term counts per document."""
    index = lexical.lexical_index(mapping.corpus(spark, sf_dir))
    return index.postings.select("document_id", "term", "tf")


@query
def document_bigrams(spark, sf_dir):
    pairs = bigrams(tokenize(F.col("text")))
    return mapping.corpus(spark, sf_dir).select(
        "document_id",
        F.size(pairs).cast("bigint").alias("n_bigrams"),
        F.size(F.array_distinct(pairs)).cast("bigint").alias("n_distinct"),
    )


@query
def lexical_stats(spark, sf_dir):
    return rounded(lexical.corpus_stats(lexical.lexical_index(mapping.corpus(spark, sf_dir))))


@query
def term_idf(spark, sf_dir):
    return rounded(lexical.okapi_idf(lexical.lexical_index(mapping.corpus(spark, sf_dir))))


@query
def bm25_topk(spark, sf_dir):
    index = lexical.lexical_index(mapping.corpus(spark, sf_dir))
    return ranked(lexical.bm25_search(mapping.passages(spark, sf_dir), index, 10))


def _question_hits(spark, sf_dir):
    index = lexical.tfidf_index(mapping.corpus(spark, sf_dir), STOP_WORDS)
    return lexical.tfidf_search(mapping.questions(spark, sf_dir), index)


@query
def tfidf_topk(spark, sf_dir):
    return ranked(_question_hits(spark, sf_dir))


@query
def qa_prompts(spark, sf_dir):
    prompts = explain.qa_prompts(
        mapping.questions(spark, sf_dir),
        _question_hits(spark, sf_dir),
        mapping.corpus(spark, sf_dir),
    )
    return prompts.select(
        "query_id",
        "n_evidence",
        "best_document",
        F.md5("prompt").alias("prompt_md5"),
    )


@query
def question_answers(spark, sf_dir):
    """Questions over result rows and notes, to the answer and its token counts."""
    results = _assessment(spark, sf_dir).results
    return assess.ask(
        mapping.questions(spark, sf_dir),
        results,
        mapping.notes(spark, sf_dir),
        stop_words=STOP_WORDS,
    ).select("query_id", "n_evidence", "answer", "input_tokens", "output_tokens")


# Dense and hybrid search


@query
def encode_hash(spark, sf_dir):
    encoded = dense.encode(mapping.corpus(spark, sf_dir), "document_id")
    cells = encoded.select("document_id", F.posexplode("embedding").alias("bucket", "value"))
    return rounded(cells.withColumn("bucket", F.col("bucket").cast("bigint")))


@query
def dense_topk(spark, sf_dir):
    """Every vector as a query against all vectors."""
    return ranked(
        dense.dense_search(
            mapping.vectors(spark, sf_dir, "query_id"),
            mapping.vectors(spark, sf_dir, "document_id"),
            10,
        )
    )


def _hybrid_inputs(spark, sf_dir):
    """Passages and their vectors, index and vectors of all documents."""
    docs, passages = mapping.corpus(spark, sf_dir), mapping.passages(spark, sf_dir)
    index = lexical.lexical_index(docs)
    return (
        passages,
        stage(dense.encode(passages, "query_id"), "passage_vectors"),
        index,
        stage(dense.encode_counted(index.counted), "vectors"),
    )


@query
def minmax_scores(spark, sf_dir):
    """Both top-10 lists merged, with their scaled and weighted scores."""
    queries, asked, index, vectors = _hybrid_inputs(spark, sf_dir)
    return rounded(
        hybrid.hybrid_scores(
            dense.dense_search(asked, vectors, settings.CANDIDATE_K),
            lexical.bm25_search(queries, index, settings.CANDIDATE_K, pad=True),
        )
    )


@query
def hybrid_topk(spark, sf_dir):
    hits = hybrid.hybrid_search(*_hybrid_inputs(spark, sf_dir))
    return ranked(hits.select("query_id", "document_id", "hybrid_score", "rank"))


@query
def rerank_topk(spark, sf_dir):
    queries, asked, index, vectors = _hybrid_inputs(spark, sf_dir)
    hits = hybrid.hybrid_search(queries, asked, index, vectors)
    best = hybrid.rerank(hits, queries, mapping.corpus(spark, sf_dir), index)
    return ranked(best.select("query_id", "document_id", "rerank_score", "rank"))


@query
def retrieval_recall(spark, sf_dir):
    """Passages that some document holds verbatim: is it among the first five hits?"""
    passages, docs = mapping.passages(spark, sf_dir), mapping.corpus(spark, sf_dir)
    index = lexical.lexical_index(docs)
    truth = evaluate.contained_passages(passages, docs, index)
    return evaluate.retrieval_recall(lexical.bm25_search(passages, index, 5), truth, 5)


@query
def contained_passages(spark, sf_dir):
    passages, docs = mapping.passages(spark, sf_dir), mapping.corpus(spark, sf_dir)
    return evaluate.contained_passages(passages, docs, lexical.lexical_index(docs))


# Explanations and usage


def _prompts(spark, sf_dir):
    verdicts = _assessment(spark, sf_dir).verdicts
    return explain.ground_prompts(verdicts, corpus.note_docs(mapping.notes(spark, sf_dir)))


@query
def grounded_prompts(spark, sf_dir):
    return _prompts(spark, sf_dir).select("route", "week_of", "note_id", "prompt")


@query
def explanations(spark, sf_dir):
    return explain.explain(_prompts(spark, sf_dir)).select(
        "route", "week_of", "note_id", "reason", "input_tokens", "output_tokens"
    )


@query
def usage_cost(spark, sf_dir):
    return rounded(explain.usage_cost(mapping.calls(spark, sf_dir)), 8)


# Files


@query
def roundtrip_csv(spark, sf_dir):
    """Shipments and notes written as CSV and read back with all checks, then compared."""
    shipments, notes = mapping.shipments(spark, sf_dir), mapping.notes(spark, sf_dir)
    paths = [fresh_path(spark, n) for n in ("shipments_csv", "notes_csv")]
    shipments.write.csv(paths[0], **files.CSV_WRITE)
    notes.write.csv(paths[1], **files.CSV_WRITE)
    read = files.read_shipments(spark, paths[0])
    back = files.read_notes(spark, paths[1])
    same = back.join(notes.select("note_id", F.col("note").alias("_was")), "note_id")
    return rounded(
        read.agg(
            F.lit("shipments").alias("source"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("shipment_id").alias("n_ids"),
            F.sum("freight_cost_inr").cast("double").alias("total"),
            F.max("shipment_date").alias("last_date"),
        ).unionByName(
            back.agg(
                F.lit("notes").alias("source"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_distinct("note_id").alias("n_ids"),
                F.sum(F.char_length("note")).cast("double").alias("total"),
                F.max("date").alias("last_date"),
            )
        ).unionByName(
            same.agg(
                F.lit("notes with their text").alias("source"),
                F.count_if(F.col("note") == F.col("_was")).alias("n_rows"),
                F.count_distinct("note_id").alias("n_ids"),
                F.lit(0.0).alias("total"),
                F.max("date").alias("last_date"),
            )
        )
    )


@query
def roundtrip_labels(spark, sf_dir):
    """Labelled cases written as CSV, read back and evaluated."""
    path = fresh_path(spark, "labels_csv")
    mapping.labeled(spark, sf_dir).write.csv(path, header=True, escape='"')
    labeled = files.read_labeled(spark, path)
    return evaluate.evaluation_summary(
        evaluate.evaluate_cases(labeled, mapping.notes(spark, sf_dir))
    )


@query
def roundtrip_results(spark, sf_dir):
    """Result table written as CSV in route and week order, and read back."""
    path = fresh_path(spark, "results_csv")
    files.write_results(_assessment(spark, sf_dir).results, path)
    return files.read_results(spark, path)


@query
def roundtrip_json(spark, sf_dir):
    """Usage and evaluation reports written as JSON and read back with their schemas."""
    cost = rounded(explain.usage_cost(mapping.calls(spark, sf_dir)), 8)
    path = fresh_path(spark, "usage_json")
    files.write_json_report(cost, path)
    return files.read_json_report(spark, path, cost.schema)


@query
def roundtrip_reasons(spark, sf_dir):
    """Results whose reasons hold line breaks, quotes and blanks, written and read back."""
    notes = mapping.notes(spark, sf_dir)
    results = notes.select(
        F.col("note_id").alias("route"),
        F.col("date").alias("week_of"),
        F.lit(1.5).alias("cost_per_tonne_km"),
        F.lit("N/A").alias("vs_own_history"),
        F.lit("N/A").alias("vs_similar_routes"),
        F.lit(settings.JUSTIFIED).alias("flagged"),
        F.col("note_id").alias("matched_note_id"),
        F.concat(F.lit(' a "quoted", line\n'), "note", F.lit("\nlast line ")).alias("reason"),
    )
    path = fresh_path(spark, "reasons_csv")
    files.write_results(results, path)
    return files.read_results(spark, path).select("route", "week_of", F.md5("reason").alias("digest"))


@query
def roundtrip_indented(spark, sf_dir):
    """Usage of all models as one indented report, read back."""
    cost = rounded(explain.usage_cost(mapping.calls(spark, sf_dir)), 8)
    path = fresh_path(spark, "indented_json")
    rows = F.array_join(F.collect_list(F.to_json(F.struct("*"), {"pretty": "true"})), ",\n")
    cost.agg(F.concat(F.lit("[\n"), rows, F.lit("\n]")).alias("value")).write.text(path)
    return files.read_json_report(spark, path, cost.schema, multi_line=True)


@query
def roundtrip_evaluation(spark, sf_dir):
    """The evaluation summary written as a JSON report and read back."""
    cases = evaluate.evaluate_cases(mapping.labeled(spark, sf_dir), mapping.notes(spark, sf_dir))
    summary = evaluate.evaluation_summary(cases)
    path = fresh_path(spark, "evaluation_json")
    files.write_json_report(summary, path)
    return files.read_json_report(spark, path, summary.schema)


@query
def run_usage(spark, sf_dir):
    """Usage of an assessment's own explanations."""
    return rounded(explain.usage_cost(_assessment(spark, sf_dir).calls), 8)


@query
def bm25_padded(spark, sf_dir):
    """User turns against all passages, which share their words: most scores are negative."""
    docs = mapping.passages(spark, sf_dir).withColumnRenamed("query_id", "document_id")
    return ranked(
        lexical.bm25_search(
            mapping.questions(spark, sf_dir), lexical.lexical_index(docs), 5, pad=True
        )
    )


@query
def contained_words(spark, sf_dir):
    """First words of the passages, alone and in pairs, in the documents that hold them."""
    passages, docs = mapping.passages(spark, sf_dir), mapping.corpus(spark, sf_dir)
    words = F.split("text", " ")
    parts = F.array(F.get(words, F.lit(0)), F.concat_ws(" ", F.slice(words, 2, 2)))
    short = passages.select("query_id", F.posexplode(parts).alias("n", "text")).select(
        (F.col("query_id") * 2 + F.col("n")).alias("query_id"), "text"
    )
    return evaluate.contained_passages(short, docs, lexical.lexical_index(docs))


@query
def exported_view(spark, sf_dir):
    path = fresh_path(spark, "export_csv")
    report.export_view(_assessment(spark, sf_dir).results, "ASIA-EUROPE", "Justified", path)
    return files.read_results(spark, path)


@query
def comparison_text(spark, sf_dir):
    scored = metrics.score_route_weeks(_weekly(spark, sf_dir))
    return verdict.with_comparison_text(scored).select(
        "route", "week_of", "vs_own_history", "vs_similar_routes"
    )
