"""DuckDB SQL that computes each catalogue query directly, for checking.

The statements are put together from named common table expressions. They state the plain
definition (band joins on dates, sums over all pairs with a common term) where the Spark
jobs use a form that scales.
"""

from __future__ import annotations

import re

from costwatch import settings
from costwatch.functions.text import LEXICAL_TOKEN, WORD_TOKEN
from costwatch.plans.queries import STOP_WORDS
from costwatch.sources.mapping import NOTE_SENTENCES

WHITESPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '\A{WHITESPACE}+|{WHITESPACE}+\z', '', 'g')"


def normalized(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '{WHITESPACE}+', ' ', 'g'))"


def tokenized(c: str) -> str:
    return f"regexp_extract_all(lower({c}), '{LEXICAL_TOKEN}')"


def fill(template: str, *arguments: str) -> str:
    """A `%s` format as a SQL concatenation of quoted text and expressions."""
    parts = template.split("%s")
    pieces = [quote(parts[0])]
    for argument, part in zip(arguments, parts[1:], strict=True):
        pieces += [argument, quote(part)]
    return " || ".join(pieces)


def pct_difference(value: str, base: str) -> str:
    return (
        f"CASE WHEN {base} = 0 AND {value} > 0 THEN 'inf'::DOUBLE "
        f"WHEN {base} <> 0 THEN ({value} - {base}) / {base} * 100 END"
    )


def signed_percent(p: str) -> str:
    return f"CASE WHEN {p} >= 0 THEN '+' ELSE '-' END || printf('%.1f', abs({p}))"


def comparison(p: str, phrase: str) -> str:
    return f"CASE WHEN {p} IS NULL THEN 'N/A' ELSE {signed_percent(p)} || {quote('% ' + phrase)} END"


def has_any(c: str, patterns: list[str]) -> str:
    return f"regexp_matches({normalized(c)}, {quote('|'.join(patterns))})"


CTES: dict[str, str] = {}

CTES["shipments"] = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                 strftime(l_shipdate, '%Y%m%d'), CAST(round(l_extendedprice * 100) AS BIGINT)) AS shipment_id,
       rs.r_name AS origin, rc.r_name AS destination,
       CASE WHEN rs.r_regionkey = rc.r_regionkey THEN 'Short'
            WHEN abs(rs.r_regionkey - rc.r_regionkey) <= 2 THEN 'Medium' ELSE 'Long' END AS route_type,
       l_returnflag AS material, l_quantity AS quantity_tonnes,
       CAST(100.0 + 50.0 * abs(ns.n_nationkey - nc.n_nationkey) AS DOUBLE) AS distance_km,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS freight_cost_inr,
       CAST(l_shipdate AS DATE) AS shipment_date, s_name AS transporter, l_orderkey
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation nc ON c_nationkey = nc.n_nationkey JOIN region rc ON nc.n_regionkey = rc.r_regionkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ns ON s_nationkey = ns.n_nationkey JOIN region rs ON ns.n_regionkey = rs.r_regionkey"""

CTES["bad_shipments"] = """
SELECT shipment_id, CASE WHEN l_orderkey % 79 <> 0 THEN origin END AS origin, destination, route_type,
       CASE WHEN l_orderkey % 97 = 0 THEN -1 ELSE 1 END * quantity_tonnes AS quantity_tonnes, distance_km,
       CASE WHEN l_orderkey % 83 = 0 THEN -1 ELSE 1 END * freight_cost_inr AS freight_cost_inr,
       CASE WHEN l_orderkey % 89 <> 0 THEN shipment_date END AS shipment_date
FROM shipments"""

CTES["prepared"] = """
SELECT * EXCLUDE (l_orderkey), origin || '-' || destination AS route,
       CAST(date_trunc('week', shipment_date) AS DATE) AS week_of
FROM shipments"""

CTES["weekly"] = """
SELECT route, week_of, min(route_type) AS route_type,
       sum(quantity_tonnes) AS total_quantity_tonnes, sum(distance_km) AS total_distance_km,
       sum(quantity_tonnes * distance_km) AS total_tonne_km,
       CAST(sum(freight_cost_inr) AS DOUBLE) AS total_freight_cost_inr, count(*) AS shipment_count,
       CAST(sum(freight_cost_inr) AS DOUBLE) / sum(quantity_tonnes * distance_km) AS cost_per_tonne_km
FROM prepared GROUP BY route, week_of"""

CTES["daily"] = """
SELECT CAST(user_id % 20 AS VARCHAR) AS route, CAST(ts AS DATE) AS week_of,
       CAST(user_id % 20 % 4 AS VARCHAR) AS route_type, count(*) AS shipment_count,
       CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS cost_per_tonne_km
FROM events GROUP BY ALL"""


def _scored(source: str) -> str:
    own = pct_difference("cost_per_tonne_km", "own_history_baseline")
    peer = pct_difference("cost_per_tonne_km", "similar_route_baseline")
    return f"""
SELECT *, anomaly_own_history OR anomaly_similar_routes AS is_candidate_anomaly FROM (
SELECT *, coalesce(vs_own_history_pct >= {settings.THRESHOLD_PCT}, false) AS anomaly_own_history,
       coalesce(vs_similar_routes_pct >= {settings.THRESHOLD_PCT}, false) AS anomaly_similar_routes FROM (
SELECT *, {own} AS vs_own_history_pct, {peer} AS vs_similar_routes_pct FROM (
SELECT *, avg(cost_per_tonne_km) OVER (PARTITION BY route ORDER BY week_of
           ROWS BETWEEN {settings.HISTORY_WEEKS} PRECEDING AND 1 PRECEDING) AS own_history_baseline,
       (sum(cost_per_tonne_km) OVER peers - cost_per_tonne_km)
           / nullif(count(*) OVER peers - 1, 0) AS similar_route_baseline
FROM {source} WINDOW peers AS (PARTITION BY week_of, route_type))))"""


CTES["scored"] = _scored("weekly")
CTES["scored_days"] = _scored("daily")
CTES["candidates"] = "SELECT * FROM scored WHERE is_candidate_anomaly"

CTES["notes"] = f"""
SELECT 'D' || CASE WHEN doc_id > 999999 THEN CAST(doc_id AS VARCHAR)
                   ELSE lpad(CAST(doc_id AS VARCHAR), 6, '0') END AS note_id,
       DATE '1995-01-02' + CAST(doc_id * 7919 % 2490 AS INTEGER) AS date,
       CASE WHEN doc_id % 26 = 25 THEN 'All Routes' ELSE ra.r_name || '-' || rb.r_name END AS applies_to,
       [{", ".join(quote(s) for s in NOTE_SENTENCES)}][doc_id % 10 + 1] || ' ' || text AS note
FROM documents
LEFT JOIN region ra ON ra.r_regionkey = (doc_id % 26) // 5
LEFT JOIN region rb ON rb.r_regionkey = (doc_id % 26) % 5"""

CTES["labeled"] = """
SELECT 'E' || note_id AS case_id,
       CASE WHEN k % 3 = 0 OR applies_to = 'All Routes'
            THEN (SELECT min(r_name) || '-' || max(r_name) FROM region) ELSE applies_to END AS route,
       CAST(date_trunc('week', date) AS DATE) + CAST(7 * (k % 4 - 1) AS INTEGER) AS week_of,
       CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'missing' ELSE note_id END AS note_id,
       (k % 10) IN (0, 1, 2, 9) AS expected_valid,
       CASE WHEN (k % 10) IN (0, 1, 2, 9) THEN 'justified' ELSE 'unexplained' END AS expected_verdict,
       'derived' AS description
FROM (SELECT *, CAST(substr(note_id, 2) AS BIGINT) AS k FROM notes)"""

CTES["flagged_notes"] = f"""
SELECT *, {has_any("note", settings.POSITIVE_PATTERNS)} AS positive_evidence,
       {has_any("note", settings.NEGATIVE_PATTERNS)} AS negative_evidence
FROM notes"""

CTES["note_documents"] = f"""
SELECT 'context_' || note_id AS document_id, note_id, date AS note_date, applies_to,
       {fill(settings.NOTE_DOC_FORMAT, "note_id", "CAST(date AS VARCHAR)", "applies_to", strip("note"))} AS text
FROM notes"""

CTES["flagged_docs"] = f"""
SELECT *, {has_any("text", settings.POSITIVE_PATTERNS)} AS positive_evidence,
       {has_any("text", settings.NEGATIVE_PATTERNS)} AS negative_evidence,
       {strip("substr(sentence, 1, 60)")} || CASE WHEN length(sentence) > 60 THEN '...' ELSE '' END AS snippet
FROM (SELECT *, split_part(split_part(text, '{settings.NOTE_MARKER}', 2), '.', 1) AS sentence
      FROM note_documents)"""

_PAIR_FLAGS = f"""coalesce(trim(applies_to) = trim(route) OR lower(trim(applies_to)) = '{settings.ALL_ROUTES}', false) AS route_match,
       coalesce(abs(note_date - week_of) <= {settings.NOTE_WINDOW_DAYS}, false) AS date_match"""

CTES["candidate_queries"] = f"""
SELECT route || '|' || CAST(week_of AS VARCHAR) AS query_id, route, week_of,
       {fill(settings.QUERY_FORMAT, "route", "CAST(week_of AS VARCHAR)", "printf('%.6f', cost_per_tonne_km)")} AS text
FROM candidates"""


def lexical_ctes(docs: str, queries: str | None = None, k: int = 10, pad: bool = False) -> dict:
    """Index of `docs` and the `k` best BM25 hits of `queries` as CTE `lexical`."""
    out = {
        "lengths": f"SELECT document_id, CAST(len({tokenized('text')}) AS BIGINT) AS length FROM {docs}",
        "stats": "SELECT count(*) AS n, avg(length) AS a FROM lengths",
        "postings": f"""SELECT document_id, term, count(*) AS tf
FROM (SELECT document_id, unnest({tokenized("text")}) AS term FROM {docs}) GROUP BY ALL""",
        "dfs": "SELECT term, count(*) AS df FROM postings GROUP BY term",
        "raw_idf": "SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM dfs, stats",
        "idf": "SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raw_idf) ELSE raw END AS idf FROM raw_idf",
    }
    if queries is None:
        return out
    out["qterms"] = f"""SELECT query_id, term, count(*) AS qtf
FROM (SELECT query_id, unnest({tokenized("text")}) AS term FROM {queries}) GROUP BY ALL"""
    out["bm25"] = """SELECT query_id, document_id,
       round(sum(qtf * (idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * length / a)))), 8) AS score
FROM qterms JOIN postings USING (term) JOIN idf USING (term) JOIN lengths USING (document_id), stats
GROUP BY query_id, document_id"""
    source = "bm25"
    if pad:
        out["padded"] = f"""SELECT * FROM bm25 UNION ALL
SELECT query_id, document_id, 0.0 FROM (SELECT DISTINCT query_id FROM qterms),
       (SELECT document_id FROM {docs}) d
WHERE NOT EXISTS (SELECT 1 FROM bm25 b WHERE b.query_id = qterms.query_id AND b.document_id = d.document_id)"""
        out["padded"] = out["padded"].replace(
            "(SELECT DISTINCT query_id FROM qterms)", "(SELECT DISTINCT query_id FROM qterms) qterms"
        )
        source = "padded"
    out["lexical"] = ranked(source, "score", k)
    return out


def ranked(source: str, score: str, k: int) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id
    ORDER BY {score} DESC, document_id) AS rank FROM {source}) WHERE rank <= {k}"""


def encode_ctes(source: str, key: str, name: str) -> dict:
    """Signed feature hashing of `source` texts into 64 cells, as CTE `name`."""
    return {
        f"{name}_cells": f"""SELECT {key}, CAST(concat('0x', substr(md5(token), 1, 8)) AS BIGINT) % 64 AS bucket,
       sum(1 - 2 * (CAST(concat('0x', substr(md5(token), 9, 1)) AS BIGINT) % 2)) AS v
FROM (SELECT {key}, unnest({tokenized("text")}) AS token FROM {source}) GROUP BY ALL""",
        f"{name}_norms": f"SELECT {key}, sqrt(sum(v * v)) AS norm FROM {name}_cells GROUP BY {key}",
        f"{name}_long": f"""SELECT s.{key}, b.bucket,
       CAST(CASE WHEN norm > 0 THEN coalesce(v, 0) / norm ELSE 0 END AS FLOAT) AS value
FROM {source} s CROSS JOIN (SELECT unnest(range(64)) AS bucket) b
LEFT JOIN {name}_norms n ON n.{key} = s.{key}
LEFT JOIN {name}_cells c ON c.{key} = s.{key} AND c.bucket = b.bucket""",
        name: f"SELECT {key}, list(value ORDER BY bucket) AS embedding FROM {name}_long GROUP BY {key}",
    }


def dense_ctes(queries: str, vectors: str, k: int) -> dict:
    return {
        "cosine": f"""SELECT query_id, document_id,
       round(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 8) AS score
FROM {queries} q, {vectors} d""",
        "nearest": ranked("cosine", "score", k),
    }


def _scaled(score: str) -> str:
    low, high = (f"{f}({score}) OVER (PARTITION BY query_id)" for f in ("min", "max"))
    return (
        f"CASE WHEN abs({low} - {high}) <= 1e-8 + 1e-5 * abs({high}) THEN 1.0 "
        f"ELSE ({score} - {low}) / ({high} - {low}) END"
    )


HYBRID = {
    "merged": """SELECT query_id, document_id, coalesce(n.score, 0.0) AS dense_score,
       coalesce(l.score, 0.0) AS lexical_score
FROM nearest n FULL JOIN lexical l USING (query_id, document_id)""",
    "scaled": f"""SELECT *, {_scaled("dense_score")} AS dense_scaled,
       {_scaled("lexical_score")} AS lexical_scaled FROM merged""",
    "hybrid_all": f"""SELECT *, round({settings.DENSE_WEIGHT} * dense_scaled
       + {settings.LEXICAL_WEIGHT} * lexical_scaled, 8) AS hybrid_score FROM scaled""",
    "hybrid": ranked("hybrid_all", "hybrid_score", settings.TOP_K),
}


def bigram_list(tokens: str) -> str:
    return (
        f"list_transform(range(1, len({tokens})), lambda i: {tokens}[i] || ' ' || {tokens}[i + 1])"
    )


def rerank_ctes(queries: str, docs: str) -> dict:
    return {
        "qweights": """SELECT query_id, term,
       ln(1 + (n - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5)) AS w
FROM qterms LEFT JOIN dfs USING (term), stats""",
        "coverage": """SELECT h.query_id, h.document_id,
       coalesce(sum(CASE WHEN p.term IS NOT NULL THEN w END), 0.0) / sum(w) AS coverage
FROM hybrid h JOIN qweights q USING (query_id)
LEFT JOIN postings p ON p.document_id = h.document_id AND p.term = q.term
GROUP BY h.query_id, h.document_id""",
        "query_pairs": f"""SELECT query_id, list_distinct({bigram_list("t")}) AS asked
FROM (SELECT query_id, {tokenized("text")} AS t FROM {queries})""",
        "doc_pairs": f"""SELECT document_id, {bigram_list("t")} AS found
FROM (SELECT document_id, {tokenized("text")} AS t FROM {docs}
      WHERE document_id IN (SELECT document_id FROM hybrid))""",
        "reranked_all": """SELECT query_id, document_id,
       round(coalesce(coverage, 0.0) + 0.5 * (len(list_intersect(asked, found)) / greatest(len(asked), 1)), 8) AS rerank_score
FROM hybrid LEFT JOIN coverage USING (query_id, document_id)
JOIN query_pairs USING (query_id) JOIN doc_pairs USING (document_id)""",
        "reranked": ranked("reranked_all", "rerank_score", settings.TOP_K),
    }


def prefixed(ctes: dict, prefix: str) -> dict:
    """The same CTEs under names of their own."""
    names = "|".join(ctes)
    return {prefix + k: re.sub(rf"\b({names})\b", rf"{prefix}\1", sql) for k, sql in ctes.items()}


_USABLE = "positive_evidence AND NOT negative_evidence"
CTES |= prefixed(
    {
        **{k: v for k, v in lexical_ctes("note_documents", "candidate_queries").items()
           if k in ("lengths", "stats", "postings", "dfs", "qterms")},
        "hybrid": f"""
SELECT * FROM (
SELECT q.query_id, q.route, q.week_of, n.document_id, row_number() OVER (
    PARTITION BY q.route, q.week_of, lower(n.applies_to) = '{settings.ALL_ROUTES}'
    ORDER BY ({_USABLE}) DESC, abs(note_date - q.week_of), note_id) AS place
FROM candidate_queries q JOIN flagged_docs n
  ON abs(n.note_date - q.week_of) <= {settings.NOTE_WINDOW_DAYS}
 AND (n.applies_to = q.route OR lower(n.applies_to) = '{settings.ALL_ROUTES}'))
WHERE place <= {settings.TOP_K}""",
        **{k: v for k, v in rerank_ctes("candidate_queries", "note_documents").items() if k != "reranked"},
    },
    "pre_",
)
CTES["evidence_pre"] = f"""
SELECT * FROM (
SELECT route, week_of, note_id, note_date, applies_to, snippet, true AS route_match, true AS date_match,
       positive_evidence, negative_evidence, {_USABLE} AS evidence_valid, rerank_score,
       row_number() OVER (PARTITION BY route, week_of
           ORDER BY ({_USABLE}) DESC, rerank_score DESC, abs(note_date - week_of), note_id) AS rank
FROM pre_hybrid JOIN pre_reranked_all USING (query_id, document_id) JOIN flagged_docs USING (document_id))
WHERE rank <= {settings.TOP_K}"""

POST = {
    **lexical_ctes("note_documents", "candidate_queries", settings.CANDIDATE_K, pad=True),
    **encode_ctes("note_documents", "document_id", "doc_vectors"),
    **encode_ctes("candidate_queries", "query_id", "query_vectors"),
    **dense_ctes("query_vectors", "doc_vectors", settings.CANDIDATE_K),
    **HYBRID,
    **rerank_ctes("candidate_queries", "note_documents"),
    "evidence_post": f"""
SELECT *, route_match AND date_match AND positive_evidence AND NOT negative_evidence AS evidence_valid FROM (
SELECT route, week_of, rank, note_id, note_date, applies_to, snippet, {_PAIR_FLAGS},
       positive_evidence, negative_evidence, rerank_score, hybrid_score, dense_score, lexical_score
FROM reranked JOIN hybrid_all USING (query_id, document_id) JOIN candidate_queries USING (query_id)
JOIN flagged_docs USING (document_id))""",
}


def best_cte(evidence: str) -> str:
    return f"""
SELECT route, week_of, min(struct_pack(rank, note_id, note_date, snippet)) FILTER (evidence_valid) AS valid,
       min(struct_pack(rank, note_id, note_date, snippet)) AS closest
FROM {evidence} GROUP BY route, week_of"""


def _known(p: str) -> str:
    return f"CASE WHEN {p} IS NULL THEN 'not known' ELSE {signed_percent(p)} || '%' END"


EXPLANATION = (
    "'Note ' || note_id || ', dated ' || CAST(note_date AS VARCHAR) || ', reports \"' || snippet"
    " || '\". It supports the cost rise on ' || route || ' in the week of ' || CAST(week_of AS VARCHAR)"
    f" || ' (own history ' || {_known('vs_own_history_pct')} || ', similar routes '"
    f" || {_known('vs_similar_routes_pct')} || ').'"
)

VERDICTS = {
    "decided": f"""
SELECT *, chosen.note_id AS note_id, chosen.note_date AS note_date, chosen.snippet AS snippet FROM (
SELECT s.*, CASE WHEN NOT is_candidate_anomaly THEN '{settings.NORMAL}'
            WHEN valid IS NOT NULL THEN '{settings.JUSTIFIED}' ELSE '{settings.UNEXPLAINED}' END AS flagged,
       CASE WHEN is_candidate_anomaly THEN coalesce(valid, closest) END AS chosen
FROM scored s LEFT JOIN best b ON b.route = s.route AND b.week_of = s.week_of)""",
    "verdicts": f"""
SELECT *, CASE WHEN flagged = '{settings.JUSTIFIED}' THEN note_id END AS matched_note_id,
       CASE WHEN flagged = '{settings.NORMAL}' THEN {quote(settings.NORMAL_REASON)}
            WHEN flagged = '{settings.JUSTIFIED}' THEN {EXPLANATION}
            WHEN note_id IS NULL THEN {quote(settings.NO_NOTE_REASON)}
            ELSE {fill(settings.REJECTED_NOTE_REASON, "note_id", "CAST(note_date AS VARCHAR)", "snippet")} END AS reason
FROM decided""",
    "results": f"""
SELECT route, CAST(week_of AS VARCHAR) AS week_of,
       round_even(cost_per_tonne_km * 100, 0) / 100 AS cost_per_tonne_km,
       {comparison("vs_own_history_pct", settings.OWN_HISTORY_PHRASE)} AS vs_own_history,
       {comparison("vs_similar_routes_pct", settings.SIMILAR_ROUTES_PHRASE)} AS vs_similar_routes,
       flagged, coalesce(matched_note_id, '') AS matched_note_id, reason
FROM verdicts""",
}

ROUTE_WEEKS = ["shipments", "prepared", "weekly", "scored"]
CANDIDATES = [*ROUTE_WEEKS, "candidates"]
NOTE_DOCS = ["notes", "note_documents"]
PRE = [
    *CANDIDATES, "candidate_queries", *NOTE_DOCS, "flagged_docs", *[c for c in CTES if c.startswith("pre_")], "evidence_pre",
]


def build(names: list[str], final: str, *more: dict) -> str:
    ctes = {name: CTES[name] for name in names}
    for extra in more:
        ctes |= extra
    if not ctes:
        return final
    return (
        "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in ctes.items()) + "\n" + final
    )


RESULTS = (PRE, {"best": best_cte("evidence_pre"), **VERDICTS})


def on_results(final: str, names: list[str] | None = None, *more: dict) -> str:
    return build([*RESULTS[0], *(names or [])], final, RESULTS[1], *more)


def checks(source: str, conditions: dict[str, str], part: str | None = None) -> str:
    rows = [("empty", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END")]
    rows += [(n, f"count(*) FILTER ({c})") for n, c in conditions.items()]
    tail = f", '{part}' AS part" if part else ""
    return " UNION ALL ".join(
        f'SELECT \'{n}\' AS "check", CAST({c} AS BIGINT) AS violations{tail} FROM {source}'
        for n, c in rows
    )


def missing(columns: list[str]) -> dict[str, str]:
    return {f"missing_{c}": f"{c} IS NULL" for c in columns}


def rounded(columns: str, decimals: int = 6) -> str:
    return ", ".join(f"round({c}, {decimals}) AS {c}" for c in columns.split())


_OWN = f"route, week_of, {rounded('cost_per_tonne_km own_history_baseline vs_own_history_pct')}"
_PEER = rounded("similar_route_baseline vs_similar_routes_pct")
_FLAGS = "anomaly_own_history, anomaly_similar_routes, is_candidate_anomaly"
_EVIDENCE = (
    "route, week_of, rank, note_id, note_date, applies_to, snippet, route_match, date_match, "
    "positive_evidence, negative_evidence, evidence_valid"
)

_SPOILT = """
SELECT * REPLACE (
    CASE month(week_of) WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN 'nan'::DOUBLE ELSE cost_per_tonne_km END AS cost_per_tonne_km,
    CASE WHEN month(week_of) = 3 THEN 0.0 ELSE total_tonne_km END AS total_tonne_km,
    coalesce(own_history_baseline, 0.0) AS own_history_baseline,
    CASE WHEN month(week_of) = 4 THEN 0.0 ELSE similar_route_baseline END AS similar_route_baseline,
    CASE WHEN month(week_of) = 5 THEN false ELSE is_candidate_anomaly END AS is_candidate_anomaly),
    row_number() OVER (PARTITION BY route ORDER BY week_of) AS position
FROM scored"""

_LABEL_EVAL = f"""
SELECT case_id, l.route, l.week_of, coalesce(l.note_id, '') AS note_id, expected_valid, actual_valid,
       expected_verdict, CASE WHEN actual_valid THEN 'justified' ELSE 'unexplained' END AS actual_verdict,
       note_found,
       actual_valid = expected_valid
         AND CASE WHEN actual_valid THEN 'justified' ELSE 'unexplained' END = expected_verdict AS passed,
       description
FROM (SELECT l.*, n.note_id IS NOT NULL AS note_found,
             coalesce((lower(n.applies_to) = '{settings.ALL_ROUTES}' OR lower(n.applies_to) = lower(l.route))
               AND abs(n.date - l.week_of) <= {settings.NOTE_WINDOW_DAYS}
               AND positive_evidence AND NOT negative_evidence, false) AS actual_valid
      FROM labeled l LEFT JOIN flagged_notes n ON n.note_id = l.note_id) l"""

_COMPARED = settings.COMPARED_COLUMNS


def _run_diff(pair: str, a: str, b: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{pair}' AS pair, (SELECT count(*) FROM {a}) AS rows_a, (SELECT count(*) FROM {b}) AS rows_b,
       '{c}' AS "column", count(*) FILTER (a.route IS NULL OR b.route IS NULL OR a.{c} IS DISTINCT FROM b.{c}) AS differences
FROM {a} a FULL JOIN {b} b ON a.route = b.route AND a.week_of = b.week_of"""
        for c in _COMPARED
    )


def _tfidf_ctes(docs: str) -> dict:
    stop = ", ".join(quote(w) for w in STOP_WORDS)

    def grams(source: str, key: str) -> str:
        words = f"list_filter(regexp_extract_all(lower(text), '{WORD_TOKEN}'), lambda w: w NOT IN ({stop}))"
        return f"""SELECT {key}, term, count(*) AS tf FROM (
SELECT {key}, unnest(list_concat(w, {bigram_list("w")})) AS term
FROM (SELECT {key}, {words} AS w FROM {source})) GROUP BY ALL"""

    return {
        "questions": "SELECT conv_id * 1000 + turn AS query_id, text FROM conversations WHERE role = 'user'",
        "grams": grams(docs, "document_id"),
        "gram_idf": f"SELECT term, ln((1 + (SELECT count(*) FROM {docs})) / (1 + count(*))) + 1 AS idf FROM grams GROUP BY term",
        "doc_weights": "SELECT document_id, term, tf * idf AS w FROM grams JOIN gram_idf USING (term)",
        "doc_norms": "SELECT document_id, sqrt(sum(w * w)) AS norm FROM doc_weights GROUP BY document_id",
        "question_grams": grams("questions", "query_id"),
        "question_weights": "SELECT query_id, term, tf * idf AS w FROM question_grams JOIN gram_idf USING (term)",
        "question_norms": "SELECT query_id, sqrt(sum(w * w)) AS norm FROM question_weights GROUP BY query_id",
        "cosines": """SELECT query_id, document_id, round(sum(q.w / qn.norm * (d.w / dn.norm)), 8) AS score
FROM question_weights q JOIN question_norms qn USING (query_id)
JOIN doc_weights d USING (term) JOIN doc_norms dn USING (document_id)
GROUP BY query_id, document_id""",
        "question_hits": ranked("cosines", "score", settings.QUESTION_TOP_K) + " AND score > 0",
    }


CORPUS = {"corpus": "SELECT doc_id AS document_id, text FROM documents"}
PASSAGES = {"passages": "SELECT item_id AS query_id, text FROM benchmark"}
VECTORS = encode_ctes("passages", "query_id", "passage_vectors") | encode_ctes(
    "corpus", "document_id", "document_vectors"
)
PASSAGE_HYBRID = (
    CORPUS,
    PASSAGES,
    lexical_ctes("corpus", "passages", settings.CANDIDATE_K, pad=True),
    VECTORS,
    dense_ctes("passage_vectors", "document_vectors", settings.CANDIDATE_K),
    HYBRID,
)
_CONTAINED = "SELECT query_id, document_id FROM passages p JOIN corpus d ON contains(d.text, p.text)"
_PROMPT_LINES = " || chr(10) || ".join


def _prompt_percent(p: str) -> str:
    return f"CASE WHEN {p} IS NULL THEN 'N/A' ELSE printf('%.1f', {p}) || '%' END"


def _grounded() -> str:
    from costwatch.operators.explain import GROUND_RULES

    lines = [
        quote(GROUND_RULES),
        "'Route: ' || route",
        "'Week: ' || CAST(week_of AS VARCHAR)",
        "'Cost per tonne-km: ' || printf('%.2f', cost_per_tonne_km)",
        f"'Against own history: ' || {_prompt_percent('vs_own_history_pct')}",
        f"'Against similar routes: ' || {_prompt_percent('vs_similar_routes_pct')}",
        "'Note id: ' || v.note_id",
        "'Note date: ' || CAST(v.note_date AS VARCHAR)",
        "'Note: ' || d.text",
    ]
    return f"""SELECT route, week_of, v.note_id, v.reason, {_PROMPT_LINES(lines)} AS prompt
FROM verdicts v JOIN note_documents d ON d.note_id = v.note_id WHERE flagged = '{settings.JUSTIFIED}'"""


_USAGE = f"""
SELECT model, llm_calls, input_tokens, output_tokens, input_tokens + output_tokens AS total_tokens,
       CAST({settings.INPUT_PRICE_PER_MILLION} AS DOUBLE) AS input_price_per_million,
       CAST({settings.OUTPUT_PRICE_PER_MILLION} AS DOUBLE) AS output_price_per_million,
       round(input_tokens / 1e6 * {settings.INPUT_PRICE_PER_MILLION}, 8) AS estimated_input_cost,
       round(output_tokens / 1e6 * {settings.OUTPUT_PRICE_PER_MILLION}, 8) AS estimated_output_cost,
       round(input_tokens / 1e6 * {settings.INPUT_PRICE_PER_MILLION}
           + output_tokens / 1e6 * {settings.OUTPUT_PRICE_PER_MILLION}, 8) AS estimated_total_cost
FROM (SELECT 'm' || CAST(conv_id % 3 AS VARCHAR) AS model, count(DISTINCT conv_id) AS llm_calls,
             CAST(coalesce(sum(words) FILTER (role <> 'assistant'), 0) AS BIGINT) AS input_tokens,
             CAST(coalesce(sum(words) FILTER (role = 'assistant'), 0) AS BIGINT) AS output_tokens
      FROM (SELECT *, len(regexp_extract_all(text, '\\S+')) AS words FROM conversations)
      GROUP BY model)"""

_FINDING = fill(
    settings.FINDING_FORMAT,
    "route",
    "week_of",
    "CAST(cost_per_tonne_km AS VARCHAR)",
    "vs_own_history",
    "vs_similar_routes",
    "flagged",
    "matched_note_id",
    "reason",
)
_QA_NOTE = fill(
    settings.QA_NOTE_FORMAT, "note_id", "CAST(date AS VARCHAR)", "applies_to", "note"
)
_QA_CORPUS = f"""
SELECT 'finding|' || route || '|' || week_of AS document_id, {_FINDING} AS text,
       'finding' AS source_type, route, week_of, matched_note_id AS note_id FROM results
UNION ALL
SELECT 'context_note|' || note_id, {_QA_NOTE}, 'context_note', applies_to, CAST(date AS VARCHAR), note_id
FROM notes"""

_REPORT_PCT = r"""CASE WHEN regexp_extract({c}, '[+-]?\d+\.?\d*%') <> '' THEN regexp_extract({c}, '[+-]?\d+\.?\d*%') ELSE {c} END"""


def _report_pct(c: str) -> str:
    return _REPORT_PCT.format(c=c)


def _number(c: str) -> str:
    return rf"TRY_CAST(regexp_extract({c}, '[-+]?\d+(?:\.\d+)?') AS DOUBLE)"


_STATUS = (
    "CASE flagged "
    + " ".join(f"WHEN '{v}' THEN '{t}'" for v, t in settings.STATUS_LABELS.items())
    + " END"
)

_INVESTIGATION = f"""
SELECT r.route, r.week_of, {_STATUS} AS status, cost_per_tonne_km,
       {_number(_report_pct("vs_own_history"))} AS own_history_pct,
       {_number(_report_pct("vs_similar_routes"))} AS similar_routes_pct,
       reason, nullif(matched_note_id, '') AS note_id, n.date AS note_date, n.applies_to, n.note,
       CASE WHEN matched_note_id <> '' THEN coalesce(lower(n.applies_to) IN (lower(r.route), '{settings.ALL_ROUTES}'), false) END AS route_ok,
       CASE WHEN matched_note_id <> '' THEN coalesce(abs(n.date - CAST(r.week_of AS DATE)) <= {settings.NOTE_WINDOW_DAYS}, false) END AS date_ok,
       CASE WHEN matched_note_id <> '' THEN coalesce(positive_evidence AND NOT negative_evidence, false) END AS cost_ok
FROM results r LEFT JOIN flagged_notes n ON n.note_id = r.matched_note_id
WHERE flagged <> '{settings.NORMAL}'"""

_TYPED_RESULTS = "* REPLACE (CAST(week_of AS DATE) AS week_of)"


def oracle_sql() -> dict[str, str]:
    summary = f"""
SELECT count(*) AS route_weeks, count(*) FILTER (flagged <> '{settings.NORMAL}') AS anomalies,
       count(*) FILTER (flagged = '{settings.JUSTIFIED}') AS justified,
       count(*) FILTER (flagged = '{settings.UNEXPLAINED}') AS unexplained,
       count(*) FILTER (flagged = '{settings.NORMAL}') AS normal FROM results"""
    changed = """SELECT * REPLACE (CASE WHEN month(CAST(week_of AS DATE)) = 3 THEN 'Yes' ELSE flagged END AS flagged,
       cost_per_tonne_km + CASE WHEN month(CAST(week_of AS DATE)) = 7 THEN 1.0 ELSE 0.0 END AS cost_per_tonne_km)
FROM results WHERE month(CAST(week_of AS DATE)) <> 12"""
    diff = f"""SELECT *, rows_a = rows_b AND differences = 0 AS passed,
       bool_and(rows_a = rows_b AND differences = 0) OVER () AS all_passed
FROM ({_run_diff("1 vs 2", "results", "results")} UNION ALL {_run_diff("2 vs 3", "results", "changed")})"""
    spoilt = {"spoilt": _SPOILT}
    label_summary = build(
        ["notes", "flagged_notes", "labeled"],
        """SELECT count(*) AS total_cases, count(*) FILTER (passed) AS passed_cases,
       count(*) FILTER (NOT passed) AS failed_cases,
       round_even(count(*) FILTER (passed) / count(*), 4) AS pass_rate FROM evaluated""",
        {"evaluated": _LABEL_EVAL},
    )
    tfidf = _tfidf_ctes("corpus")
    return {
        "shipments_prepared": build(
            ["shipments", "prepared"],
            """SELECT * REPLACE (round(CAST(freight_cost_inr AS DOUBLE), 6) AS freight_cost_inr),
            round(quantity_tonnes * distance_km, 6) AS tonne_km FROM prepared""",
        ),
        "shipment_profile": build(
            ["shipments", "prepared"],
            "SELECT count(*) AS n_rows, count(DISTINCT route) AS n_routes, count(DISTINCT week_of) AS n_weeks FROM prepared",
        ),
        "shipment_checks": build(
            ["shipments", "bad_shipments"],
            checks(
                "bad_shipments",
                missing(settings.SHIPMENT_REQUIRED)
                | {
                    "quantity_not_positive": "quantity_tonnes <= 0",
                    "distance_not_positive": "distance_km <= 0",
                    "freight_negative": "freight_cost_inr < 0",
                },
            ),
        ),
        "prepared_checks": build(
            ["shipments", "bad_shipments"],
            checks(
                "bad_shipments",
                {
                    "missing_route": "origin IS NULL OR destination IS NULL",
                    "missing_week": "shipment_date IS NULL",
                    "week_not_monday": "isodow(date_trunc('week', shipment_date)) <> 1",
                },
            ),
        ),
        "note_checks": build(
            ["notes"],
            checks(
                "(SELECT * REPLACE (CASE WHEN CAST(substr(note_id, 2) AS BIGINT) % 17 <> 0 THEN applies_to END AS applies_to) FROM notes)",
                missing(settings.NOTE_COLUMNS),
            ),
        ),
        "weekly_checks": build(
            ROUTE_WEEKS,
            checks(
                "spoilt",
                {
                    "cost_missing": "cost_per_tonne_km IS NULL OR isnan(cost_per_tonne_km)",
                    "cost_infinite": "isinf(cost_per_tonne_km)",
                    "tonne_km_not_positive": "total_tonne_km <= 0",
                },
                "metrics",
            )
            + " UNION ALL "
            + checks(
                "spoilt",
                {
                    "first_week_has_baseline": "position = 1 AND own_history_baseline IS NOT NULL",
                    "own_baseline_not_positive": "own_history_baseline <= 0",
                    "peer_baseline_not_positive": "similar_route_baseline <= 0",
                },
                "baselines",
            )
            + " UNION ALL "
            + checks(
                "spoilt",
                {
                    "flag_missing": "is_candidate_anomaly IS NULL",
                    "candidate_not_or": "is_candidate_anomaly <> (anomaly_own_history OR anomaly_similar_routes)",
                },
                "flags",
            ),
            spoilt,
        ),
        "weekly_metrics": build(
            ["shipments", "prepared", "weekly"],
            "SELECT route, week_of, route_type, shipment_count, "
            + rounded(
                "total_quantity_tonnes total_distance_km total_tonne_km total_freight_cost_inr cost_per_tonne_km"
            )
            + " FROM weekly",
        ),
        "own_history": build(ROUTE_WEEKS, f"SELECT {_OWN} FROM scored"),
        "first_weeks": build(
            ["shipments", "prepared", "weekly"],
            f"""SELECT route, week_of, {rounded("cost_per_tonne_km")} FROM weekly w
WHERE week_of = (SELECT min(week_of) FROM weekly v WHERE v.route = w.route)""",
        ),
        "peer_baseline": build(
            ROUTE_WEEKS,
            f"SELECT route, week_of, route_type, {rounded('cost_per_tonne_km')}, {_PEER} FROM scored",
        ),
        "anomalies": build(ROUTE_WEEKS, f"SELECT {_OWN}, {_PEER}, {_FLAGS} FROM scored"),
        "candidates": build(CANDIDATES, f"SELECT {_OWN}, {_PEER} FROM candidates"),
        "event_daily_anomalies": build(
            ["daily", "scored_days"],
            f"SELECT {_OWN}, {_PEER}, shipment_count, {_FLAGS} FROM scored_days",
        ),
        "evidence_flags": build(
            ["notes", "flagged_notes"],
            "SELECT note_id, applies_to, positive_evidence, negative_evidence FROM flagged_notes",
        ),
        "retrieve_evidence_pre": build(PRE, f"SELECT {_EVIDENCE}, {rounded('rerank_score')} FROM evidence_pre"),
        "retrieve_evidence_post": build(
            [*CANDIDATES, "candidate_queries", *NOTE_DOCS, "flagged_docs"],
            f"SELECT {_EVIDENCE}, {rounded('rerank_score hybrid_score dense_score lexical_score')} FROM evidence_post",
            POST,
        ),
        "first_valid_note": build(
            PRE,
            "SELECT route, week_of, valid.note_id AS valid_note_id, closest.note_id AS closest_note_id, closest.note_date AS closest_note_date FROM best",
            {"best": best_cte("evidence_pre")},
        ),
        "verdicts": on_results(
            "SELECT route, week_of, flagged, matched_note_id, note_id, note_date, snippet FROM verdicts"
        ),
        "results_shaped": on_results("SELECT * FROM results"),
        "route_week_results": build(
            [*CANDIDATES, "candidate_queries", *NOTE_DOCS, "flagged_docs"],
            "SELECT * FROM results",
            POST,
            {"best": best_cte("evidence_post")},
            VERDICTS,
        ),
        "verdict_summary": on_results(summary),
        "unexplained_by_route": on_results(
            f"SELECT route, count(*) AS unexplained FROM results WHERE flagged = '{settings.UNEXPLAINED}' GROUP BY route"
        ),
        "route_options": build(
            ["shipments", "prepared"], "SELECT DISTINCT route FROM prepared WHERE route IS NOT NULL"
        ),
        "report_view": on_results(
            f"""SELECT route, week_of, '₹' || printf('%.2f', cost_per_tonne_km) AS cost_per_tonne_km,
       {_report_pct("vs_own_history")} AS vs_own_history, {_report_pct("vs_similar_routes")} AS vs_similar_routes,
       {_STATUS} AS status, matched_note_id, reason FROM results"""
        ),
        "filtered_results": on_results(
            f"SELECT * FROM results WHERE route = 'ASIA-EUROPE' AND flagged = '{settings.UNEXPLAINED}'"
        ),
        "investigation": on_results(_INVESTIGATION, ["flagged_notes"]),
        "label_eval": build(["notes", "flagged_notes", "labeled"], _LABEL_EVAL),
        "label_eval_summary": label_summary,
        "roundtrip_labels": label_summary,
        "run_diff": on_results(diff, None, {"changed": changed}),
        "note_docs": build(NOTE_DOCS, "SELECT * FROM note_documents"),
        "qa_corpus": on_results(_QA_CORPUS),
        "retrieval_queries": build(
            [*CANDIDATES, "candidate_queries"], "SELECT * FROM candidate_queries"
        ),
        "tokens": build([], "SELECT document_id, term, tf FROM postings", CORPUS, lexical_ctes("corpus")),
        "document_bigrams": build(
            [],
            f"""SELECT document_id, CAST(len(b) AS BIGINT) AS n_bigrams, CAST(len(list_distinct(b)) AS BIGINT) AS n_distinct
FROM (SELECT document_id, {bigram_list("t")} AS b FROM (SELECT document_id, {tokenized("text")} AS t FROM corpus))""",
            CORPUS,
        ),
        "lexical_stats": build(
            [],
            """SELECT (SELECT n FROM stats) AS n_docs, CAST((SELECT sum(length) FROM lengths) AS BIGINT) AS n_tokens,
       round((SELECT a FROM stats), 6) AS avg_length, (SELECT count(*) FROM dfs) AS n_terms""",
            CORPUS,
            lexical_ctes("corpus"),
        ),
        "term_idf": build(
            [], f"SELECT term, df, {rounded('idf')} FROM idf", CORPUS, lexical_ctes("corpus")
        ),
        "bm25_topk": build(
            [],
            f"SELECT query_id, document_id, rank, {rounded('score')} FROM lexical",
            CORPUS,
            PASSAGES,
            lexical_ctes("corpus", "passages", 10),
        ),
        "tfidf_topk": build(
            [],
            f"SELECT query_id, document_id, rank, {rounded('score')} FROM question_hits",
            CORPUS,
            tfidf,
        ),
        "encode_hash": build(
            [],
            "SELECT document_id, bucket, round(CAST(value AS DOUBLE), 6) AS value FROM vectors_long",
            CORPUS,
            encode_ctes("corpus", "document_id", "vectors"),
        ),
        "dense_topk": build(
            [],
            f"SELECT query_id, document_id, rank, {rounded('score')} FROM nearest",
            {
                "asked": "SELECT vec_id AS query_id, embedding FROM embeddings",
                "held": "SELECT vec_id AS document_id, embedding FROM embeddings",
            },
            dense_ctes("asked", "held", 10),
        ),
        "minmax_scores": build(
            [],
            f"SELECT query_id, document_id, {rounded('dense_score lexical_score dense_scaled lexical_scaled hybrid_score')} FROM hybrid_all",
            *PASSAGE_HYBRID,
        ),
        "hybrid_topk": build(
            [],
            f"SELECT query_id, document_id, {rounded('hybrid_score')}, rank FROM hybrid",
            *PASSAGE_HYBRID,
        ),
        "rerank_topk": build(
            [],
            f"SELECT query_id, document_id, {rounded('rerank_score')}, rank FROM reranked",
            *PASSAGE_HYBRID,
            rerank_ctes("passages", "corpus"),
        ),
        "contained_passages": build([], _CONTAINED, CORPUS, PASSAGES),
        "retrieval_recall": build(
            [],
            """SELECT count(*) AS queries, count(*) FILTER (hit) AS found,
       round(count(*) FILTER (hit) / count(*), 4) AS recall
FROM (SELECT query_id, bool_or(l.document_id IS NOT NULL) AS hit
      FROM truth t LEFT JOIN lexical l USING (query_id, document_id) GROUP BY query_id)""",
            CORPUS,
            PASSAGES,
            lexical_ctes("corpus", "passages", 5),
            {"truth": _CONTAINED},
        ),
        "grounded_prompts": on_results(
            f"SELECT route, week_of, note_id, prompt FROM ({_grounded()})"
        ),
        "explanations": on_results(
            rf"""SELECT route, week_of, note_id, reason,
       CAST(len(regexp_extract_all(prompt, '\S+')) AS BIGINT) AS input_tokens,
       CAST(len(regexp_extract_all(reason, '\S+')) AS BIGINT) AS output_tokens FROM ({_grounded()})"""
        ),
        "usage_cost": _USAGE,
        "roundtrip_json": _USAGE,
        "roundtrip_csv": build(
            ["shipments", "notes"],
            """SELECT 'shipments' AS source, count(*) AS n_rows, count(DISTINCT shipment_id) AS n_ids,
       round(CAST(sum(freight_cost_inr) AS DOUBLE), 6) AS total, max(shipment_date) AS last_date FROM shipments
UNION ALL SELECT 'notes', count(*), count(DISTINCT note_id), CAST(sum(length(note)) AS DOUBLE), max(date) FROM notes
UNION ALL SELECT 'notes with their text', count(*), count(DISTINCT note_id), 0.0, max(date) FROM notes""",
        ),
        "roundtrip_reasons": build(
            ["notes"],
            """SELECT note_id AS route, date AS week_of,
       md5(' a "quoted", line' || chr(10) || note || chr(10) || 'last line ') AS digest FROM notes""",
        ),
        "roundtrip_indented": _USAGE,
        "roundtrip_evaluation": label_summary,
        "run_usage": on_results(_run_usage()),
        "bm25_padded": build(
            [],
            f"SELECT query_id, document_id, rank, {rounded('score')} FROM lexical",
            {
                "pages_of_text": "SELECT item_id AS document_id, text FROM benchmark",
                "questions": "SELECT conv_id * 1000 + turn AS query_id, text FROM conversations WHERE role = 'user'",
            },
            lexical_ctes("pages_of_text", "questions", 5, pad=True),
        ),
        "contained_words": build(
            [],
            """SELECT query_id, document_id FROM (
  SELECT query_id * 2 AS query_id, string_split(text, ' ')[1] AS text FROM passages UNION ALL
  SELECT query_id * 2 + 1, array_to_string(string_split(text, ' ')[2:3], ' ') FROM passages) p
JOIN corpus d ON contains(d.text, p.text)""",
            CORPUS,
            PASSAGES,
        ),
        "roundtrip_results": on_results(f"SELECT {_TYPED_RESULTS} FROM results"),
        "exported_view": on_results(
            f"SELECT {_TYPED_RESULTS} FROM results WHERE route = 'ASIA-EUROPE' AND flagged = '{settings.JUSTIFIED}'"
        ),
        "comparison_text": build(
            ROUTE_WEEKS,
            f"""SELECT route, week_of, {comparison("vs_own_history_pct", settings.OWN_HISTORY_PHRASE)} AS vs_own_history,
       {comparison("vs_similar_routes_pct", settings.SIMILAR_ROUTES_PHRASE)} AS vs_similar_routes FROM scored""",
        ),
        "qa_prompts": build([], _qa_prompts_sql(), CORPUS, tfidf),
        "question_answers": on_results(
            _answers_sql(), None, {"qa_docs": _QA_CORPUS}, _tfidf_ctes("qa_docs")
        ),
    }


def _run_usage() -> str:
    cost = lambda tokens, price: f"{tokens} / 1e6 * {price}"
    one = cost("input_tokens", settings.INPUT_PRICE_PER_MILLION)
    two = cost("output_tokens", settings.OUTPUT_PRICE_PER_MILLION)
    return rf"""
SELECT '{settings.DEFAULT_MODEL}' AS model, llm_calls, input_tokens, output_tokens,
       input_tokens + output_tokens AS total_tokens,
       CAST({settings.INPUT_PRICE_PER_MILLION} AS DOUBLE) AS input_price_per_million,
       CAST({settings.OUTPUT_PRICE_PER_MILLION} AS DOUBLE) AS output_price_per_million,
       round({one}, 8) AS estimated_input_cost, round({two}, 8) AS estimated_output_cost,
       round({one} + {two}, 8) AS estimated_total_cost
FROM (SELECT count(*) AS llm_calls,
             CAST(coalesce(sum(len(regexp_extract_all(prompt, '\S+'))), 0) AS BIGINT) AS input_tokens,
             CAST(coalesce(sum(len(regexp_extract_all(reason, '\S+'))), 0) AS BIGINT) AS output_tokens
      FROM ({_grounded()}))"""


def _answers_sql() -> str:
    from costwatch.operators.explain import ANSWER_RULES

    block = _PROMPT_LINES(
        [
            "'EVIDENCE ' || CAST(h.rank AS VARCHAR)",
            "'source_type: ' || source_type",
            "'route: ' || route",
            "'week_of: ' || week_of",
            "'note_id: ' || note_id",
            "d.text",
        ]
    )
    return rf"""
SELECT query_id, n_evidence, answer,
       CASE WHEN n_evidence > 0 THEN CAST(len(regexp_extract_all(
            {quote(ANSWER_RULES)} || chr(10) || 'QUESTION ' || question || chr(10) || blocks, '\S+')) AS BIGINT) ELSE 0 END AS input_tokens,
       CASE WHEN n_evidence > 0 THEN CAST(len(regexp_extract_all(answer, '\S+')) AS BIGINT) ELSE 0 END AS output_tokens
FROM (SELECT *, CASE WHEN n_evidence > 0 THEN 'Best of ' || CAST(n_evidence AS VARCHAR) || ' pieces of evidence: ' || best
                || CASE WHEN named <> '' THEN ' (' || named || ')' ELSE '' END || '.'
            ELSE {quote(settings.NO_EVIDENCE_ANSWER)} END AS answer FROM (
      SELECT q.query_id, any_value(q.text) AS question, count(h.document_id) AS n_evidence,
             min_by(h.document_id, h.rank) AS best, string_agg({block}, chr(10) ORDER BY h.rank) AS blocks,
             min_by(concat_ws(', ', CASE WHEN d.route <> '' THEN 'route ' || d.route END,
               CASE WHEN d.week_of <> '' THEN 'week ' || d.week_of END,
               CASE WHEN d.note_id <> '' THEN 'note ' || d.note_id END), h.rank) AS named
      FROM questions q LEFT JOIN question_hits h ON h.query_id = q.query_id
      LEFT JOIN qa_docs d ON d.document_id = h.document_id GROUP BY q.query_id))"""


def _qa_prompts_sql() -> str:
    from costwatch.operators.explain import ANSWER_RULES

    gap = "chr(10) || chr(10)"
    return f"""
SELECT q.query_id, count(h.document_id) AS n_evidence, CAST(min_by(h.document_id, h.rank) AS VARCHAR) AS best_document,
       CASE WHEN count(h.document_id) > 0 THEN md5(
         {quote(ANSWER_RULES)} || {gap} || 'QUESTION ' || any_value(q.text) || {gap}
         || string_agg('EVIDENCE ' || CAST(rank AS VARCHAR) || chr(10) || d.text, {gap} ORDER BY rank)) END AS prompt_md5
FROM questions q LEFT JOIN question_hits h ON h.query_id = q.query_id
LEFT JOIN corpus d ON d.document_id = h.document_id GROUP BY q.query_id"""
