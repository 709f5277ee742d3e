"""Tunable defaults and the fixed values that results depend on."""

# Defaults, all of them parameters of the operators that use them.
HISTORY_WEEKS = 8
THRESHOLD_PCT = 20.0
NOTE_WINDOW_DAYS = 7
TOP_K = 5
CANDIDATE_K = 10
QUESTION_TOP_K = 6
DENSE_WEIGHT = 0.6
LEXICAL_WEIGHT = 0.4
INPUT_PRICE_PER_MILLION = 0.15
OUTPUT_PRICE_PER_MILLION = 0.60

# Column names of the input tables.
SHIPMENT_COLUMNS = [
    "shipment_id",
    "origin",
    "destination",
    "route_type",
    "material",
    "quantity_tonnes",
    "distance_km",
    "freight_cost_inr",
    "shipment_date",
    "transporter",
]
SHIPMENT_REQUIRED = [
    "shipment_id",
    "origin",
    "destination",
    "route_type",
    "quantity_tonnes",
    "distance_km",
    "freight_cost_inr",
    "shipment_date",
]
NOTE_COLUMNS = ["note_id", "date", "applies_to", "note"]
LABELED_COLUMNS = [
    "case_id",
    "route",
    "week_of",
    "note_id",
    "expected_valid",
    "expected_verdict",
    "description",
]

# The result table and its verdicts.
RESULT_COLUMNS = [
    "route",
    "week_of",
    "cost_per_tonne_km",
    "vs_own_history",
    "vs_similar_routes",
    "flagged",
    "matched_note_id",
    "reason",
]
# Explanation wording may vary between runs, so `reason` is not compared.
COMPARED_COLUMNS = [c for c in RESULT_COLUMNS if c != "reason"]
NORMAL = "No"
JUSTIFIED = "No (justified)"
UNEXPLAINED = "Yes"
STATUS_LABELS = {
    UNEXPLAINED: "⚠ Needs Review",
    JUSTIFIED: "✓ Justified",
    NORMAL: "✓ Normal",
}

# Display phrases and sentences of the result table.
OWN_HISTORY_PHRASE = "vs this route's past average"
SIMILAR_ROUTES_PHRASE = "vs similar-length routes this week"
NORMAL_REASON = (
    "No significant cost increase detected against the configured anomaly threshold."
)
NO_NOTE_REASON = (
    "No matching note found for this route or date range. "
    "Cost rise looks unexplained and worth a human review."
)
# arguments: note id, note date, snippet of the note
REJECTED_NOTE_REASON = (
    'The closest note (%s, %s) mentions "%s" '
    "-- it does not describe a reason for a cost rise on this route. "
    "No genuine justification found; flagged for review."
)
NO_EVIDENCE_ANSWER = (
    "I could not find relevant evidence in the shipping findings or context notes."
)

# Text formats that retrieval scores depend on.
# arguments: note id, date, applies to, note
NOTE_DOC_FORMAT = "Note ID: %s. Date: %s. Applies to: %s. Context: %s"
NOTE_MARKER = "Context: "
# arguments: note id, date, applies to, note
QA_NOTE_FORMAT = "Context note %s. Date: %s. Applies to: %s. Note: %s"
# arguments: route, week, cost, own comparison, similar comparison, verdict, note id, reason
FINDING_FORMAT = (
    "Route: %s. Week: %s. Cost per tonne-km: %s. "
    "Comparison with own history: %s. Comparison with similar routes: %s. "
    "Verdict: %s. Matched note: %s. Reason: %s."
)
# arguments: route, week, cost with six decimals
QUERY_FORMAT = (
    "shipping cost increase for route %s during week %s cost per tonne-km %s "
    "possible freight cost surcharge fuel toll weather "
    "festival demand truck availability disruption"
)
ALL_ROUTES = "all routes"

# Evidence patterns, searched in normalised text. A note is evidence of a
# cost rise when a positive pattern is found and no negative one is.
POSITIVE_PATTERNS = [
    r"cost increase",
    r"cost increased",
    r"costs increased",
    r"cost rose",
    r"costs rose",
    r"higher cost",
    r"higher costs",
    r"higher freight",
    r"higher trip costs",
    r"increased transportation costs",
    r"pushing up transportation costs",
    r"pushed up transportation costs",
    r"transportation costs rose",
    r"transportation cost rose",
    r"freight costs rose",
    r"freight cost rose",
    r"freight costs increased",
    r"freight cost increased",
    r"temporary surcharge",
    r"surcharge applied",
    r"surcharge",
    r"price increase",
    r"rate increase",
    r"rate increased",
    r"rates increased",
    r"fuel prices? .* (increased|rose|pushed up|increasing)",
    r"fuel .* pushing up .* costs",
    r"fuel .* increased .* costs",
    r"toll increase",
    r"toll .* increased .* costs",
    r"toll .* pushed up .* costs",
    r"due to high demand",
    r"due to increased demand",
    r"due to limited truck availability",
    r"due to truck shortage",
    r"limited truck availability.*surcharge",
    r"limited truck availability.*cost",
]
NEGATIVE_PATTERNS = [
    r"costs were not affected",
    r"cost was not affected",
    r"costs were not significantly affected",
    r"cost was not significantly affected",
    r"no impact on cost",
    r"no impact on costs",
    r"did not affect costs",
    r"did not affect cost",
    r"without a rate change",
    r"without rate change",
    r"no surcharge",
    r"no increase",
    r"no major disruptions",
    r"no major disruption",
    r"no significant disruptions",
    r"no significant disruption",
    r"stable demand",
    r"affected routes are not part of this dataset",
    r"compliance costs were absorbed",
]

DEFAULT_MODEL = "default"  # usage rows of runs without a generator of their own
