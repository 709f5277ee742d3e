import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from costwatch import settings
from costwatch.operators import corpus, evaluate, evidence, explain, hybrid, report, verdict
from costwatch.plans import assess
from costwatch.sources import files

NOTES = "note_id string, date date, applies_to string, note string"
D = dt.date.fromisoformat


def docs_of(spark, rows):
    notes = spark.createDataFrame(rows, NOTES)
    return evidence.with_snippet(evidence.with_text_flags(corpus.note_docs(notes), "text"))


@pytest.mark.parametrize("days", [0, 2, 6, 7, 10, 14])
def test_note_weeks_is_the_date_band(spark, days):
    rows = [(f"N{i}", dt.date(2025, 1, 1) + dt.timedelta(days=i), "A", "x") for i in range(15)]
    frame = spark.createDataFrame(rows, NOTES).withColumnRenamed("date", "note_date")
    got = {(r["note_id"], r["week_of"]) for r in evidence.note_weeks(frame, days).collect()}
    mondays = [dt.date(2024, 12, 2) + dt.timedelta(weeks=i) for i in range(12)]
    assert got == {(n, m) for n, d, *_ in rows for m in mondays if abs((d - m).days) <= days}


def test_match_evidence_against_all_pairs(spark):
    random.seed(11)
    texts = ["a surcharge was added", "roads were closed", "surcharge, then no surcharge"]
    routes = ["A-B", "A-C", "all routes"]
    start = dt.date(2025, 1, 6)
    # one route-week and the notes for all routes hold most of the notes
    notes = [
        (f"N{i:03d}", start + dt.timedelta(days=random.choice([3, 3, 3, 9, 20])), random.choice(routes), random.choice(texts))
        for i in range(120)
    ]
    weeks = [(r, start + dt.timedelta(weeks=w)) for r in ("A-B", "A-C", "A-D") for w in range(5)]
    frame = spark.createDataFrame(weeks, "route string, week_of date")
    got = evidence.match_evidence(frame, docs_of(spark, notes), days=7, k=4)
    found = {}
    for r in got.orderBy("rank").collect():
        found.setdefault((r["route"], r["week_of"]), []).append(r["note_id"])
    for route, week in weeks:
        fits = [
            (t != texts[0], abs((d - week).days), n)
            for n, d, a, t in notes
            if a in (route, "all routes") and abs((d - week).days) <= 7
        ]
        assert found.get((route, week), []) == [n for _, _, n in sorted(fits)[:4]]


SCORED = (
    "route string, week_of date, cost_per_tonne_km double, vs_own_history_pct double, "
    "vs_similar_routes_pct double, is_candidate_anomaly boolean"
)
ROWS = [
    ("A-B", D("2025-01-06"), 3.005, 29.5, 22.5, True),
    ("A-B", D("2025-01-13"), 2.0, None, -4.0, False),
    ("A-C", D("2025-01-06"), 4.0, 35.0, None, True),
    ("A-D", D("2025-03-03"), 4.0, 35.0, 21.0, True),
]
FEW = [
    ("N1", D("2025-01-08"), "A-B", "Port strike brought a surcharge. More"),
    ("N2", D("2025-01-06"), "A-B", "A bridge opened. More"),
    ("N3", D("2025-01-02"), "A-C", "Stable demand"),
]


@pytest.mark.parametrize("strategy", ["pre", "post"])
def test_verdicts(spark, strategy):
    scored = spark.createDataFrame(ROWS, SCORED)
    notes = spark.createDataFrame(FEW, NOTES)
    found = hybrid.retrieve_evidence(scored.filter("is_candidate_anomaly"), notes, strategy)
    verdicts = verdict.assign_verdict(scored, found)
    results = verdict.shape_results(verdicts)
    assert results.columns == settings.RESULT_COLUMNS
    got = {(r["route"], r["week_of"]): r for r in results.collect()}
    justified = got[("A-B", "2025-01-06")]
    assert (justified["flagged"], justified["matched_note_id"]) == ("No (justified)", "N1")
    assert "N1" in justified["reason"] and "+29.5%" in justified["reason"]
    assert got[("A-B", "2025-01-13")]["reason"] == settings.NORMAL_REASON
    assert got[("A-B", "2025-01-13")]["vs_own_history"] == "N/A"
    rejected = got[("A-C", "2025-01-06")]
    assert rejected["flagged"] == "Yes" and rejected["matched_note_id"] == ""
    if strategy == "pre":
        assert "N3, 2025-01-02" in rejected["reason"] and '"Stable demand"' in rejected["reason"]
        assert got[("A-D", "2025-03-03")]["reason"] == settings.NO_NOTE_REASON
    else:
        assert "closest note" in got[("A-D", "2025-03-03")]["reason"]
    prompts = explain.ground_prompts(verdicts, corpus.note_docs(notes))
    row = explain.explain(prompts).first()
    assert row["reason"] == justified["reason"]
    assert row["input_tokens"] == len(row["prompt"].split())
    assert "surcharge" in row["prompt"]


def test_own_generator(spark):
    prompts = spark.createDataFrame([("A", "p one"), ("B", "p two")], "route string, prompt string")
    made = explain.explain(
        prompts,
        lambda ps: [{"text": p.upper(), "input_tokens": 3, "output_tokens": 2} for p in ps],
    )
    assert {r["reason"] for r in made.collect()} == {"P ONE", "P TWO"}
    empty = explain.explain(
        prompts, lambda ps: [{"text": " ", "input_tokens": 0, "output_tokens": 0} for _ in ps]
    )
    with pytest.raises(Exception, match="empty text"):
        empty.collect()


def test_usage_cost(spark):
    calls = spark.createDataFrame(
        [("m", 1000, 300), ("m", 196, None), ("n", 0, 55)],
        "model string, input_tokens long, output_tokens long",
    )
    got = {r["model"]: r for r in explain.usage_cost(calls).collect()}
    assert (got["m"]["llm_calls"], got["m"]["total_tokens"]) == (2, 1496)
    assert got["m"]["estimated_input_cost"] == 0.0001794
    assert got["m"]["estimated_total_cost"] == 0.0003594


def test_evaluation(spark):
    notes = spark.createDataFrame([*FEW, ("N1", D("2025-06-01"), "X-Y", "later copy")], NOTES)
    cases = [
        ("E1", "a-b", D("2025-01-06"), "N1", True, "justified", "case of the route is free"),
        ("E2", "A-C", D("2025-01-06"), "N1", False, "unexplained", "wrong route"),
        ("E3", "A-B", D("2025-01-06"), None, False, "unexplained", "no note"),
        ("E4", "A-B", D("2025-01-06"), "", False, "unexplained", "blank"),
        ("E5", "A-B", D("2025-01-06"), "N9", True, "justified", "unknown id fails"),
    ]
    labeled = spark.createDataFrame(
        cases,
        "case_id string, route string, week_of date, note_id string, expected_valid boolean, "
        "expected_verdict string, description string",
    )
    out = evaluate.evaluate_cases(labeled, notes)
    got = {r["case_id"]: (r["note_found"], r["passed"]) for r in out.collect()}
    assert got == {
        "E1": (True, True), "E2": (True, True), "E3": (False, True), "E4": (False, True),
        "E5": (False, False),
    }
    summary = evaluate.evaluation_summary(out).first().asDict()
    assert summary == {"total_cases": 5, "passed_cases": 4, "failed_cases": 1, "pass_rate": 0.8}
    assert evaluate.evaluation_summary(out.limit(0)).first()["pass_rate"] == 0.0


def result_rows(spark):
    rows = [
        ("A-B", "2025-01-06", 3.0, "+29.5% x", "N/A", "No (justified)", "N1", "r"),
        ("A-B", "2025-01-13", 2.0, "N/A", "N/A", "No", "", "r"),
        ("A-C", "2025-01-06", 4.0, "+35.0% x", "+1.0% y", "Yes", "", "r"),
    ]
    return spark.createDataFrame(
        rows,
        "route string, week_of string, cost_per_tonne_km double, vs_own_history string, "
        "vs_similar_routes string, flagged string, matched_note_id string, reason string",
    )


def test_run_comparison(spark):
    first = result_rows(spark)
    other = first.filter("route = 'A-B'").withColumn("reason", F.lit("other words"))
    same = evaluate.reproducibility_report([first, first.repartition(5)])
    assert same.filter("not passed or not all_passed").count() == 0
    diff = {r["column"]: r["differences"] for r in evaluate.compare_runs(first, other).collect()}
    assert set(diff.values()) == {1} and "reason" not in diff
    with pytest.raises(ValueError):
        evaluate.compare_runs(first, other.drop("flagged"))


def test_views(spark):
    results, notes = result_rows(spark), spark.createDataFrame(FEW, NOTES)
    assert report.verdict_summary(results).first().asDict() == {
        "route_weeks": 3, "anomalies": 2, "justified": 1, "unexplained": 1, "normal": 1,
    }
    assert report.filter_results(results, "A-B", "Justified").count() == 1
    with pytest.raises(ValueError):
        report.filter_results(results, status="other")
    shown = report.report_view(results).filter("route = 'A-C'").first()
    assert (shown["status"], shown["vs_own_history"]) == ("⚠ Needs Review", "+35.0%")
    rows = {r["route"]: r for r in report.investigation_view(results, notes).collect()}
    assert rows["A-B"]["own_history_pct"] == 29.5
    assert (rows["A-B"]["route_ok"], rows["A-B"]["date_ok"], rows["A-B"]["cost_ok"]) == (True,) * 3
    assert rows["A-C"]["note_id"] is None and rows["A-C"]["cost_ok"] is None


def test_questions(spark):
    questions = spark.createDataFrame(
        [(1, "Which port strike surcharge?"), (2, "zzz")], "query_id bigint, text string"
    )
    notes = spark.createDataFrame(FEW, NOTES)
    got = {r["query_id"]: r for r in assess.ask(questions, result_rows(spark), notes).collect()}
    assert "context_note|N1" in got[1]["answer"] and got[1]["input_tokens"] > 0
    assert got[2]["answer"] == settings.NO_EVIDENCE_ANSWER
    assert (got[2]["input_tokens"], got[2]["output_tokens"]) == (0, 0)
    own = assess.ask(
        questions, result_rows(spark), notes,
        generator=lambda ps: [{"text": "x", "input_tokens": 5, "output_tokens": 1} for _ in ps],
    )
    made = {r["query_id"]: (r["answer"], r["input_tokens"]) for r in own.collect()}
    assert made == {1: ("x", 5), 2: (settings.NO_EVIDENCE_ANSWER, 0)}


def test_assess_with_own_generator(spark):
    """Explanations come from the generator, once per justified route-week."""
    day = D("2025-01-06")
    rows = [
        (f"S{r}{w}", "A", r, "Short", 10.0, 10.0, 100.0 if w < 3 else 200.0, day + dt.timedelta(weeks=w))
        for r in ("B", "C") for w in range(4)
    ]
    shipments = spark.createDataFrame(
        rows,
        "shipment_id string, origin string, destination string, route_type string, "
        "quantity_tonnes double, distance_km double, freight_cost_inr double, shipment_date date",
    )
    notes = spark.createDataFrame(
        [("N1", D("2025-01-28"), "A-B", "A surcharge was applied."), ("N2", day, "A-C", "Rain.")],
        NOTES,
    )
    done = assess.assess(
        shipments, notes, "pre",
        generator=lambda ps: [{"text": "made", "input_tokens": 7, "output_tokens": 1} for _ in ps],
    )
    got = {(r["route"], r["week_of"]): (r["flagged"], r["reason"]) for r in done.results.collect()}
    assert len(got) == 8
    assert got[("A-B", "2025-01-27")] == ("No (justified)", "made")
    assert got[("A-C", "2025-01-27")] == ("Yes", settings.NO_NOTE_REASON)
    assert [r["input_tokens"] for r in done.calls.collect()] == [7]


def _counting(folder, broken=None):
    """A generator that leaves a file for each prompt it is asked, and may break on one."""

    def generator(prompts):
        import os
        import uuid

        for p in prompts:
            open(os.path.join(folder, f"{p.replace(' ', '_')}-{uuid.uuid4().hex}"), "w").close()
        if broken in prompts:
            raise RuntimeError("lost")
        return [{"text": f" to {p} ", "input_tokens": 1, "output_tokens": 2} for p in prompts]

    return generator


def test_answers_are_kept(spark, tmp_path):
    """A task that fails costs its own batch only; later runs ask what has no answer."""
    import os
    from collections import Counter

    asked, answers = str(tmp_path / "asked"), str(tmp_path / "answers")
    os.mkdir(asked)
    count = lambda: Counter(name.rpartition("-")[0] for name in os.listdir(asked))
    rows = [(str(i), f"p {i % 20}") for i in range(25)]  # five prompts occur twice
    prompts = spark.createDataFrame(rows, "route string, prompt string")
    with pytest.raises(Exception, match="lost"):
        explain.explain(prompts, _counting(asked, broken="p 3"), batch_size=1, answers=answers).collect()
    first = count()
    done = explain.explain(prompts, _counting(asked), batch_size=1, answers=answers).collect()
    assert sorted((r["route"], r["reason"]) for r in done) == sorted((i, f"to {p}") for i, p in rows)
    again = count()
    assert set(again) == {f"p_{i}" for i in range(20)}
    assert all(n == first.get(p, 0) + (1 if p == "p_3" or not first.get(p) else 0) for p, n in again.items())
    more = prompts.unionByName(spark.createDataFrame([("x", "p new")], prompts.schema))
    assert explain.explain(more, _counting(asked), batch_size=4, answers=answers).count() == 26
    assert count() == again + Counter({"p_new": 1})
    assert not [name for name in os.listdir(answers) if name.startswith("_")]


def test_evidence_is_scored(spark):
    """`pre` ranks fitting notes by their text, `post` keeps the scores of the search."""
    scored = spark.createDataFrame(ROWS, SCORED).filter("is_candidate_anomaly")
    notes = spark.createDataFrame(
        [
            ("N1", D("2025-01-06"), "A-B", "A surcharge came."),
            ("N2", D("2025-01-08"), "A-B", "Freight cost surcharge for fuel, toll and weather disruption."),
            ("N3", D("2025-01-06"), "all routes", "Cheap fuel, possible freight cost."),
        ],
        NOTES,
    )
    rows = hybrid.retrieve_evidence(scored.filter("route = 'A-B'"), notes, "pre").orderBy("rank").collect()
    assert [r["note_id"] for r in rows] == ["N2", "N1", "N3"]  # usable first, then by score
    assert rows[0]["rerank_score"] > rows[1]["rerank_score"] > 0
    post = hybrid.retrieve_evidence(scored.filter("route = 'A-B'"), notes, "post").collect()
    same = {r["note_id"]: r["rerank_score"] for r in post}
    assert {r["note_id"]: r["rerank_score"] for r in rows} == pytest.approx(same)
    assert all(0 <= r["hybrid_score"] <= 1 and r["dense_score"] is not None and r["lexical_score"] is not None for r in post)


def test_export_keeps_blanks(spark, tmp_path):
    rows = [("A-B", "2025-01-06", 1.0, "N/A", "N/A", "No", "", "  two blanks before and behind  ")]
    kinds = ", ".join(f"{c} {'double' if c == 'cost_per_tonne_km' else 'string'}" for c in settings.RESULT_COLUMNS)
    frame = spark.createDataFrame(rows, kinds)
    report.export_view(frame, report.ANY_ROUTE, report.ANY_STATUS, str(tmp_path / "out"))
    assert files.read_results(spark, str(tmp_path / "out")).first()["reason"] == rows[0][-1]
