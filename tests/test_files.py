import pytest

from costwatch.operators import report
from costwatch.sources import files
from costwatch.staging import stage

HEADER = (
    "shipment_id,origin,destination,route_type,material,quantity_tonnes,distance_km,"
    "freight_cost_inr,shipment_date,transporter,extra\n"
)


def test_shipments(spark, tmp_path):
    path = tmp_path / "good.csv"
    path.write_text(HEADER + 'S1,"Porto, north",Faro,Short,,10,100.5,1e3,2025-01-06,,x\n')
    row = files.read_shipments(spark, str(path)).first()
    assert (row["origin"], row["material"], row["extra"]) == ("Porto, north", None, "x")
    assert float(row["freight_cost_inr"]) == 1000.0
    assert row["shipment_date"].isoformat() == "2025-01-06"
    bad = tmp_path / "bad.csv"
    bad.write_text(HEADER + "S1,P,F,Short,,ten,-5,NaN,soon,,x\n")
    with pytest.raises(ValueError, match="missing_quantity_tonnes=1"):
        files.read_shipments(spark, str(bad))
    coerced = files.read_shipments(spark, str(bad), check=False).first()
    assert coerced["quantity_tonnes"] is None and coerced["shipment_date"] is None
    short = tmp_path / "short.csv"
    short.write_text("shipment_id,origin\nS1,P\n")
    with pytest.raises(ValueError, match="destination"):
        files.read_shipments(spark, str(short))


def test_notes_and_labels(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text('note_id,date,applies_to,note\nN1,2025-01-06,A-B,"He said ""no"", twice"\n')
    assert files.read_notes(spark, str(path)).first()["note"] == 'He said "no", twice'
    labels = tmp_path / "labels.csv"
    labels.write_text(
        "case_id,route,week_of,note_id,expected_valid,expected_verdict,description\n"
        "E1,A-B,2025-01-06,,True,justified,d\n"
    )
    row = files.read_labeled(spark, str(labels)).first()
    assert row["expected_valid"] is True and row["note_id"] is None


def test_results_and_reports(spark, tmp_path):
    from test_evidence import result_rows

    results = result_rows(spark)
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        files.write_results(results, path, fmt)
        files.write_results(results, path, fmt)  # replaces
        back = files.read_results(spark, path, fmt)
        assert back.count() == 3 and back.filter("matched_note_id = ''").count() == 2
    report.export_view(results, "A-B", "All", str(tmp_path / "view"))
    assert files.read_results(spark, str(tmp_path / "view")).count() == 2
    summary = report.verdict_summary(results)
    files.write_json_report(summary, str(tmp_path / "json"))
    back = files.read_json_report(spark, str(tmp_path / "json"), summary.schema)
    assert back.collect() == summary.collect()
    absent = files.read_json_report(spark, str(tmp_path / "absent"), summary.schema)
    assert absent.count() == 0
    broken = tmp_path / "broken.json"
    broken.write_text("{nothing\n")
    with pytest.raises(ValueError, match="1 records"):
        files.read_json_report(spark, str(broken), summary.schema)
    indented = tmp_path / "indented.json"
    indented.write_text('{\n  "verdict": "No",\n  "n": 3\n}\n')
    read = files.read_json_report(spark, str(indented), "verdict string, n long", multi_line=True)
    assert [tuple(r) for r in read.collect()] == [("No", 3)]
    with pytest.raises(ValueError, match="multi_line"):
        files.read_json_report(spark, str(indented), "verdict string, n long")


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text('note_id,date,applies_to,note\nN1,06.01.2025,A-B,"one\nno surcharge"\n')
    row = files.read_notes(spark, str(path), date_formats=["dd.MM.yyyy"]).first()
    assert row["note"] == "one\nno surcharge" and row["date"].isoformat() == "2025-01-06"


def test_stage_keeps_rows_and_types(spark):
    frame = spark.range(10).selectExpr("id", "cast(id as decimal(18,2)) as d")
    staged = stage(frame, "numbers")
    assert staged.schema["d"].dataType == frame.schema["d"].dataType
    assert sorted(staged.collect()) == sorted(frame.collect())
