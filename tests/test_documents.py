"""Whole JSON documents written in parts, and the policy for reports without rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clinicflow.plans import appointment, catalog, completed_visits, diagnosis, service_time
from clinicflow.plans.base import Report
from clinicflow.sources.sinks import json_document, ordered_json_array, write_document
from clinicflow.sources.standins import diagnosis_tables, standin_tables

SF = "/root/testdata/sf0.001"
EVENTS = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
VISITS = ("1995-01-01 00:00:00", "2002-01-01 00:00:00")


def whole(spark, path):
    """The document, its parts put together as the manifest says."""
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    data = b""
    for f in manifest["files"]:
        raw = spark.read.format("binaryFile").load(f["path"]).first()["content"]
        assert len(raw) == f["bytes"]
        data += raw
    return json.loads(data), manifest["files"]


@pytest.mark.parametrize(
    "build, order",
    [
        (lambda s: appointment.appointment_report(standin_tables(s, SF), *EVENTS), ["seq_no"]),
        (lambda s: diagnosis.diagnosis_report(diagnosis_tables(s, SF), *EVENTS), ["hn", "visit_date"]),
        (lambda s: service_time.service_time_report(standin_tables(s, SF), *VISITS), ["seq_no"]),
        (lambda s: completed_visits.completed_report(standin_tables(s, SF), *VISITS), ["clinic_id", "hn"]),
    ],
    ids=["R3", "R4", "R6", "R7"],
)
def test_parts_make_one_ordered_document(spark, tmp_path, build, order):
    report = build(spark)
    write_document(report, str(tmp_path / "doc"), parts=5)
    doc, files = whole(spark, str(tmp_path / "doc"))
    assert list(doc) == ["meta", "content"] and len(files) > 4
    rows = [json.loads(r[0]) for r in report.content.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]
    text = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(text, doc["content"])) == sorted(map(text, rows))
    key = lambda r: [(r[c] is None, r[c] or 0 if not isinstance(r[c], str) else r[c]) for c in order]
    assert doc["content"] == sorted(doc["content"], key=key)
    if "total_records" in doc["meta"]:
        assert doc["meta"]["total_records"] == len(rows)
    # no part holds much more than its share
    sizes = [f["bytes"] for f in files if "/parts/" in f["path"]]
    assert max(sizes) < 2 * sum(sizes) / 5


@pytest.mark.parametrize("empty", ["null", "[]"])
def test_no_rows_and_one_row(spark, tmp_path, empty):
    one = spark.createDataFrame([(1, None, "a,b]")], "k int, v string, t string")
    meta = spark.range(1).select(F.lit("r").alias("report_name"))
    write_document(Report(meta, one, order=("k",), empty=empty), str(tmp_path / "one"))
    assert whole(spark, str(tmp_path / "one"))[0] == {"meta": {"report_name": "r"}, "content": [{"k": 1, "v": None, "t": "a,b]"}]}
    write_document(Report(meta, one.limit(0), order=("k",), empty=empty), str(tmp_path / "none"))
    assert whole(spark, str(tmp_path / "none"))[0] == {"meta": {"report_name": "r"}, "content": json.loads(empty)}


def test_each_report_has_its_empty_policy(spark):
    t, none = standin_tables(spark, SF), ("1980-01-01", "1980-01-02")
    dx = diagnosis_tables(spark, SF)
    want = {"department": None, "appointment": None, "diagnosis": None, "service_time": None, "completed_visits": [], "clinic_type": []}
    for name, content in want.items():
        r = catalog.run_report(dx if name == "diagnosis" else t, name, {"p-start": none[0], "p-end": none[1]})
        keys = [c for c in r.content.columns if c not in ("patient",)]
        array = ordered_json_array(r.content.limit(0), F.struct(*keys), [keys[0]])
        doc = json.loads(json_document(r.meta, array, r.empty).first()["document"])
        assert doc["content"] == content, name


def test_cashier_through_the_catalog(spark):
    t = standin_tables(spark, SF)
    r = catalog.run_report(t, "cashier", {"start-time": "1995-01-01", "end-time": "2001-12-31"})
    assert r.content.count() > 0 and r.extras["rollup"].count() == 7
    assert r.meta.first()["start_datetime"].isoformat() == "1994-12-31T17:00:00"
    with pytest.raises(ValueError):
        catalog.run_report(t.with_tables(cashier=None), "cashier", {"start": "1995-01-01", "end": "1995-01-02"})
