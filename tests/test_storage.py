"""The production path: logical tables stored as Parquet (facts partitioned by
``part_date``) give the same reports as the in-memory stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinicflow.plans import clinic_type, completed_visits, department, scheme
from clinicflow.sources.layout import write_partitioned_facts
from clinicflow.sources.sinks import ordered_json_array
from clinicflow.sources.standins import standin_tables
from clinicflow.sources.tables import Tables

SF = "/root/testdata/sf0.001"
A, B = "1996-01-01 00:00:00", "1997-01-01 00:00:00"


def _same(a, b):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_stored_layout_matches_standins(spark, tmp_path):
    t = standin_tables(spark, SF)
    root = tmp_path / "hospital"
    write_partitioned_facts(t.visit, str(root / "visit"), "created_at")
    for name in ("encounter", "department", "clinic", "insurance_plan", "patient"):
        getattr(t, name).write.parquet(str(root / name))
    stored = Tables.from_parquet(spark, str(root), names=("visit", "encounter", "department", "clinic", "insurance_plan", "patient"))
    assert "part_date" in stored.visit.columns
    assert _same(scheme.scheme_report(t, A, B).content, scheme.scheme_report(stored, A, B).content)
    assert _same(department.department_summary(t, A, B), department.department_summary(stored, A, B))
    assert _same(clinic_type.clinic_content(t, A, B), clinic_type.clinic_content(stored, A, B))
    cv = completed_visits.completed_rows(t, A, B)
    assert _same(cv, completed_visits.completed_rows(stored, A, B).select(*cv.columns))


def test_json_array_empty_policy(spark):
    empty = spark.createDataFrame([], "k int, v string")
    as_null = ordered_json_array(empty, F.col("v"), ["k"], empty_as_null=True).collect()[0]["json"]
    assert as_null is None
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    assert ordered_json_array(df, F.col("v"), ["k"]).collect()[0]["json"] == '["a","b"]'


def test_write_report_meta_from_written_content(spark, tmp_path):
    import json

    from clinicflow.plans import diagnosis
    from clinicflow.sources.sinks import write_report
    from clinicflow.sources.standins import diagnosis_tables

    t = diagnosis_tables(spark, SF)
    r = diagnosis.diagnosis_report(t, "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    out = str(tmp_path / "r4")
    write_report(r, out)
    meta = json.loads(spark.read.text(f"{out}/meta").collect()[0][0])
    content_rows = spark.read.json(f"{out}/content").count()
    assert meta["total_records"] == content_rows == r.meta.collect()[0]["total_records"] > 0
    assert meta["start_datetime"] == "2024-01-01T07:00:00+07:00"


def test_instants_read_alike_in_any_session_zone(spark, tmp_path):
    from clinicflow.sources.tables import Tables

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.sql("SELECT 1 AS vn, TIMESTAMP'2024-01-01 08:00:00+00:00' AS created_at").write.parquet(str(tmp_path / "visit"))
    spark.sql("SELECT 1 AS hn, TIMESTAMP'2024-01-01 08:00:00+00:00' AS first_created_at").write.parquet(str(tmp_path / "first_visit"))
    try:
        for zone in ("UTC", "Asia/Bangkok", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            t = Tables.from_parquet(spark, str(tmp_path))
            assert t.visit.selectExpr("cast(created_at AS string)").first()[0] == "2024-01-01 08:00:00"
            assert t.first_visit_table() is not None
            plan = t.visit.where("created_at >= timestamp_ntz'2024-01-01 00:00:00'")._jdf.queryExecution().executedPlan().toString()
            assert "GreaterThanOrEqual(created_at" in plan
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
