"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query builds the stand-in tables over the driver's Parquet files and
runs one operator or report of SURVEY section 2 over the *whole* tables: the
report windows below span every row of the test data (orders 1995-2001,
events January 2024). Output columns are plain types (bigint, double,
string, boolean) so the Spark result and the DuckDB oracle compare
value for value; decimals are compared as doubles, dates as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicflow.functions import dates as D
from clinicflow.functions import expr as X
from clinicflow.functions.jsonx import element_fields, object_texts
from clinicflow.functions.labels import REPORT_TZ, SCHEME_KEYS_TH
from clinicflow.operators.arrays import explode_keep_empty, membership_join
from clinicflow.operators.history import first_visits, flag_new_inner, flag_new_no_earlier
from clinicflow.operators.increments import apply_batch
from clinicflow.operators.joins import enrich_patient, lookup
from clinicflow.operators.ordering import global_row_number
from clinicflow.operators.spine import date_spine, fill_spine
from clinicflow.operators.states import number_keys
from clinicflow.params import closed, half_open, is_true, not_deleted, shifted, ts_lit
from clinicflow.plans import (
    appointment,
    cashier,
    catalog,
    clinic_type,
    completed_visits,
    department,
    diagnosis,
    plan_summary,
    scheme,
    service_time,
)
from clinicflow.sources import layout, standins
from clinicflow.sources.sinks import json_rows, ordered_json_array
from clinicflow.sources.tables import Tables

# Report windows covering all test rows.
VISIT_START, VISIT_END = "1995-01-01 00:00:00", "2002-01-01 00:00:00"
EVENT_START, EVENT_END = "2024-01-01 00:00:00", "2024-02-01 00:00:00"

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return deco


def _t(spark, sf_dir):
    return standins.standin_tables(spark, sf_dir)


def _counts() -> list:
    return [F.col(c).cast("bigint").alias(c) for c in scheme.COUNT_COLS]


# ---------------------------------------------------------------- R1 scheme
@register("scheme_daily")
def q_scheme_daily(spark, sf_dir):
    d = scheme.scheme_daily(_t(spark, sf_dir), VISIT_START, VISIT_END)
    return d.select(D.fmt_iso_date("visit_date").alias("visit_date"), *_counts())


@register("scheme_daily_local")
def q_scheme_daily_local(spark, sf_dir):
    """R1's days in the report zone."""
    d = scheme.scheme_daily(_t(spark, sf_dir), VISIT_START, VISIT_END, tz=REPORT_TZ)
    return d.select(D.fmt_iso_date("visit_date").alias("visit_date"), *scheme.COUNT_COLS)


@register("diagnosis_rejected")
def q_diagnosis_rejected(spark, sf_dir):
    """Texts and elements that give no diagnosis row."""
    return diagnosis.diagnosis_rejected(_dx(spark, sf_dir), EVENT_START, EVENT_END)


def visit_batches(visit):
    """Three loads of the visits, each row with its ``version``: a third of the visits comes late; a seventh comes first
    with another status, deletion, plan and day, and is corrected later, some only with the last load."""
    late, wrong = F.col("vn") % 3 == 2, F.col("vn") % 7 == 0
    first = visit.where(~late | wrong).select(
        "vn",
        F.when(wrong, F.col("created_at") - F.expr("INTERVAL 3 DAYS")).otherwise(F.col("created_at")).alias("created_at"),
        (F.col("active") | wrong).alias("active"),
        F.when(~wrong, F.col("deleted_at")).alias("deleted_at"),
        F.when(wrong, "completed").otherwise(F.col("latest_status_code")).alias("latest_status_code"),
        F.when(wrong, F.array(F.lit(1).cast("bigint"))).otherwise(F.col("insurance_plan_ids")).alias("insurance_plan_ids"),
        "department_ids",
        F.lit(1).alias("version"),
    )
    columns = [c for c in first.columns if c != "version"]
    second = visit.where(late | (wrong & (F.col("vn") % 2 == 0))).select(*columns, F.lit(2).alias("version"))
    third = visit.where(wrong).select(*columns, F.lit(3).alias("version"))
    # the last load also brings rows of the first one again, which change nothing
    return first, second, third.unionByName(first.where(F.col("vn") % 5 == 0))


@register("scheme_daily_maintained")
def q_scheme_daily_maintained(spark, sf_dir):
    """R1's days from counts kept current over three load batches with late corrections."""
    t = _t(spark, sf_dir)
    batches = visit_batches(t.visit)
    contribution = lambda visits: scheme.scheme_counts(t, visits, "1990-01-01 00:00:00", VISIT_END)
    current, counts = batches[0].limit(0), contribution(batches[0].limit(0))
    for batch in batches:
        current, counts = apply_batch(current, counts, batch, "vn", "version", contribution, ["visit_date"], scheme.COUNT_COLS)
    daily = scheme.scheme_daily_of(t, counts, VISIT_START, VISIT_END)
    return daily.select(D.fmt_iso_date("visit_date").alias("visit_date"), *_counts())


@register("scheme_total")
def q_scheme_total(spark, sf_dir):
    d = scheme.scheme_daily(_t(spark, sf_dir), VISIT_START, VISIT_END)
    return scheme.scheme_total(d)


@register("scheme_report")
def q_scheme_report(spark, sf_dir):
    r = scheme.scheme_report(_t(spark, sf_dir), VISIT_START, VISIT_END)
    return r.content.select(F.col("sort_order").cast("bigint").alias("sort_order"), "date_text", *_counts())


def _dx(spark, sf_dir):
    return standins.diagnosis_tables(spark, sf_dir)


def _ts_text(col):
    return D.fmt_datetime(col)


def _dbl(col):
    return F.col(col).cast("double").alias(col)


@register("json_rows")
def q_json_rows(spark, sf_dir):
    """R1 rows as JSON objects with the Thai presentation keys."""
    r = scheme.scheme_report(_t(spark, sf_dir), VISIT_START, VISIT_END)
    keys = dict(zip(["date_text", "ucs", "sss", "ofc", "cash"], SCHEME_KEYS_TH))
    return json_rows(r.content, ["date_text", "ucs", "sss", "ofc", "cash"], keys)


@register("content_date_range")
def q_content_date_range(spark, sf_dir):
    d = scheme.scheme_daily(_t(spark, sf_dir), VISIT_START, VISIT_END)
    return scheme.content_date_range(d)


@register("date_spine")
def q_date_spine(spark, sf_dir):
    """S3 + J9: every day of the window with its visit count (0 kept)."""
    t = _t(spark, sf_dir)
    v = t.visit.where(half_open("created_at", VISIT_START, VISIT_END))
    per_day = v.groupBy(F.to_date("created_at").alias("visit_date")).agg(F.count(F.lit(1)).alias("visits"))
    spine = date_spine(spark, VISIT_START, VISIT_END, "visit_date")
    out = fill_spine(spine, per_day, "visit_date", ["visits"])
    return out.select(D.fmt_iso_date("visit_date").alias("visit_date"), "visits")


@register("param_optional_filter")
def q_param_optional_filter(spark, sf_dir):
    """R1 totals with both optional filters set."""
    d = scheme.scheme_daily(_t(spark, sf_dir), VISIT_START, VISIT_END, patient_category="SSS", dept_name="NATION_1")
    return scheme.scheme_total(d)


@register("category_map")
def q_category_map(spark, sf_dir):
    """Qualifying visits (before fan-out) per derived category."""
    t = _t(spark, sf_dir)
    v = scheme.with_plan(scheme.completed_visits_closed(t.visit, VISIT_START, VISIT_END), t.insurance_plan)
    return v.groupBy(X.plan_category("plan_code", "plan_name").alias("category")).agg(
        F.count(F.lit(1)).alias("visits")
    )


@register("scan_visit_range")
def q_scan_visit_range(spark, sf_dir):
    """Completed visits in the window (pushed-down range + status)."""
    t = _t(spark, sf_dir)
    v = t.visit.where((F.col("latest_status_code") == "completed") & half_open("created_at", VISIT_START, VISIT_END))
    return v.select("vn", "hn", _ts_text("created_at").alias("created_at"))


def _in_out(rows, ts, within):
    """Rows in and out of a range from the first time after a day to the last time before the last day."""
    c, day = F.col(ts), F.expr("INTERVAL 1 DAY")
    first, last = rows.agg(F.min(c) + day, F.max(c) - day).first()
    if first is None:
        return rows.limit(0).select(F.lit(None).cast("boolean").alias("inside"), F.lit(0).cast("bigint").alias("n"))
    lo, hi = rows.agg(F.min(F.when(c >= ts_lit(first), c)), F.max(F.when(c <= ts_lit(last), c))).first()
    return rows.groupBy(within(ts, lo, hi).alias("inside")).agg(F.count(F.lit(1)).alias("n"))


@register("range_half_open")
def q_range_half_open(spark, sf_dir):
    """appointments in and out of ``start <= ts < end``, the bounds being times of the table."""
    return _in_out(_t(spark, sf_dir).appointment, "start", half_open)


@register("range_closed")
def q_range_closed(spark, sf_dir):
    """visits in and out of ``start <= created_at <= end``, the bounds being times of the table."""
    return _in_out(_t(spark, sf_dir).visit, "created_at", closed)


@register("range_shifted")
def q_range_shifted(spark, sf_dir):
    """Diagnosis visits in and out of a range moved back 7 hours."""
    return _in_out(_dx(spark, sf_dir).visit, "created_at", lambda c, lo, hi: shifted(c, lo, hi, 7))


@register("soft_delete_filter")
def q_soft_delete_filter(spark, sf_dir):
    """active, not deleted visits per status."""
    v = _t(spark, sf_dir).visit.where(is_true("active") & not_deleted())
    return v.groupBy("latest_status_code").agg(F.count(F.lit(1)).alias("n"))


@register("dim_active_departments")
def q_dim_active_departments(spark, sf_dir):
    """Departments that are active and not deleted."""
    return department.active_departments(_t(spark, sf_dir))


@register("sort_names")
def q_sort_names(spark, sf_dir):
    """O3: active department names in order, NULLS LAST (the R2 list)."""
    d = department.active_departments(_t(spark, sf_dir))
    # Bounded by the department dimension: a plain window is fine here.
    from pyspark.sql import Window

    w = Window.orderBy(F.col("name").asc_nulls_last(), F.col("id"))
    return d.select(F.row_number().over(w).cast("bigint").alias("pos"), F.col("name").alias("department"))


# ---------------------------------------------------------------- joins / arrays
@register("join_first_array_elem")
def q_join_first_array_elem(spark, sf_dir):
    """LEFT JOIN plan ON id = insurance_plan_ids[1] (NULL when empty)."""
    t = _t(spark, sf_dir)
    v = t.visit.select("vn", "insurance_plan_ids")
    v = scheme.with_plan(v, t.insurance_plan)
    return v.select("vn", "plan_id", "plan_name")


@register("explode_outer_departments")
def q_explode_outer_departments(spark, sf_dir):
    """One row per department id, NULL row for no departments."""
    v = _t(spark, sf_dir).visit.select("vn", "department_ids")
    return explode_keep_empty(v, "department_ids", "department_id").select("vn", "department_id")


@register("array_membership_join")
def q_array_membership_join(spark, sf_dir):
    """Clinic.id = ANY(visit.clinic_ids), once per distinct id."""
    t = _t(spark, sf_dir)
    j = membership_join(t.visit.select("vn", "clinic_ids"), "clinic_ids", t.clinic, "id", out="clinic_id")
    return j.select("vn", "clinic_id")


@register("left_join_dims")
def q_left_join_dims(spark, sf_dir):
    """Appointment LEFT JOIN clinic, LEFT JOIN practitioner."""
    t = _t(spark, sf_dir)
    a = lookup(t.appointment, "clinic_id", t.clinic, "id", {"name": "clinic_name"})
    a = lookup(a, "practitioner_id", t.practitioner, "id", {"display": "doctor_name"})
    return a.select("id", "clinic_name", "doctor_name")


@register("inner_join_chain")
def q_inner_join_chain(spark, sf_dir):
    """Encounter JOIN visit JOIN clinic."""
    t = _t(spark, sf_dir)
    j = t.encounter.select("en", "vn", "clinic_id").join(t.visit.select("vn", "hn"), "vn", "inner")
    j = lookup(j, "clinic_id", t.clinic, "id", {"name": "clinic_name"}, how="inner")
    return j.select("en", "vn", "hn", "clinic_name")


@register("enrich_patient")
def q_enrich_patient(spark, sf_dir):
    """R7 rows with the patient's name and gender attached (left join)."""
    t = _t(spark, sf_dir)
    rows = completed_visits.completed_rows(t, VISIT_START, VISIT_END)
    e = enrich_patient(rows, t.patient, "hn", ("gender", "info"))
    return e.select("clinic_id", "hn", F.col("patient.info.th.name").alias("patient_name"), F.col("patient.gender").alias("gender"))


# ---------------------------------------------------------------- R2 department
def _r2(spark, sf_dir):
    return department.department_summary(_t(spark, sf_dir), VISIT_START, VISIT_END)


@register("department_summary")
def q_department_summary(spark, sf_dir):
    return _r2(spark, sf_dir)


@register("pct_of_total")
def q_pct_of_total(spark, sf_dir):
    c = department.department_content(_r2(spark, sf_dir))
    return c.select("department", "total_visits", _dbl("percent"))


@register("cumulative_pct")
def q_cumulative_pct(spark, sf_dir):
    c = department.department_content(_r2(spark, sf_dir))
    return c.select("department", _dbl("percent"), _dbl("commulative_view"))


@register("department_report")
def q_department_report(spark, sf_dir):
    c = department.department_content(_r2(spark, sf_dir))
    return c.select("department", *department.COUNT_COLS, _dbl("percent"), _dbl("commulative_view"))


@register("department_foot")
def q_department_foot(spark, sf_dir):
    return department.department_foot(department.department_content(_r2(spark, sf_dir)))


@register("distinct_conditional")
def q_distinct_conditional(spark, sf_dir):
    """Distinct people (R2 rule) next to new + old (R5 / template rule)."""
    s = _r2(spark, sf_dir)
    return s.select(
        "department",
        "new_patients",
        "old_patients",
        "total_patients",
        (F.col("new_patients") + F.col("old_patients")).alias("new_plus_old"),
    )


@register("distinct_by_states")
def q_distinct_by_states(spark, sf_dir):
    """The distinct people of the window, merged from the bitmap states of its two halves."""
    t = _t(spark, sf_dir)
    numbers = number_keys(t.history(), "hn")
    half = "1998-06-01 12:00:00"
    states = department.department_states(t, VISIT_START, half, numbers)
    states = states.unionByName(department.department_states(t, "1998-06-01 12:00:00.000001", VISIT_END, numbers))
    s = department.department_summary_of(t, states)
    return s.select("department", "new_patients", "old_patients", "total_patients", "total_visits")


@register("new_old_by_history")
def q_new_old_by_history(spark, sf_dir):
    """NEW when no earlier visit of the same patient exists (full history)."""
    t = _t(spark, sf_dir)
    v = scheme.completed_visits_closed(t.visit, VISIT_START, VISIT_END).select("vn", "hn", "created_at")
    v = flag_new_no_earlier(v, t.history())
    return v.select("vn", "hn", F.when(F.col("is_new"), "NEW").otherwise("OLD").alias("p_type"))


@register("new_old_by_first_visit")
def q_new_old_by_first_visit(spark, sf_dir):
    """J12/P3: 'ใหม่' when the visit time equals the patient's first visit (inner join)."""
    t = _t(spark, sf_dir)
    v = t.visit.where((F.col("latest_status_code") == "completed") & half_open("created_at", VISIT_START, VISIT_END))
    v = flag_new_inner(v.select("vn", "hn", "created_at"), t.history())
    return v.select("vn", "hn", F.when(F.col("is_new"), "ใหม่").otherwise("เก่า").alias("patient_type"))


@register("first_visit")
def q_first_visit(spark, sf_dir):
    """MIN(created_at) per patient over all visits."""
    h = _t(spark, sf_dir).history()
    fv = first_visits(h, h)
    return fv.select("hn", _ts_text("first_created_at").alias("first_created_at"))


# ---------------------------------------------------------------- R5 clinic new/old
@register("new_old_by_clinic")
def q_new_old_by_clinic(spark, sf_dir):
    rows = clinic_type.clinic_visit_rows(_t(spark, sf_dir), VISIT_START, VISIT_END)
    return clinic_type.clinic_summary(rows)


@register("clinic_report")
def q_clinic_report(spark, sf_dir):
    r = clinic_type.clinic_report(_t(spark, sf_dir), VISIT_START, VISIT_END)
    return r.content.select(F.col("sort_order").cast("bigint").alias("sort_order"), "clinic_name", *clinic_type.COUNT_COLS)


@register("union_total_row")
def q_union_total_row(spark, sf_dir):
    """Clinic rows + Total row, printed label."""
    c = clinic_type.clinic_content(_t(spark, sf_dir), VISIT_START, VISIT_END)
    return c.select(
        F.col("sort_order").cast("bigint").alias("sort_order"),
        clinic_type.print_label().alias("label"),
        *clinic_type.COUNT_COLS,
    )


@register("grand_total")
def q_grand_total(spark, sf_dir):
    """Sums over summaries (R5 total of per-clinic distincts)."""
    rows = clinic_type.clinic_visit_rows(_t(spark, sf_dir), VISIT_START, VISIT_END)
    s = clinic_type.clinic_summary(rows)
    return s.agg(*[F.sum(c).cast("bigint").alias(c) for c in clinic_type.COUNT_COLS])


@register("json_array_ordered")
def q_json_array_ordered(spark, sf_dir):
    """R5 content as one JSON array ordered by (sort_order, clinic_name);
    bounded by the number of clinics."""
    c = clinic_type.clinic_content(_t(spark, sf_dir), VISIT_START, VISIT_END)
    value = F.struct("clinic_name", *clinic_type.COUNT_COLS)
    return ordered_json_array(c, value, ["sort_order", "clinic_name"])


@register("json_empty_policy")
def q_json_empty_policy(spark, sf_dir):
    """Per department, the ordered JSON array of weekdays (1-7) with completed
    visits in active departments: '[]' fallback vs JSON null when it has none. Arrays hold <= 7 items."""
    t = _t(spark, sf_dir)
    v = scheme.completed_visits_closed(t.visit, VISIT_START, VISIT_END).select("department_ids", "created_at")
    v = explode_keep_empty(v, "department_ids", "department_id")
    v = v.join(department.active_departments(t).select(F.col("id").alias("department_id")), "department_id", "left_semi")
    days = v.select("department_id", F.dayofweek("created_at").alias("dow")).distinct()
    per = days.groupBy("department_id").agg(F.sort_array(F.collect_list("dow")).alias("dows"))
    d = t.department.select("id", "name")
    j = d.join(per, d["id"] == per["department_id"], "left")
    arr = F.to_json(F.col("dows"))
    return j.select(
        F.col("id").alias("department_id"),
        F.coalesce(arr, F.lit("[]")).alias("with_fallback"),
        arr.alias("as_null"),
    )


# ---------------------------------------------------------------- R3 appointment
@register("appointment_report")
def q_appointment_report(spark, sf_dir):
    return appointment.appointment_content(_t(spark, sf_dir), EVENT_START, EVENT_END).withColumn(
        "seq_no", F.col("seq_no").cast("bigint")
    )


@register("global_row_number")
def q_global_row_number(spark, sf_dir):
    """ROW_NUMBER() OVER (ORDER BY start, id) over all appointments, distributed."""
    a = _t(spark, sf_dir).appointment.select("id", "start")
    return global_row_number(a, ["start"], ["id"], out="seq_no").select(F.col("seq_no").cast("bigint"), "id")


@register("tz_wall_clock")
def q_tz_wall_clock(spark, sf_dir):
    """Stored UTC wall clock -> Asia/Bangkok wall clock."""
    a = _t(spark, sf_dir).appointment
    return a.select("id", _ts_text(D.to_report_tz("start")).alias("local_start"))


@register("iso_timestamps")
def q_iso_timestamps(spark, sf_dir):
    """Instants as ISO-8601 text with the Bangkok offset."""
    a = _t(spark, sf_dir).appointment
    return a.select("id", D.iso_instant_text("start").alias("start_iso"))


@register("fmt_date")
def q_fmt_date(spark, sf_dir):
    a = _t(spark, sf_dir).appointment
    return a.select("id", D.fmt_date(D.to_report_tz("start")).alias("appointment_date"))


@register("fmt_time")
def q_fmt_time(spark, sf_dir):
    a = _t(spark, sf_dir).appointment
    return a.select("id", D.fmt_time(D.to_report_tz("start")).alias("appointment_time"))


# ---------------------------------------------------------------- R4 diagnosis
@register("diagnosis_rows")
def q_diagnosis_rows(spark, sf_dir):
    return diagnosis.diagnosis_rows(_dx(spark, sf_dir), EVENT_START, EVENT_END)


@register("json_explode_diagnosis")
def q_json_explode_diagnosis(spark, sf_dir):
    """Every diagnosis element with a code, over all visits."""
    v = _dx(spark, sf_dir).visit
    dx = v.select("vn", F.explode(object_texts("diagnosis")).alias("item")).select("vn", element_fields("item").alias("dx"))
    return dx.where(F.col("dx.code").isNotNull()).select(
        "vn", F.col("dx.code").alias("diagnosis_code"), F.col("dx.display").alias("diagnosis_name")
    )


@register("diagnosis_by_gender")
def q_diagnosis_by_gender(spark, sf_dir):
    t = _dx(spark, sf_dir)
    rows = diagnosis.diagnosis_rows(t, EVENT_START, EVENT_END)
    return diagnosis.diagnosis_by_gender(rows, t.patient)


@register("diagnosis_by_folded_code")
def q_diagnosis_by_folded_code(spark, sf_dir):
    """Codes written in either case counted as one, as the template groups them."""
    t = _dx(spark, sf_dir)
    rows = diagnosis.diagnosis_rows(t, EVENT_START, EVENT_END)
    mixed = F.when(F.col("hn") % 2 == 0, F.lower("diagnosis_code")).otherwise(F.col("diagnosis_code"))
    out = diagnosis.diagnosis_by_gender(rows.withColumn("diagnosis_code", mixed), t.patient, "UTF8_LCASE")
    return out.select(F.upper("diagnosis_code").alias("diagnosis_code"), "male", "female", "total")


@register("sort_text_date")
def q_sort_text_date(spark, sf_dir):
    """O1: position in (hn, DD/MM/YYYY text) order, text compared as text."""
    rows = diagnosis.diagnosis_rows(_dx(spark, sf_dir), EVENT_START, EVENT_END)
    n = global_row_number(rows, ["hn", "visit_date"], ["diagnosis_code", "diagnosis_name"], out="pos")
    return n.select(F.col("pos").cast("bigint"), "hn", "visit_date", "diagnosis_code")


@register("meta_row")
def q_meta_row(spark, sf_dir):
    """The R4 meta row (``generated_at`` left out of comparisons)."""
    r = diagnosis.diagnosis_report(_dx(spark, sf_dir), EVENT_START, EVENT_END)
    return r.meta.select(
        "report_name",
        _ts_text("start_datetime").alias("start_datetime"),
        _ts_text("end_datetime").alias("end_datetime"),
        F.col("total_records").cast("bigint").alias("total_records"),
    )


@register("gender_normalise")
def q_gender_normalise(spark, sf_dir):
    p = _t(spark, sf_dir).patient
    return p.select("hn", X.gender_normalise("gender").alias("gender_group"))


# ---------------------------------------------------------------- R6 service time
def _r6(spark, sf_dir):
    return service_time.service_content(_t(spark, sf_dir), VISIT_START, VISIT_END)


@register("service_time")
def q_service_time(spark, sf_dir):
    return _r6(spark, sf_dir).withColumn("seq_no", F.col("seq_no").cast("bigint"))


def _r6_numbered(spark, sf_dir):
    return service_time.service_numbered(_t(spark, sf_dir), VISIT_START, VISIT_END)


@register("service_time_runs")
def q_service_time_runs(spark, sf_dir):
    r = service_time.service_runs(_r6_numbered(spark, sf_dir))
    return r.select(F.col("display_index").cast("bigint"), F.col("seq_no").cast("bigint"), "hn")


@register("null_placeholders")
def q_null_placeholders(spark, sf_dir):
    """P9: '-' for missing times, '' for a NULL or 0 turnaround."""
    r = service_time.service_runs(_r6_numbered(spark, sf_dir))
    return r.select(
        F.col("display_index").cast("bigint"),
        "register_time",
        "screening_time",
        "doctor_time",
        "completed_time",
        "tat_text",
    )


@register("service_time_run_count")
def q_service_time_run_count(spark, sf_dir):
    return service_time.service_run_count(_r6(spark, sf_dir))


def _co_located(spark, sf_dir, names):
    t = _t(spark, sf_dir)
    few = Tables(**{n: t.history() if n == "visit_history" else getattr(t, n) for n in names})
    return layout.scratch_database(spark, int(spark.conf.get("spark.sql.shuffle.partitions")), few, names)


@register("service_time_co_located")
def q_service_time_co_located(spark, sf_dir):
    """J13 over facts bucketed by visit: joins without a shuffle."""
    t = _co_located(spark, sf_dir, ("visit", "encounter", "queue"))
    rows = service_time.service_rows(t, VISIT_START, VISIT_END)
    return rows.select("vn", "en", "hn", "register_time", "screening_time", "doctor_time", "completed_time", "tat_minutes")


@register("first_visit_co_located")
def q_first_visit_co_located(spark, sf_dir):
    """J12/A6 over a history bucketed by patient: grouped and joined without a shuffle."""
    h = _co_located(spark, sf_dir, ("visit_history",)).history()
    fv = first_visits(h, h.where(half_open("created_at", VISIT_START, VISIT_END)))
    return fv.select("hn", _ts_text("first_created_at").alias("first_created_at"))


@register("turnaround_minutes")
def q_turnaround_minutes(spark, sf_dir):
    """Rounded minutes from visit creation to encounter completion."""
    t = _t(spark, sf_dir)
    j = t.visit.select("vn", "created_at").join(t.encounter.select("vn", "en", "completed_at"), "vn")
    return j.select("vn", "en", X.minutes_between("completed_at", "created_at").alias("tat_minutes"))


@register("count_records")
def q_count_records(spark, sf_dir):
    """A1: COUNT(*) of the R4, R6 and R7 row sets."""
    t = _t(spark, sf_dir)
    dx = diagnosis.diagnosis_rows(_dx(spark, sf_dir), EVENT_START, EVENT_END)
    st = service_time.service_rows(t, VISIT_START, VISIT_END)
    cv = completed_visits.completed_rows(t, VISIT_START, VISIT_END)
    return spark.range(1).select(
        dx.agg(F.count(F.lit(1))).scalar().alias("diagnosis_records"),
        st.agg(F.count(F.lit(1))).scalar().alias("service_records"),
        cv.agg(F.count(F.lit(1))).scalar().alias("completed_records"),
    )


# ---------------------------------------------------------------- R7 completed visits
@register("completed_visits")
def q_completed_visits(spark, sf_dir):
    return completed_visits.completed_rows(_t(spark, sf_dir), VISIT_START, VISIT_END)


@register("clinic_by_gender")
def q_clinic_by_gender(spark, sf_dir):
    t = _t(spark, sf_dir)
    rows = completed_visits.completed_rows(t, VISIT_START, VISIT_END)
    return completed_visits.clinic_by_gender(rows, t.patient)


@register("clinic_gender_total")
def q_clinic_gender_total(spark, sf_dir):
    """Grand total of the clinic x gender summary."""
    return completed_visits.clinic_gender_total(q_clinic_by_gender(spark, sf_dir))


@register("int_or_zero")
def q_int_or_zero(spark, sf_dir):
    """The number of each diagnosis event, 0 where it is missing or no number."""
    k = F.when(F.col("event_id") % 7 != 0, F.get_json_object("props", "$.k"))
    text = F.when(F.col("event_id") % 5 == 0, F.concat(k, F.lit("x"))).otherwise(k)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", X.int_or_zero(text).cast("bigint").alias("k"))


@register("buddhist_date")
def q_buddhist_date(spark, sf_dir):
    """Buddhist-era date text of each visit (29 Feb clamps)."""
    v = _t(spark, sf_dir).visit
    return v.select("vn", D.buddhist_date_text("created_at").alias("be_date"))


@register("thai_short_date")
def q_thai_short_date(spark, sf_dir):
    """X22/X23: 'd MMM YY' of each visit day and of the next day."""
    v = _t(spark, sf_dir).visit
    return v.select(
        "vn",
        D.thai_short_date("created_at").alias("thai_date"),
        D.thai_short_date(D.next_day("created_at"), pad_year=False).alias("thai_next_day"),
    )


@register("parse_be_date")
def q_parse_be_date(spark, sf_dir):
    """BE 'DD/MM/YYYY' text back to a date; ISO date part of a text."""
    v = _t(spark, sf_dir).visit.select("vn", D.buddhist_date_text("created_at").alias("be"), _ts_text("created_at").alias("iso"))
    return v.select(
        "vn",
        D.fmt_iso_date(D.parse_be_date("be")).alias("parsed"),
        D.iso_date_part(F.regexp_replace("iso", " ", "T")).alias("iso_date"),
    )


# ---------------------------------------------------------------- R8 plan summary
def _r8(spark, sf_dir):
    return plan_summary.plan_content(_t(spark, sf_dir), VISIT_START, VISIT_END)


@register("plan_summary")
def q_plan_summary(spark, sf_dir):
    s = plan_summary.plan_summary(_r8(spark, sf_dir))
    return s.select("insurance_plan", "new_people", "old_visits", "people", "visits", _dbl("percent"))


@register("plan_summary_total")
def q_plan_summary_total(spark, sf_dir):
    c = _r8(spark, sf_dir)
    return plan_summary.plan_summary_total(c, plan_summary.plan_summary(c))


# ---------------------------------------------------------------- R9 cashier
@register("cashier_detail")
def q_cashier_detail(spark, sf_dir):
    d = cashier.cashier_detail(standins.cashier(spark, sf_dir))
    return d.select("patient_type", "visit_time", "insurance_name", _dbl("amount"), "amount_text")


@register("cashier_by_name")
def q_cashier_by_name(spark, sf_dir):
    """The cashier listing and its subtotals through the report catalog, in one frame."""
    r = catalog.run_report(_t(spark, sf_dir), "cashier", {"p-start": "1995-01-01", "p-end": "2001-12-31"})
    listing = r.content.select(F.lit("listing").alias("kind"), "patient_type", "visit_time", _dbl("amount"))
    totals = r.extras["rollup"].select(F.col("level").alias("kind"), "patient_type", "visit_time", F.col("total").cast("double").alias("amount"))
    return listing.unionByName(totals)


@register("cashier_rollup")
def q_cashier_rollup(spark, sf_dir):
    r = cashier.cashier_rollup(standins.cashier(spark, sf_dir))
    return r.select("level", "patient_type", "visit_time", _dbl("total"), "total_text")


@register("fmt_numbers")
def q_fmt_numbers(spark, sf_dir):
    """X26: '{:,.2f}' of every cashier amount (``amount or 0``)."""
    c = standins.cashier(spark, sf_dir)
    return c.select("vn", X.fmt_number(F.coalesce(F.col("amount"), F.lit(0)), 2).alias("amount_text"))
