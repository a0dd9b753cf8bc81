"""Patients by insurance plan (new people, old visits, people, visits, %).

The source names this report but ships no producer function; only its
content contract ``(insurance_plan, hn, patient_type)`` and the summary rules
of its template are known. ``plan_content`` is our producer, by analogy with
the other reports: in-range completed, active, non-deleted visits, first
plan's name, NEW when no earlier visit of the patient exists (full history).

Summary rules: new people = distinct patients with a NEW row; old visits =
rows that are not NEW (also NULL type); people = distinct patients (a NULL
patient counts once, like list membership); visits = new people + old
visits; percent of all visits. Totals: sums of the row figures, but people =
distinct patients across all plans. Two-step aggregation (plan, hn) -> plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.functions.labels import NEW_PATIENT_TH, OLD_PATIENT_TH, STATUS_COMPLETED
from clinicflow.operators.history import flag_new_no_earlier
from clinicflow.operators.percent import pct_of_total
from clinicflow.params import half_open, is_true, not_deleted, prune_partitions
from clinicflow.plans.base import Report, bound, meta_row
from clinicflow.plans.scheme import with_plan
from clinicflow.sources.tables import Tables


def plan_content(t: Tables, start, end) -> DataFrame:
    v = prune_partitions(t.visit, start, end).where(
        is_true("active")
        & not_deleted()
        & (F.col("latest_status_code") == STATUS_COMPLETED)
        & half_open("created_at", start, end)
    ).select("vn", "hn", "created_at", "insurance_plan_ids")
    v = with_plan(v, t.insurance_plan)
    v = flag_new_no_earlier(v, t.history(), "hn", "created_at", t.first_visit_table())
    return v.select(
        F.col("plan_name").alias("insurance_plan"),
        "hn",
        F.when(F.col("is_new"), F.lit(NEW_PATIENT_TH)).otherwise(F.lit(OLD_PATIENT_TH)).alias("patient_type"),
    )


def plan_summary(content: DataFrame) -> DataFrame:
    """A16 + W3: one row per plan (NULL plan is its own row)."""
    is_new = F.coalesce(F.col("patient_type") == NEW_PATIENT_TH, F.lit(False))
    per_hn = content.groupBy("insurance_plan", "hn").agg(
        F.max(is_new.cast("int")).alias("has_new"),
        F.count_if(~is_new).alias("old_rows"),
    )
    per_plan = per_hn.groupBy("insurance_plan").agg(
        F.count_if(F.col("has_new") == 1).alias("new_people"),
        F.sum("old_rows").cast("bigint").alias("old_visits"),
        F.count(F.lit(1)).alias("people"),
    )
    per_plan = per_plan.withColumn("visits", F.col("new_people") + F.col("old_visits"))
    return pct_of_total(per_plan, "visits", "percent")


def plan_summary_total(content: DataFrame, summary: DataFrame) -> DataFrame:
    """Sums of the row figures; people = distinct patients over all plans."""
    people = content.agg(
        (F.count_distinct("hn") + F.max(F.col("hn").isNull().cast("int"))).cast("bigint")
    ).scalar()
    return summary.agg(
        F.coalesce(F.sum("new_people"), F.lit(0)).cast("bigint").alias("new_people"),
        F.coalesce(F.sum("old_visits"), F.lit(0)).cast("bigint").alias("old_visits"),
        F.coalesce(people, F.lit(0)).alias("people"),
        F.coalesce(F.sum("visits"), F.lit(0)).cast("bigint").alias("visits"),
    )


def plan_report(t: Tables, start, end) -> Report:
    content = plan_content(t, start, end)
    meta = meta_row(
        t.visit.sparkSession, {"start_timestamp": bound(start), "end_timestamp": bound(end)}, generated_at=False
    )
    return Report(meta=meta, content=content, extras={"summary": plan_summary(content)})
