"""New vs. old patients per clinic name, plus a Total row.

Plan: in-range completed visits flagged NEW when their time equals the
patient's first visit over the full history (inner join: NULL patients drop
out, as in the source) -> join to non-deleted encounters on ``vn`` (shuffled
on vn, AQE splits skew) -> clinic lookup (inner) ->
two-step distinct counts per clinic *name* (same-named clinics merge) ->
Total row = sums of the per-clinic distinct counts (not a global distinct).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.functions.labels import (
    NAME_CLINIC_TYPE,
    NEW_TH,
    OLD_TH,
    STATUS_COMPLETED,
    TOTAL_LABEL,
    TOTAL_LABEL_PRINT,
)
from clinicflow.operators.aggregates import distinct_by_flags, with_total_row
from clinicflow.operators.history import flag_new_inner
from clinicflow.operators.joins import lookup
from clinicflow.params import half_open, not_deleted, prune_partitions
from clinicflow.plans.base import Report, bound, meta_row
from clinicflow.sources.tables import Tables

COUNT_COLS = ["new_patients", "old_patients", "total_patients"]


def clinic_visit_rows(t: Tables, start, end) -> DataFrame:
    """``(clinic_name, hn, patient_type)`` per (encounter, visit) pair."""
    v = prune_partitions(t.visit, start, end).where(
        (F.col("latest_status_code") == STATUS_COMPLETED) & half_open("created_at", start, end)
    )
    v = flag_new_inner(v.select("vn", "hn", "created_at"), t.history(), "hn", "created_at", t.first_visit_table())
    e = t.encounter.where(not_deleted()).select("vn", "clinic_id")
    j = e.join(v, "vn", "inner")
    j = lookup(j, "clinic_id", t.clinic, "id", {"name": "clinic_name"}, how="inner")
    return j.select(
        "clinic_name",
        "hn",
        F.when(F.col("is_new"), F.lit(NEW_TH)).otherwise(F.lit(OLD_TH)).alias("patient_type"),
    )


def clinic_summary(rows: DataFrame) -> DataFrame:
    """Distinct new / old patients per clinic name, total = new + old."""
    s = distinct_by_flags(
        rows,
        ["clinic_name"],
        "hn",
        {"new_patients": F.col("patient_type") == NEW_TH, "old_patients": F.col("patient_type") == OLD_TH},
    )
    return s.withColumn("total_patients", F.col("new_patients") + F.col("old_patients"))


def clinic_content(t: Tables, start, end) -> DataFrame:
    """Clinic rows then the Total row (NULL sums on empty input)."""
    return with_total_row(clinic_summary(clinic_visit_rows(t, start, end)), "clinic_name", TOTAL_LABEL, COUNT_COLS)


def print_label(col="clinic_name"):
    """The printed label of the total row."""
    return F.when(F.col(col) == TOTAL_LABEL, F.lit(TOTAL_LABEL_PRINT)).otherwise(F.col(col))


def clinic_report(t: Tables, start, end, hospital_name: str | None = None) -> Report:
    """``hospital_name`` is the issuing hospital shown in meta (deployment setting)."""
    meta = meta_row(
        t.visit.sparkSession,
        {
            "hospital_name": F.lit(hospital_name).cast("string"),
            "report_name": F.lit(NAME_CLINIC_TYPE),
            "start_timestamp": bound(start),
            "end_timestamp": bound(end),
        },
        generated_at=False,
    )
    return Report(meta=meta, content=clinic_content(t, start, end), order=("sort_order", "clinic_name"), empty="[]")
