"""Completed (visit, clinic) rows and the clinic x gender summary.

Plan: in-range completed visits (no active / deleted check, as in the
source) -> array-membership join ``clinic.id = ANY(visit.clinic_ids)``
rewritten as ``explode(array_distinct)`` + equi join (one row per distinct
clinic id) -> meta total = row count, BE date range. The summary enriches
with gender (left join) and groups by clinic id with conditional counts,
total = all rows; the running index and the grand total are computed on the
per-clinic result (bounded by the number of clinics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicflow.functions.dates import date_range_text, to_report_tz
from clinicflow.functions.expr import gender_normalise
from clinicflow.functions.labels import DATE_RANGE_PREFIX, NAME_COMPLETED, STATUS_COMPLETED
from clinicflow.operators.arrays import membership_join
from clinicflow.operators.joins import enrich_patient
from clinicflow.params import half_open, prune_partitions, ts_lit
from clinicflow.plans.base import Report, bound, meta_row
from clinicflow.sources.tables import Tables


def completed_rows(t: Tables, start, end) -> DataFrame:
    v = prune_partitions(t.visit, start, end).where(
        (F.col("latest_status_code") == STATUS_COMPLETED) & half_open("created_at", start, end)
    ).select("vn", "hn", "clinic_ids")
    j = membership_join(v, "clinic_ids", t.clinic.select("id", "name"), "id", out="clinic_id")
    return j.select(F.col("name").alias("clinic_name"), "clinic_id", "hn")


def completed_report(t: Tables, start, end, hospital_name: str | None = None, enrich: bool = True) -> Report:
    """``hospital_name`` is the issuing hospital shown in meta (deployment setting);
    ``enrich`` attaches ``patient.gender`` by ``hn`` (S11)."""
    rows = completed_rows(t, start, end)

    def meta_for(c: DataFrame) -> DataFrame:
        return meta_row(
            t.visit.sparkSession,
            {
                "hospital_name": F.lit(hospital_name).cast("string"),
                "report_name": F.lit(NAME_COMPLETED),
                "start_time": bound(start),
                "end_time": bound(end),
                "date_range": date_range_text(
                    to_report_tz(ts_lit(start)), to_report_tz(ts_lit(end)), DATE_RANGE_PREFIX
                ),
                "total": c.agg(F.count(F.lit(1))).scalar(),
            },
            generated_at=False,
        )

    content = enrich_patient(rows, t.patient, "hn", ("gender",)) if enrich and t.patient is not None else rows
    return Report(meta=meta_for(rows), content=content, order=("clinic_id", "hn"), empty="[]", meta_fn=meta_for)


def clinic_by_gender(rows: DataFrame, patient: DataFrame) -> DataFrame:
    """Per clinic id (sorted): male, female, total = all rows, running index."""
    # content that is already enriched (report content) keeps its patient struct
    e = rows if "patient" in rows.columns else enrich_patient(rows, patient, "hn", ("gender",))
    e = e.withColumn("g", gender_normalise(F.col("patient.gender")))
    per = e.groupBy("clinic_id").agg(
        F.min("clinic_name").alias("clinic_name"),
        F.count_if(F.col("g") == "male").alias("male"),
        F.count_if(F.col("g") == "female").alias("female"),
        F.count(F.lit(1)).alias("total"),
    )
    # One row per clinic: the un-partitioned window is bounded by the clinic count.
    return per.withColumn("idx", F.row_number().over(Window.orderBy("clinic_id")).cast("bigint"))


def clinic_gender_total(per_clinic: DataFrame) -> DataFrame:
    """A15 foot: grand totals of the per-clinic figures."""
    return per_clinic.agg(
        F.coalesce(F.sum("male"), F.lit(0)).cast("bigint").alias("male"),
        F.coalesce(F.sum("female"), F.lit(0)).cast("bigint").alias("female"),
        F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total"),
    )
