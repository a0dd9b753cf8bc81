"""Diagnosis (ICD-10) rows and the code x gender summary.

Plan: pruned scan (status, deleted flag and the -7 h shifted range pushed
down as literals) -> JSON array parsed once, fanned out with ``explode`` (empty /
NULL / non-array drop the row; the report counts them), each element parsed once -> NULL codes dropped ->
Bangkok date text. The summary enriches rows with the patient's gender (left
join) and groups by code with conditional counts and ``min_by`` for the name
of the first row in print order: partial aggregation, no row collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.functions.dates import fmt_date, to_report_tz
from clinicflow.functions.expr import gender_normalise
from clinicflow.functions.jsonx import diagnosis_elements, element_fields, is_rejected, object_texts
from clinicflow.functions.labels import NAME_DIAGNOSIS, STATUS_COMPLETED
from clinicflow.operators.joins import enrich_patient
from clinicflow.params import not_deleted, prune_partitions, shifted
from clinicflow.plans.base import Report, bound, meta_row
from clinicflow.sources.tables import Tables

CONTENT_COLS = ["hn", "diagnosis_code", "diagnosis_name", "visit_date"]


def diagnosis_visits(t: Tables, start, end, shift_hours: int = 7) -> DataFrame:
    return prune_partitions(t.visit, start, end, hours=shift_hours).where(
        (F.col("latest_status_code") == STATUS_COMPLETED)
        & not_deleted()
        & shifted("created_at", start, end, shift_hours)
    )


def diagnosis_rejected(t: Tables, start, end, shift_hours: int = 7) -> DataFrame:
    """One row, the texts that are no JSON array and the elements without a code, none of which give a row."""
    items = F.coalesce(diagnosis_elements("diagnosis"), F.array().cast("array<struct<code:string,display:string>>"))
    without = F.size(F.filter(items, lambda x: x["code"].isNull()))
    return diagnosis_visits(t, start, end, shift_hours).agg(
        F.count_if(is_rejected("diagnosis")).alias("rejected_texts"),
        F.coalesce(F.sum(without), F.lit(0)).cast("bigint").alias("rejected_elements"),
    )


def diagnosis_rows(t: Tables, start, end, shift_hours: int = 7) -> DataFrame:
    items = diagnosis_visits(t, start, end, shift_hours).select("hn", "created_at", F.explode(object_texts("diagnosis")).alias("item"))
    dx = items.select("hn", "created_at", element_fields("item").alias("dx"))
    return dx.where(F.col("dx.code").isNotNull()).select(
        "hn",
        F.col("dx.code").alias("diagnosis_code"),
        F.col("dx.display").alias("diagnosis_name"),
        fmt_date(to_report_tz("created_at")).alias("visit_date"),
    )


def diagnosis_report(t: Tables, start, end, shift_hours: int = 7, enrich: bool = True) -> Report:
    """``enrich`` attaches ``patient.gender`` by ``hn`` (S11), as the summary needs."""
    rows = diagnosis_rows(t, start, end, shift_hours)
    content = enrich_patient(rows, t.patient, "hn", ("gender",)) if enrich and t.patient is not None else rows

    def meta_for(c: DataFrame) -> DataFrame:
        return meta_row(
            t.visit.sparkSession,
            {
                "report_name": F.lit(NAME_DIAGNOSIS),
                "start_datetime": bound(start),
                "end_datetime": bound(end),
                "total_records": c.agg(F.count(F.lit(1))).scalar(),
            },
        )

    # O1: hn, then the DD/MM/YYYY *text* (lexicographic), NULLS LAST.
    order = ("hn", "visit_date")
    extras = {"rejected": diagnosis_rejected(t, start, end, shift_hours)}
    return Report(meta=meta_for(rows), content=content, order=order, extras=extras, meta_fn=meta_for)


def diagnosis_by_gender(rows: DataFrame, patient: DataFrame, collation: str | None = None) -> DataFrame:
    """Per code (sorted), male / female counts, total = male + female
    (unknown gender excluded), name of the first row in (hn, visit_date) order.

    ``collation`` (``UTF8_LCASE`` as the template groups) makes codes one group that
    it holds for equal; the group shows the code of its first row.
    """
    # content that is already enriched (report content) keeps its patient struct
    e = rows if "patient" in rows.columns else enrich_patient(rows, patient, "hn", ("gender",))
    e = e.withColumn("g", gender_normalise(F.col("patient.gender")))
    first_key = F.struct(F.col("hn").isNull(), "hn", F.col("visit_date").isNull(), "visit_date", "diagnosis_name", "diagnosis_code")
    group = F.col("diagnosis_code") if collation is None else F.collate(F.col("diagnosis_code"), collation)
    out = e.groupBy(group.alias("_group")).agg(
        F.min_by("diagnosis_code", first_key).alias("diagnosis_code"),
        F.min_by("diagnosis_name", first_key).alias("diagnosis_name"),
        F.count_if(F.col("g") == "male").alias("male"),
        F.count_if(F.col("g") == "female").alias("female"),
    )
    return out.drop("_group").withColumn("total", F.col("male") + F.col("female"))
