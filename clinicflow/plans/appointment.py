"""Appointment list with a global sequence number.

Plan: pruned scan (deleted flag + half-open range pushed down) -> clinic and
practitioner lookups (left joins) -> Bangkok
wall-clock formatting (JVM built-ins) -> distributed ``ROW_NUMBER() OVER
(ORDER BY start)`` (range partitioning + per-partition offsets, no single
partition) -> optional patient enrichment (left join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.functions.dates import fmt_date, fmt_time, to_report_tz
from clinicflow.functions.labels import NAME_APPOINTMENT
from clinicflow.operators.joins import enrich_patient, lookup
from clinicflow.operators.ordering import global_row_number
from clinicflow.params import half_open, not_deleted, prune_partitions
from clinicflow.plans.base import Report, bound, meta_row
from clinicflow.sources.tables import Tables

CONTENT_COLS = [
    "seq_no",
    "hn",
    "appointment_date",
    "appointment_time",
    "clinic_name",
    "doctor_name",
    "appointment_type",
    "appointment_status",
]


def appointment_scan(t: Tables, start, end) -> DataFrame:
    return prune_partitions(t.appointment, start, end).where(not_deleted() & half_open("start", start, end))


def appointment_rows(t: Tables, start, end) -> DataFrame:
    """Rows before numbering, with the order key ``start`` and, where the table has one, ``id``."""
    a = appointment_scan(t, start, end)
    a = lookup(a, "clinic_id", t.clinic, "id", {"name": "clinic_name"})
    a = lookup(a, "practitioner_id", t.practitioner, "id", {"display": "doctor_name"})
    local = to_report_tz("start")
    return a.select(
        *[c for c in ("id",) if c in a.columns],
        "start",
        F.col("patient_hn").alias("hn"),
        fmt_date(local).alias("appointment_date"),
        fmt_time(local).alias("appointment_time"),
        "clinic_name",
        "doctor_name",
        F.col("service_type").cast("string").alias("appointment_type"),
        F.col("current_status").cast("string").alias("appointment_status"),
    )


def appointment_content(t: Tables, start, end, tiebreak=("id", "hn", "clinic_name", "doctor_name")) -> DataFrame:
    """``tiebreak``: columns that order rows of the same time, as far as the table has them."""
    rows = appointment_rows(t, start, end)
    tiebreak = [c for c in tiebreak if c in rows.columns]
    tiebreak = tiebreak[:1] if tiebreak[:1] == ["id"] else tiebreak  # unique on its own
    scan = appointment_scan(t, start, end).withColumnRenamed("patient_hn", "hn")
    numbered = global_row_number(rows, ["start"], list(tiebreak), out="seq_no", sketch=scan)
    return numbered.select(*CONTENT_COLS)


def appointment_report(t: Tables, start, end, enrich: bool = True) -> Report:
    content = appointment_content(t, start, end)
    if enrich and t.patient is not None:
        content = enrich_patient(content, t.patient, "hn", ("info",))
    meta = meta_row(
        t.appointment.sparkSession,
        {"report_name": F.lit(NAME_APPOINTMENT), "start_datetime": bound(start), "end_datetime": bound(end)},
    )
    return Report(meta=meta, content=content, order=("seq_no",))
