"""Service-time list (register -> screening -> doctor -> completed, turnaround).

Plan: in-range completed visits JOIN non-deleted encounters (on vn) LEFT JOIN
queue calls (on en): each table is scanned once, one row per (visit, encounter, call) -> Bangkok
wall-clock times and exact turnaround minutes (decimal, half away from zero)
-> distributed global row number ordered by the visit time. The printed
form collapses consecutive rows of the same patient (previous row found within
its range partition) and renumbers them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.functions.dates import fmt_time, to_report_tz
from clinicflow.functions.expr import blank_if_falsy, minutes_between, placeholder
from clinicflow.functions.labels import NAME_SERVICE_TIME, STATUS_COMPLETED
from clinicflow.operators.joins import enrich_patient
from clinicflow.operators.ordering import collapse_runs, global_row_number, mark_runs
from clinicflow.params import half_open, not_deleted, prune_partitions
from clinicflow.plans.base import Report, bound, meta_row
from clinicflow.sources.tables import Tables

CONTENT_COLS = ["seq_no", "hn", "register_time", "screening_time", "doctor_time", "completed_time", "tat_minutes"]


def service_visits(t: Tables, start, end) -> DataFrame:
    """The completed visits of the range."""
    v = prune_partitions(t.visit, start, end).where(
        (F.col("latest_status_code") == STATUS_COMPLETED) & half_open("created_at", start, end)
    )
    return v.select("vn", "hn", "created_at")


def service_rows(t: Tables, start, end) -> DataFrame:
    """One row per (visit, encounter, queue call), before numbering."""
    v = service_visits(t, start, end)
    e = t.encounter.where(not_deleted()).select(
        "vn", "en", F.col("created_at").alias("enc_created_at"), "completed_at"
    )
    # One pass: visits of the window meet their encounters, and these their queue calls.
    # Calls stored with their visit lie with it (``layout.write_co_located``): no shuffle.
    on = ["vn", "en"] if "vn" in t.queue.columns else ["en"]
    j = v.join(e, "vn", "inner").join(t.queue.select(*on, "called_at"), on, "left")
    return j.select(
        "vn",
        "en",
        "created_at",
        "called_at",
        "hn",
        fmt_time(to_report_tz("created_at")).alias("register_time"),
        fmt_time(to_report_tz("called_at")).alias("screening_time"),
        fmt_time(to_report_tz("enc_created_at")).alias("doctor_time"),
        fmt_time(to_report_tz("completed_at")).alias("completed_time"),
        minutes_between("completed_at", "created_at").alias("tat_minutes"),
    )


def service_numbered(t: Tables, start, end) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY created_at)``; ties broken by (vn, en,
    called_at). Keeps the place in its range for ``service_runs``. The sketch
    reads the visits alone, without the joins."""
    rows, visits = service_rows(t, start, end), service_visits(t, start, end)
    return global_row_number(rows, ["created_at"], ["vn", "en", "called_at"], out="seq_no", keep_position=True, sketch=visits)


def service_content(t: Tables, start, end) -> DataFrame:
    return service_numbered(t, start, end).select(*CONTENT_COLS)


def service_runs(content: DataFrame) -> DataFrame:
    """First row of each run of consecutive equal ``hn``, renumbered, printed
    with placeholders (``-`` for missing times, blank for a 0 / NULL turnaround).
    Pass ``service_numbered(...)`` to renumber inside the existing partitions."""
    kept = collapse_runs(content, "seq_no", "hn", out="display_index")
    return kept.select(
        "display_index",
        "seq_no",
        "hn",
        placeholder("register_time").alias("register_time"),
        placeholder("screening_time").alias("screening_time"),
        placeholder("doctor_time").alias("doctor_time"),
        placeholder("completed_time").alias("completed_time"),
        blank_if_falsy("tat_minutes").alias("tat_text"),
    )


def service_run_count(content: DataFrame) -> DataFrame:
    """Number of runs (the printed "people" figure)."""
    return mark_runs(content, "seq_no", "hn").agg(F.count_if("new_run").alias("runs"))


def service_time_report(t: Tables, start, end, enrich: bool = True) -> Report:
    """``enrich`` attaches ``patient.info`` (the printed name) by ``hn``."""
    content = service_content(t, start, end)

    def meta_for(c: DataFrame) -> DataFrame:
        return meta_row(
            t.visit.sparkSession,
            {
                "report_name": F.lit(NAME_SERVICE_TIME),
                "start_datetime": bound(start),
                "end_datetime": bound(end),
                "total_records": c.agg(F.count(F.lit(1))).scalar(),
            },
        )

    meta = meta_for(content)
    if enrich and t.patient is not None:
        content = enrich_patient(content, t.patient, "hn", ("info",))
    return Report(meta=meta, content=content, order=("seq_no",), meta_fn=meta_for)
