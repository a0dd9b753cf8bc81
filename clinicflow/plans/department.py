"""R2: per-department new/old/total patients, visits, percent, cumulative percent.

Plan: pruned scan of in-range completed visits -> NEW/OLD against the full
visit history via a per-patient ``min(created_at)`` (semi-join-reduced
history, partial aggregation; equal to the pairwise ``NOT EXISTS`` rule,
without comparing every pair of a patient's visits) -> department fan-out
(``explode_outer``) -> two-step distinct counts per department (no
``Expand``) -> department-preserving left join from the small, filtered
department dimension -> percent of the grand total (scalar subquery) ->
running percent over the department rows (bounded by the dimension).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.operators.aggregates import distinct_by_flags
from clinicflow.operators.arrays import explode_keep_empty
from clinicflow.operators.history import flag_new_no_earlier
from clinicflow.operators.percent import cumulative, pct_of_total
from clinicflow.operators.states import distinct_states, merge_states
from clinicflow.params import is_true, not_deleted
from clinicflow.plans.base import Report, bound, meta_row
from clinicflow.plans.scheme import completed_visits_closed, with_plan
from clinicflow.sources.tables import Tables

COUNT_COLS = ["new_patients", "old_patients", "total_patients", "total_visits"]


def department_visit_rows(t: Tables, start, end, patient_category=None) -> DataFrame:
    """Fan-out rows ``(department_id, vn, hn, created_at, is_new)``."""
    v = completed_visits_closed(t.visit, start, end)
    if patient_category is not None:
        v = with_plan(v, t.insurance_plan).where(F.col("plan_code") == F.lit(patient_category))
    v = v.select("vn", "hn", "created_at", "department_ids")
    v = flag_new_no_earlier(v, t.history(), "hn", "created_at", t.first_visit_table())
    v = explode_keep_empty(v, "department_ids", "department_id")
    return v.select("department_id", "vn", "hn", "created_at", "is_new")


def active_departments(t: Tables, dept_name=None) -> DataFrame:
    """Departments that are active and not deleted (optionally one name)."""
    d = t.department.where(is_true("active") & not_deleted())
    if dept_name is not None:
        d = d.where(F.col("name") == F.lit(dept_name))
    return d.select("id", "name")


def department_summary(t: Tables, start, end, patient_category=None, dept_name=None) -> DataFrame:
    """One row per active department (id, name), zeros kept."""
    # Rows without a department id can never join a department: drop them early.
    rows = department_visit_rows(t, start, end, patient_category).where(F.col("department_id").isNotNull())
    per_dept = distinct_by_flags(
        rows,
        ["department_id"],
        "hn",
        {"new_patients": F.col("is_new"), "old_patients": ~F.col("is_new")},
        total_distinct="total_patients",
        row_count={"total_visits": F.col("vn")},
    )
    return _per_active_department(t, per_dept, dept_name)


def _per_active_department(t: Tables, per_dept: DataFrame, dept_name=None) -> DataFrame:
    d = active_departments(t, dept_name)
    j = d.join(per_dept, d["id"] == per_dept["department_id"], "left")
    return j.select(
        F.col("id").alias("department_id"),
        F.col("name").alias("department"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNT_COLS],
    )


def _flags() -> dict:
    return {"new_patients": F.col("is_new"), "old_patients": ~F.col("is_new"), "total_patients": F.lit(True)}


def department_states(t: Tables, start, end, numbers: DataFrame) -> DataFrame:
    """Per day and department the bitmaps of new, old and all patients and the visits: kept, and merged for any window.

    New or old depends on the whole history, not on the window, so the states of
    two windows add up to those of both.
    """
    rows = department_visit_rows(t, start, end).where(F.col("department_id").isNotNull())
    rows = rows.withColumn("visit_date", F.to_date("created_at"))
    return distinct_states(rows, numbers, ["visit_date", "department_id"], "hn", _flags(), {"total_visits": F.col("vn")})


def department_summary_of(t: Tables, states: DataFrame, dept_name=None) -> DataFrame:
    """``department_summary`` of the days in ``states``."""
    per_dept = merge_states(states, ["department_id"], list(_flags()), ["total_visits"])
    return _per_active_department(t, per_dept, dept_name)


def department_content(summary: DataFrame, collation: str | None = None) -> DataFrame:
    """W3 + W2 + J8: percent of grand total visits and the running percent.

    The summary has one row per department, so the grand total is a window
    over all of its rows (one small task) instead of a second pass over the
    facts. ``collation`` (e.g. ``th``) orders the names of the running percent;
    names it holds for equal are peers.
    """
    out = pct_of_total(summary, "total_visits", "percent")
    out = cumulative(out, "percent", "department", "commulative_view", collation)
    return out.withColumn("commulative_view", F.col("commulative_view").cast("decimal(20,2)")).select(
        "department", *COUNT_COLS, "percent", "commulative_view"
    )


def department_foot(content: DataFrame) -> DataFrame:
    """The printed foot line, re-summed from the content rows."""
    return content.agg(
        F.coalesce(F.sum("new_patients"), F.lit(0)).cast("bigint").alias("sum_new"),
        F.coalesce(F.sum("old_patients"), F.lit(0)).cast("bigint").alias("sum_old"),
        F.coalesce(F.sum(F.col("new_patients") + F.col("old_patients")), F.lit(0)).cast("bigint").alias("sum_people"),
        F.coalesce(F.sum("total_visits"), F.lit(0)).cast("bigint").alias("sum_visits"),
    )


def department_report(t: Tables, start, end, patient_category=None, dept_name=None, collation: str | None = None) -> Report:
    """``collation``: the database's order of names (e.g. ``th``); binary order without it."""
    summary = department_summary(t, start, end, patient_category, dept_name)
    content = department_content(summary, collation)

    def meta_for(c: DataFrame) -> DataFrame:
        grand = c.agg(F.coalesce(F.sum("total_visits"), F.lit(0)).cast("bigint")).scalar()
        return meta_row(
            t.visit.sparkSession,
            {
                "start_datetime": bound(start),
                "end_datetime": bound(end),
                "patient_category": F.lit(patient_category).cast("string"),
                "department_filter": F.lit(dept_name).cast("string"),
                "grand_total_visits": grand,
            },
            generated_at=False,
        )

    departments = active_departments(t).select(F.col("name").alias("department"))
    return Report(
        meta=meta_for(content),
        content=content,
        order=("department",),
        collation=collation,
        extras={"departments": departments},
        meta_fn=meta_for,
    )
