"""Completed visits per day x insurance-scheme group, plus a total row.

Plan: one pruned scan of ``visit`` (range + flags pushed to Parquet) ->
first plan id looked up in the plan dimension ->
department fan-out folded into a row weight (no explode) unless a department
filter needs the names -> per-day conditional counts (map-side partial
aggregation; the shuffle carries at most days x tasks rows) -> calendar spine
left join (both sides bounded by days) -> total row summed from the daily rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.functions.dates import fmt_date, to_report_tz
from clinicflow.functions.expr import plan_category
from clinicflow.functions.labels import (
    ALL_LABEL,
    NAME_SCHEME,
    SCHEME_CASH,
    SCHEME_KEYS,
    SCHEME_KEYS_TH,
    SCHEME_OFC,
    SCHEME_SSS,
    SCHEME_UCS,
    STATUS_COMPLETED,
    STORAGE_TZ,
    TOTAL_LABEL_TH,
)
from clinicflow.operators.aggregates import conditional_counts
from clinicflow.operators.arrays import explode_keep_empty, fanout_weight, first_element
from clinicflow.operators.joins import lookup
from clinicflow.operators.spine import date_spine, fill_spine
from clinicflow.params import closed, is_true, not_deleted, prune_partitions
from clinicflow.plans.base import Report, bound, meta_row
from clinicflow.sources.tables import Tables

COUNT_COLS = ["ucs", "sss", "ofc", "cash"]


def completed_visits_closed(visit: DataFrame, start, end) -> DataFrame:
    """S1 + F2 + F4-F6: active, not deleted, completed, ``start <= created_at <= end``."""
    return prune_partitions(visit, start, end).where(
        is_true("active")
        & not_deleted()
        & (F.col("latest_status_code") == STATUS_COMPLETED)
        & closed("created_at", start, end)
    )


def with_plan(v: DataFrame, plans: DataFrame) -> DataFrame:
    """LEFT JOIN insurance_plan ON id = insurance_plan_ids[1]."""
    v = v.withColumn("plan_id", first_element("insurance_plan_ids"))
    return lookup(v, "plan_id", plans, "id", {"nhso_insurance_plan_category_code": "plan_code", "name": "plan_name"})


def scheme_visit_rows(t: Tables, start, end, patient_category=None, dept_name=None, tz: str = STORAGE_TZ) -> DataFrame:
    """Visit rows with ``visit_date`` (the day in zone ``tz``), ``category`` and fan-out ``weight``."""
    v = completed_visits_closed(t.visit, start, end).select("created_at", "insurance_plan_ids", "department_ids")
    v = with_plan(v, t.insurance_plan)
    if patient_category is not None:
        # Compares the raw category code, so derived CASH/OTHER never match.
        v = v.where(F.col("plan_code") == F.lit(patient_category))
    if dept_name is None:
        v = v.withColumn("weight", fanout_weight("department_ids"))
    else:
        v = explode_keep_empty(v, "department_ids", "department_id")
        v = lookup(v, "department_id", t.department, "id", {"name": "department_name"})
        v = v.where(F.col("department_name") == F.lit(dept_name)).withColumn("weight", F.lit(1).cast("bigint"))
    return v.select(
        F.to_date(to_report_tz("created_at", tz)).alias("visit_date"),
        plan_category("plan_code", "plan_name").alias("category"),
        "weight",
    )


def _spec():
    c = F.col("category")
    return {
        "ucs": c.isin(*SCHEME_UCS),
        "sss": c.isin(*SCHEME_SSS),
        "ofc": c.isin(*SCHEME_OFC),
        "cash": c.isin(*SCHEME_CASH),
    }


def scheme_counts(t: Tables, visits: DataFrame, start, end) -> DataFrame:
    """What ``visits`` add to each day's counts: the contribution that ``increments.apply_batch`` takes back or adds."""
    rows = scheme_visit_rows(t.with_tables(visit=visits), start, end)
    return conditional_counts(rows, ["visit_date"], _spec(), weight=F.col("weight"))


def scheme_daily(t: Tables, start, end, patient_category=None, dept_name=None, tz: str = STORAGE_TZ) -> DataFrame:
    """One row per calendar day of the range: visit_date, ucs, sss, ofc, cash."""
    rows = scheme_visit_rows(t, start, end, patient_category, dept_name, tz)
    per_day = conditional_counts(rows, ["visit_date"], _spec(), weight=F.col("weight"))
    spine = date_spine(t.visit.sparkSession, start, end, "visit_date", tz)
    return fill_spine(spine, per_day, "visit_date", COUNT_COLS)


def scheme_daily_of(t: Tables, counts: DataFrame, start, end) -> DataFrame:
    """``scheme_daily`` from kept daily counts."""
    return fill_spine(date_spine(t.visit.sparkSession, start, end, "visit_date", STORAGE_TZ), counts, "visit_date", COUNT_COLS)


def scheme_total(daily: DataFrame) -> DataFrame:
    """The total row, one row also when there are no days."""
    return daily.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNT_COLS])


def scheme_content(daily: DataFrame) -> DataFrame:
    """Daily rows (date text) then the total row labelled ``รวม``."""
    days = daily.select(
        F.lit(0).alias("sort_order"), "visit_date", fmt_date("visit_date").alias("date_text"), *COUNT_COLS
    )
    total = scheme_total(daily).select(
        F.lit(1).alias("sort_order"),
        F.lit(None).cast("date").alias("visit_date"),
        F.lit(TOTAL_LABEL_TH).alias("date_text"),
        *COUNT_COLS,
    )
    return days.unionByName(total)


def scheme_report(t: Tables, start, end, patient_category=None, dept_name=None, tz: str = STORAGE_TZ) -> Report:
    """Days are those of zone ``tz``; the scan predicate stays on the stored column."""
    daily = scheme_daily(t, start, end, patient_category, dept_name, tz)
    content = scheme_content(daily)
    meta = meta_row(
        t.visit.sparkSession,
        {
            "report_name": F.lit(NAME_SCHEME),
            "start_datetime": bound(start),
            "end_datetime": bound(end),
            "dept_name": F.coalesce(F.lit(dept_name).cast("string"), F.lit(ALL_LABEL)),
            "patient_category": F.coalesce(F.lit(patient_category).cast("string"), F.lit(ALL_LABEL)),
        },
    )
    return Report(meta=meta, content=content, order=("sort_order", "visit_date"), keys=presentation_keys())


def presentation_keys() -> dict[str, str]:
    """ASCII column -> Thai presentation key of the printed rows."""
    mapping = dict(zip(SCHEME_KEYS, SCHEME_KEYS_TH))
    mapping["date_text"] = mapping.pop("visit_date")
    return mapping


def content_date_range(daily: DataFrame) -> DataFrame:
    """First and last date of the content rows (the total row excluded)."""
    return daily.agg(
        fmt_date(F.min("visit_date")).alias("first_date"), fmt_date(F.max("visit_date")).alias("last_date")
    )
