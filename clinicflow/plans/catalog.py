"""Run a report by name from registry-style parameters.

The report registry passes two date parameters per report under several
spellings (hyphenated or not) and normalises them to the start and end of
the day in the report zone. ``run_report`` maps those to the plan functions;
the bound arithmetic is a few Python datetime operations on the driver.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from clinicflow.functions.labels import REPORT_TZ, STORAGE_TZ
from clinicflow.plans import (
    appointment,
    cashier,
    clinic_type,
    completed_visits,
    department,
    diagnosis,
    plan_summary,
    scheme,
    service_time,
)
from clinicflow.plans.base import Report
from clinicflow.sources.tables import Tables

REPORTS = {
    "scheme": scheme.scheme_report,
    "department": department.department_report,
    "appointment": appointment.appointment_report,
    "diagnosis": diagnosis.diagnosis_report,
    "clinic_type": clinic_type.clinic_report,
    "service_time": service_time.service_time_report,
    "completed_visits": completed_visits.completed_report,
    "plan_summary": plan_summary.plan_report,
    "cashier": cashier.cashier_of,
}

# --- fixed values: parameter spellings used by the report registry ----------
START_KEYS = ("p_start", "p_start_datetime", "p_start_ts", "start_time", "start")
END_KEYS = ("p_end", "p_end_datetime", "p_end_ts", "end_time", "end")
OPTIONAL_KEYS = {"p_patient_category": "patient_category", "p_dept_name": "dept_name"}
# --- end of fixed values -----------------------------------------------------


def _as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def day_bounds(start_day, end_day, tz: str = REPORT_TZ, storage_tz: str = STORAGE_TZ) -> tuple[str, str]:
    """``startOfDay(start_day)`` and ``endOfDay(end_day)`` in ``tz``, as
    wall-clock text in the storage zone (the form the report bounds take)."""
    zone, store = ZoneInfo(tz), ZoneInfo(storage_tz)

    def to_store(d: dt.date, t: dt.time) -> str:
        local = dt.datetime.combine(d, t, tzinfo=zone)
        return local.astimezone(store).replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S.%f")

    return to_store(_as_date(start_day), dt.time.min), to_store(_as_date(end_day), dt.time.max)


def normalise_params(params: dict) -> dict:
    """Registry parameters -> ``{start, end, <optional filters>}``."""
    p = {str(k).replace("-", "_"): v for k, v in params.items()}
    start = next((p[k] for k in START_KEYS if k in p), None)
    end = next((p[k] for k in END_KEYS if k in p), None)
    if start is None or end is None:
        raise ValueError(f"a start and an end parameter are required, got {sorted(params)}")
    out = {"start": start, "end": end}
    for src, dst in OPTIONAL_KEYS.items():
        if p.get(src) is not None:
            out[dst] = p[src]
    return out


def run_report(t: Tables, name: str, params: dict, normalize: bool = True, tz: str = REPORT_TZ, **options) -> Report:
    """Build the named report; ``normalize`` applies startOfDay / endOfDay."""
    if name not in REPORTS:
        raise KeyError(f"unknown report {name!r}; known: {sorted(REPORTS)}")
    p = normalise_params(params)
    start, end = p.pop("start"), p.pop("end")
    if normalize:
        start, end = day_bounds(start, end, tz)
    if name == "scheme":  # its rows are days: those of the report zone
        options.setdefault("tz", tz)
    return REPORTS[name](t, start, end, **p, **options)
