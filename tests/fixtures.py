"""Hand-made logical tables for the cases the stand-ins cannot show."""

from __future__ import annotations

import datetime as dt

from clinicflow.sources.tables import Tables

VISIT_SCHEMA = (
    "vn bigint, hn bigint, created_at timestamp_ntz, active boolean, deleted_at timestamp_ntz, "
    "latest_status_code string, insurance_plan_ids array<bigint>, department_ids array<bigint>, "
    "clinic_ids array<bigint>, diagnosis string"
)
ENCOUNTER_SCHEMA = "vn bigint, en bigint, clinic_id bigint, created_at timestamp_ntz, completed_at timestamp_ntz, deleted_at timestamp_ntz"
QUEUE_SCHEMA = "en bigint, called_at timestamp_ntz"
APPOINTMENT_SCHEMA = (
    "id bigint, start timestamp_ntz, patient_hn bigint, clinic_id bigint, practitioner_id bigint, "
    "service_type string, current_status string, deleted_at timestamp_ntz"
)
DEPARTMENT_SCHEMA = "id bigint, name string, active boolean, deleted_at timestamp_ntz"
CLINIC_SCHEMA = "id bigint, name string"
PRACTITIONER_SCHEMA = "id bigint, display string"
PLAN_SCHEMA = "id bigint, nhso_insurance_plan_category_code string, name string"
PATIENT_SCHEMA = "hn bigint, gender string, info struct<th:struct<name:string>>"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def visit_row(vn, hn, created, *, active=True, deleted=None, status="completed", plans=(0,), depts=(1,), clinics=(1,), dx=None):
    return (
        vn,
        hn,
        ts(created),
        active,
        ts(deleted) if deleted else None,
        status,
        None if plans is None else list(plans),
        None if depts is None else list(depts),
        None if clinics is None else list(clinics),
        dx,
    )


def tables(spark, visits=(), encounters=(), queue=(), appointments=(), departments=None, clinics=None, patients=None):
    departments = departments if departments is not None else [(1, "Med", True, None), (2, "Surg", True, None)]
    clinics = clinics if clinics is not None else [(1, "A"), (2, "B")]
    patients = patients if patients is not None else []
    plans = [
        (0, "UCS", "Universal"),
        (1, "SSS", "Social"),
        (2, "OFC", "Officer"),
        (4, None, "เงินสด"),
        (6, None, "Other"),
    ]
    return Tables(
        visit=spark.createDataFrame(list(visits), VISIT_SCHEMA),
        encounter=spark.createDataFrame(list(encounters), ENCOUNTER_SCHEMA),
        queue=spark.createDataFrame(list(queue), QUEUE_SCHEMA),
        appointment=spark.createDataFrame(list(appointments), APPOINTMENT_SCHEMA),
        department=spark.createDataFrame(list(departments), DEPARTMENT_SCHEMA),
        clinic=spark.createDataFrame(list(clinics), CLINIC_SCHEMA),
        practitioner=spark.createDataFrame([(1, "Dr One")], PRACTITIONER_SCHEMA),
        insurance_plan=spark.createDataFrame(plans, PLAN_SCHEMA),
        patient=spark.createDataFrame(list(patients), PATIENT_SCHEMA),
    )
