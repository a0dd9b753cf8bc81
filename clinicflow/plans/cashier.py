"""Cashier income by OPD/IPD x in/after hours, with subtotals.

The source names this report but ships no producer function: only the
content contract ``(patient_type, visit_time, insurance_name, amount)`` and
the template's data work are known, so the report starts from content rows
(stand-in: ``sources.standins.cashier``).

* ``cashier_detail``: the listing - rows of the four known cells whose
  ``amount or 0`` is not 0 (zero rows still count in the sums).
* ``cashier_rollup``: cell sums, per-patient-type sums and the overall sum
  in one ROLLUP aggregation over a fixed 2x2 frame (see operators.rollup).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.functions.expr import fmt_number
from clinicflow.functions.labels import CASHIER_PATIENT_TYPES, CASHIER_VISIT_TIMES
from clinicflow.operators.rollup import subtotal_rollup
from clinicflow.params import closed
from clinicflow.plans.base import Report, bound, meta_row
from clinicflow.sources.tables import Tables


def cashier_detail(content: DataFrame) -> DataFrame:
    """F12 + F13: listing rows of the known cells with a non-zero amount."""
    amount = F.coalesce(F.col("amount"), F.lit(0))
    return content.where(
        F.col("patient_type").isin(*CASHIER_PATIENT_TYPES)
        & F.col("visit_time").isin(*CASHIER_VISIT_TIMES)
        & (amount != 0)
    ).select("patient_type", "visit_time", "insurance_name", "amount", fmt_number(amount, 2).alias("amount_text"))


def cashier_rollup(content: DataFrame) -> DataFrame:
    """Subtotals with printed amounts."""
    r = subtotal_rollup(content)
    return r.withColumn("total_text", fmt_number("total", 2))


def cashier_report(content: DataFrame, start=None, end=None) -> Report:
    """R9 as a report: the listing as content, the subtotals as ``extras['rollup']``."""
    meta = meta_row(
        content.sparkSession,
        {"start_datetime": bound(start) if start else F.lit(None).cast("timestamp_ntz"),
         "end_datetime": bound(end) if end else F.lit(None).cast("timestamp_ntz")},
    )
    return Report(
        meta=meta,
        content=cashier_detail(content),
        order=("patient_type", "visit_time", "insurance_name"),
        extras={"rollup": cashier_rollup(content)},
    )


def cashier_of(t: Tables, start, end) -> Report:
    """R9 from the optional table ``cashier`` of content rows; those of the range, if they carry a ``created_at``."""
    content = t.optional("cashier")
    if content is None:
        raise ValueError("the cashier report needs a table 'cashier' of its content rows")
    if "created_at" in content.columns:
        content = content.where(closed("created_at", start, end))
    return cashier_report(content, start, end)
