"""Cashier subtotals over (patient_type, visit_time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.functions.labels import CASHIER_PATIENT_TYPES, CASHIER_VISIT_TIMES


def subtotal_rollup(content: DataFrame, amount: str = "amount") -> DataFrame:
    """Sums of ``amount or 0`` for each (patient_type, visit_time) cell, per
    patient type and overall, restricted to the known types and times.

    Output: ``level`` ('cell' | 'patient_type' | 'all'), ``patient_type``,
    ``visit_time``, ``total`` (decimal). Every cell of the fixed 2x2 frame is
    present (0 when empty). ``ROLLUP`` with ``grouping_id`` does the subtotals
    in one aggregation; the fixed frame (4 + 2 + 1 rows) is left-joined so
    empty cells print 0 and empty input still gives all seven rows.
    """
    spark = content.sparkSession
    known = content.where(
        F.col("patient_type").isin(*CASHIER_PATIENT_TYPES) & F.col("visit_time").isin(*CASHIER_VISIT_TIMES)
    )
    agg = (
        known.rollup("patient_type", "visit_time")
        .agg(
            F.sum(F.coalesce(F.col(amount), F.lit(0))).alias("_sum"),
            F.grouping_id().alias("_gid"),
        )
    )
    frame_rows = [("cell", p, t, 0) for p in CASHIER_PATIENT_TYPES for t in CASHIER_VISIT_TIMES]
    frame_rows += [("patient_type", p, None, 1) for p in CASHIER_PATIENT_TYPES]
    frame_rows += [("all", None, None, 3)]
    frame = spark.createDataFrame(frame_rows, "level string, patient_type string, visit_time string, _gid int")
    cond = (
        (frame["_gid"] == agg["_gid"])
        & frame["patient_type"].eqNullSafe(agg["patient_type"])
        & frame["visit_time"].eqNullSafe(agg["visit_time"])
    )
    return frame.join(F.broadcast(agg), cond, "left").select(
        frame["level"],
        frame["patient_type"],
        frame["visit_time"],
        F.coalesce(agg["_sum"], F.lit(0)).cast("decimal(20,2)").alias("total"),
    )
