"""Percent of grand total and running (cumulative) percent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicflow.functions.expr import name_order, pct_half_up


def pct_of_total(df: DataFrame, value_col: str, out: str = "percent", total_col: str | None = None) -> DataFrame:
    """``ROUND(v / SUM(v) * 100, 2)`` (0 when the sum is 0), decimal.

    For summaries with one row per department / plan: the grand total is a
    window over all rows of that small frame (one task), not a second pass
    over the facts that produced it.
    """
    grand = F.coalesce(F.sum(value_col).over(Window.partitionBy()), F.lit(0))
    out_df = df.withColumn(out, pct_half_up(F.col(value_col), grand))
    if total_col:
        out_df = out_df.withColumn(total_col, grand.cast("bigint"))
    return out_df


def cumulative(df: DataFrame, value_col: str, order_col: str, out: str, collation: str | None = None) -> DataFrame:
    """W2 ``SUM(v) OVER (ORDER BY k)`` with the default RANGE frame: rows with
    equal ``k`` (by ``collation``, if given) share the peer total; NULL keys sort
    last (PostgreSQL order).

    Runs on an aggregated result (one row per department / plan); an
    un-partitioned window gathers those rows into one task, which is bounded
    by the dimension size, never by the fact table.
    """
    w = Window.orderBy(name_order(order_col, collation))
    return df.withColumn(out, F.sum(value_col).over(w))
