"""Aggregation operators: conditional pivots, two-step distinct counts, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_counts(df: DataFrame, group_cols: list, spec: dict[str, Column], weight: Column | None = None) -> DataFrame:
    """A5 ``COALESCE(SUM(CASE WHEN cond THEN 1 END), 0)`` per output column.

    With ``weight`` each row counts ``weight`` times (a fan-out folded into a
    weighted sum). Partial aggregation runs map-side; ``group_cols=[]`` is a
    global aggregate that yields exactly one row, also on empty input (A11).
    """
    w = F.lit(1).cast("bigint") if weight is None else weight
    aggs = [F.coalesce(F.sum(F.when(cond, w)), F.lit(0)).cast("bigint").alias(name) for name, cond in spec.items()]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def distinct_by_flags(
    df: DataFrame,
    group_cols: list[str],
    key: str,
    flags: dict[str, Column],
    total_distinct: str | None = None,
    row_count: dict[str, Column] | None = None,
) -> DataFrame:
    """A4 ``COUNT(DISTINCT CASE WHEN flag THEN key END)`` for several flags.

    Two steps instead of one ``Expand`` copy per distinct expression:
    (group, key) -> ``max(flag)`` per flag and row counts, then per group
    count the keys with each flag. NULL keys are not counted as distinct
    keys (as ``COUNT(DISTINCT)``), but their rows still count in
    ``row_count`` (``{name: counted_column}`` -> ``COUNT(column)``).
    """
    row_count = row_count or {}
    step1 = df.groupBy(*group_cols, key).agg(
        *[F.max(cond.cast("int")).alias(f"_f_{n}") for n, cond in flags.items()],
        *[F.count(c).alias(f"_r_{n}") for n, c in row_count.items()],
    )
    has_key = F.col(key).isNotNull()
    aggs = [F.count_if(has_key & (F.col(f"_f_{n}") == 1)).alias(n) for n in flags]
    if total_distinct:
        aggs.append(F.count_if(has_key).alias(total_distinct))
    aggs += [F.coalesce(F.sum(f"_r_{n}"), F.lit(0)).cast("bigint").alias(n) for n in row_count]
    return step1.groupBy(*group_cols).agg(*aggs)


def with_total_row(
    detail: DataFrame,
    label_col: str,
    label: str,
    sum_cols: list[str],
    order_col: str = "sort_order",
) -> DataFrame:
    """Detail rows (``sort_order`` 0) UNION ALL one total row (1).

    The total is summed from the detail frame, which is already aggregated,
    so the fact table is read once. Counts are cast to bigint on both sides.
    """
    d = detail.select(
        F.col(label_col).cast("string").alias(label_col),
        *[F.col(c).cast("bigint").alias(c) for c in sum_cols],
        F.lit(0).alias(order_col),
    )
    t = detail.agg(
        F.lit(label).alias(label_col),
        *[F.sum(c).cast("bigint").alias(c) for c in sum_cols],
        F.lit(1).alias(order_col),
    )
    return d.unionByName(t)
