"""Report bounds and parameter handling.

Bounds are given as wall-clock strings ``'YYYY-MM-DD HH:MM:SS'`` (or
``datetime``) in the storage zone of the timestamp columns (UTC wall clock,
``timestamp_ntz``). They become typed literals, so Catalyst folds them and
pushes the range into the Parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

BoundValue = "str | _dt.datetime | _dt.date"


def _text(value) -> str:
    if isinstance(value, _dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(value, _dt.date):
        return value.strftime("%Y-%m-%d 00:00:00")
    return str(value)


def ts_lit(value) -> Column:
    """A ``timestamp_ntz`` literal (constant-folded, pushdown-friendly)."""
    return F.lit(_text(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    return F.to_date(ts_lit(value))


def half_open(col: Column | str, start, end) -> Column:
    """``start <= c < end``."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= ts_lit(start)) & (c < ts_lit(end))


def closed(col: Column | str, start, end) -> Column:
    """``start <= c <= end``."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= ts_lit(start)) & (c <= ts_lit(end))


def shifted(col: Column | str, start, end, hours: int = 7) -> Column:
    """half-open range with both bounds moved back ``hours``.

    The shift is applied to the literals, not to the column, so the
    predicate stays a plain range on the scanned column.
    """
    c = F.col(col) if isinstance(col, str) else col
    delta = F.make_dt_interval(F.lit(0), F.lit(hours))
    return (c >= ts_lit(start) - delta) & (c < ts_lit(end) - delta)


def not_deleted(col: str = "deleted_at") -> Column:
    """soft delete."""
    return F.col(col).isNull()


def is_true(col: str = "active") -> Column:
    """boolean flag, NULL fails."""
    return F.coalesce(F.col(col), F.lit(False))


# Facts may be stored partitioned by this date column (the UTC date of the
# row's timestamp). Catalyst does not derive a partition filter from a range
# on the timestamp, so scans add one explicitly.
PARTITION_DATE_COL = "part_date"


def prune_partitions(df, start, end, part_col: str = PARTITION_DATE_COL, hours: int = 0):
    """Add ``part_col BETWEEN date(start - hours) AND date(end - hours)`` when the
    table has that column (partition pruning); otherwise return ``df``.

    The dates are those of the bounds that the exact predicate uses, moved back
    by the same ``hours`` (see ``shifted``), so no row of the range is pruned.
    """
    if part_col not in df.columns:
        return df
    delta = F.make_dt_interval(F.lit(0), F.lit(hours))
    return df.where(F.col(part_col).between(F.to_date(ts_lit(start) - delta), F.to_date(ts_lit(end) - delta)))
