"""Scalar column expressions: categories, labels, placeholders, numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinicflow.functions.labels import (
    CASH_PLAN_NAMES,
    CATEGORY_CASH,
    CATEGORY_OTHER,
    FEMALE_VALUES,
    MALE_VALUES,
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def plan_category(code, name) -> Column:
    """Category code, else CASH for the self-pay plan names, else OTHER."""
    return F.coalesce(
        _c(code),
        F.when(_c(name).isin(*CASH_PLAN_NAMES), F.lit(CATEGORY_CASH)).otherwise(F.lit(CATEGORY_OTHER)),
    )


def gender_normalise(col) -> Column:
    """P10: 'male' / 'female' / 'unknown' from free-text gender."""
    g = F.lower(_c(col).cast("string"))
    return (
        F.when(g.isin(*MALE_VALUES), F.lit("male"))
        .when(g.isin(*FEMALE_VALUES), F.lit("female"))
        .otherwise(F.lit("unknown"))
    )


def placeholder(col, text: str = "-") -> Column:
    """P9 ``x or '-'`` for text: NULL and '' become ``text``."""
    return F.coalesce(F.nullif(_c(col).cast("string"), F.lit("")), F.lit(text))


def blank_if_falsy(col) -> Column:
    """P9 ``x or ''`` for numbers: NULL and 0 print as ''."""
    c = _c(col)
    return F.when(c.isNull() | (c == 0), F.lit("")).otherwise(c.cast("string"))


def fmt_number(col, decimals: int = 2) -> Column:
    """X26 ``{:,.2f}``: thousands separators and fixed decimals."""
    return F.format_number(_c(col), decimals)


def int_or_zero(col) -> Column:
    """X27 ``default(0)|int``."""
    return F.coalesce(_c(col).try_cast("int"), F.lit(0))


def minutes_between(end, start) -> Column:
    """X8 + X9: ``ROUND(EXTRACT(EPOCH FROM end - start) / 60)`` as bigint.

    ``end - start`` is a day-time interval (zone-free for wall-clock
    timestamps, unlike ``timestamp_diff``, which goes through the session
    zone); as seconds it is an exact decimal, and ``round`` on a decimal
    rounds half away from zero, like numeric rounding.
    """
    secs = (_c(end) - _c(start)).cast("interval second").cast("decimal(24,6)")
    return F.round(secs / F.lit(60).cast("decimal(2,0)"), 0).cast("bigint")


def pct_half_up(part, whole) -> Column:
    """W3 ``CASE WHEN whole > 0 THEN ROUND(part::numeric / whole * 100, 2) ELSE 0``."""
    p = _c(part).cast("decimal(20,0)")
    w = _c(whole).cast("decimal(20,0)")
    return (
        F.when(w > 0, F.round(p / w * F.lit(100), 2))
        .otherwise(F.lit(0))
        .cast("decimal(20,2)")
    )


def name_order(col: str, collation: str | None = None) -> Column:
    """O3: a text column in the order of a collation (``th``, ``UNICODE_CI``, ...), binary if None; NULLS LAST."""
    c = F.col(col) if collation is None else F.collate(F.col(col), collation)
    return c.asc_nulls_last()
