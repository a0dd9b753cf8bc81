"""Array fan-out operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_element(col) -> Column:
    """X13 ``a[1]``: NULL when the array is NULL or empty (no ANSI error)."""
    return F.get(_c(col), 0)


def explode_keep_empty(df: DataFrame, col: str, out: str) -> DataFrame:
    """J4 ``LEFT JOIN LATERAL unnest(a) ON true``: one row per element,
    duplicates and NULL elements kept, one NULL row for an empty/NULL array."""
    return df.withColumn(out, F.explode_outer(col))


def fanout_weight(col) -> Column:
    """Rows J4 would produce for one input row: ``max(size(a), 1)``.

    Lets an additive count over the fan-out be a weighted count of the
    unexploded rows (no row multiplication).
    """
    return F.greatest(F.coalesce(F.size(_c(col)), F.lit(0)), F.lit(1)).cast("bigint")


def membership_join(
    facts: DataFrame, ids_col: str, dim: DataFrame, dim_key: str = "id", out: str = "member_id"
) -> DataFrame:
    """J6 ``dim.id = ANY(facts.ids)``: one row per (fact, distinct matching id).

    Rewritten as ``explode(array_distinct(ids))`` + equi join, so it plans as
    a hash/broadcast join instead of a nested loop over ``array_contains``.
    """
    exploded = facts.withColumn(out, F.explode(F.array_distinct(ids_col)))
    d = dim
    return exploded.join(d, exploded[out] == d[dim_key], "inner")
