"""Report result model: a one-row ``meta`` DataFrame and a ``content`` DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicflow.params import ts_lit


@dataclass(frozen=True)
class Report:
    """``meta``: one row; ``content``: the rows, lazily planned.

    ``order``: the row order of the printed document (content columns, ascending, NULLS LAST);
    ``collation``: that of the text columns in ``order``, binary if None (O3);
    ``empty``: the content of a document without rows, ``null`` or ``[]`` (S8);
    ``keys``: column -> presentation key; if given, only these columns are written, under these keys;
    ``extras``: further named outputs (e.g. the department list of R2);
    ``meta_fn``: meta computed from a content frame, for meta fields that
    depend on the rows (totals, counts). Sinks apply it to the *written*
    content, so the fact pipeline runs once, not once more for the meta.
    """

    meta: DataFrame
    content: DataFrame
    order: tuple[str, ...] = ()
    collation: str | None = None
    empty: str = "null"
    extras: dict = field(default_factory=dict)
    keys: dict = field(default_factory=dict)
    meta_fn: Callable[[DataFrame], DataFrame] | None = None


def meta_row(spark: SparkSession, fields: dict[str, Column], generated_at: bool = True) -> DataFrame:
    """A one-row meta frame of literal / scalar-subquery columns."""
    cols = [c.alias(k) for k, c in fields.items()]
    if generated_at:
        cols.append(F.current_timestamp().alias("generated_at"))
    return spark.range(1).select(*cols)


def bound(value) -> Column:
    """Report bound as a meta value (``timestamp_ntz``)."""
    return ts_lit(value)
