"""Join helpers: dimension lookups, enrichment. Join strategies are left to the planner and AQE, which know sizes in bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup(facts: DataFrame, key, dim: DataFrame, dim_key: str, cols: dict[str, str], how="left") -> DataFrame:
    """Left equi join to a dimension, renaming its columns (``{src: alias}``)."""
    d = dim.select(F.col(dim_key).alias("_lk"), *[F.col(s).alias(a) for s, a in cols.items()])
    k = F.col(key) if isinstance(key, str) else key
    return facts.join(d, k == F.col("_lk"), how).drop("_lk")


def enrich_patient(
    content: DataFrame,
    patient: DataFrame,
    key: str = "hn",
    fields: tuple[str, ...] = ("info",),
    out: str = "patient",
) -> DataFrame:
    """Attach ``patient`` fields as a nested struct, keyed by ``hn``.

    A left join: rows without a patient keep a NULL struct. The patient
    table can be large, so no broadcast is forced; AQE decides at runtime.
    """
    p = patient.select(F.col(key).alias("_pk"), F.struct(*fields).alias(out))
    return content.join(p, content[key] == F.col("_pk"), "left").drop("_pk")
