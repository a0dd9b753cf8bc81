"""Daily aggregates kept current from load batches with late corrections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.operators.lineage import materialize


def latest(versions: DataFrame, key: str, version: str) -> DataFrame:
    """The row with the greatest version of each key (combined map-side)."""
    rest = [c for c in versions.columns if c != key]
    newest = versions.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("_row"))
    return newest.select(key, "_row.*").select(*versions.columns)


def signed_merge(state: DataFrame, removed: DataFrame, added: DataFrame, groups: list[str], counts: list[str]) -> DataFrame:
    """``state`` less the counts of ``removed`` plus those of ``added``; groups that come to nothing go."""
    columns = [*groups, *counts]
    taken = removed.select(*groups, *[(-F.col(c)).alias(c) for c in counts])
    both = state.select(*columns).unionByName(taken).unionByName(added.select(*columns))
    merged = both.groupBy(*groups).agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])
    return merged.where(" OR ".join(f"`{c}` <> 0" for c in counts))


def apply_batch(
    current: DataFrame,
    state: DataFrame,
    batch: DataFrame,
    key: str,
    version: str,
    contribution: Callable[[DataFrame], DataFrame],
    groups: list[str],
    counts: list[str],
) -> tuple[DataFrame, DataFrame]:
    """One load batch of new and corrected rows: the tables (current rows, daily counts) after it.

    ``contribution`` maps rows to the counts they add per group. A row whose
    status, deletion, plan or day has changed takes its old contribution back and
    adds its new one. Older versions than the current one change nothing, nor
    does a batch that comes again. Only the keys of the batch are looked up in
    ``current``; both results are written, as the next batch reads them.
    """
    touched = current.join(batch.select(key).distinct(), key, "left_semi")
    newest = latest(touched.unionByName(batch.select(*current.columns)), key, version)
    counted = signed_merge(state, contribution(touched), contribution(newest), groups, counts)
    rows = current.join(batch.select(key).distinct(), key, "left_anti").unionByName(newest)
    return materialize(rows, "current"), materialize(counted, "daily")
