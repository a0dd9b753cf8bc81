"""Mergeable exact distinct counts: dense patient numbers per day, as rows or bitmaps, merged for any window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinicflow.operators.ordering import global_row_number

# A bucket of a state holds a row per key if there are no more than this; a bitmap takes 4 KB a flag, however few they are.
FEW = 256
LISTED = "_listed"


def number_keys(keys: DataFrame, key: str, existing: DataFrame | None = None) -> DataFrame:
    """``key``, ``number``: a dense number from 1 for every key that isn't NULL.

    Numbers of ``existing`` stay; new keys go on from its greatest. Dense
    numbers fill the bitmaps: patients numbered as they come lie in the
    last few buckets of a day.
    """
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if existing is None:
        return global_row_number(fresh, [key], [], out="number").select(key, F.col("number").cast("bigint"))
    fresh = fresh.join(existing, key, "left_anti")
    last = F.coalesce(existing.agg(F.max("number")).scalar(), F.lit(0))
    numbered = global_row_number(fresh, [key], [], out="number")
    return existing.select(key, "number").unionByName(numbered.select(key, (F.col("number") + last).cast("bigint").alias("number")))


def distinct_states(
    rows: DataFrame, numbers: DataFrame, groups: list[str], key: str, flags: dict[str, Column], row_count: dict[str, Column] | None = None
) -> DataFrame:
    """Per group and bucket of 32,768 numbers: the keys with each flag, and ``COUNT(column)`` per ``row_count``.

    Up to ``FEW`` keys are a row each (``_listed``: place in the bucket and flags in one number), more are one row with a
    bitmap per flag, so a state grows with its keys and not with its days. Rows are reduced to one per group and key before they
    meet the numbers, so a hot patient is one row per group there. They are shuffled as rows: bitmaps are made one
    at a time afterwards. Rows with a NULL key lie in the bucket NULL: they count as rows, not as keys.
    """
    row_count = row_count or {}
    per_key = rows.groupBy(*groups, key).agg(
        *[F.max(cond.cast("int")).alias(f"_f_{n}") for n, cond in flags.items()], *[F.count(c).alias(f"_r_{n}") for n, c in row_count.items()]
    )
    placed = per_key.join(numbers, key, "left").withColumn("bucket", F.expr("bitmap_bucket_number(number)"))
    bucket = Window.partitionBy(*groups, "bucket")
    placed = placed.withColumn("_place", F.expr("bitmap_bit_position(number)")).withColumn("_keys", F.count("number").over(bucket))
    sums = [F.sum(f"_r_{n}").alias(n) for n in row_count]
    bits = [F.expr(f"bitmap_construct_agg(_place) FILTER (WHERE number IS NOT NULL AND _f_{n} = 1)").alias(n) for n in flags]
    many = placed.where(F.col("_keys") > FEW).groupBy(*groups, "bucket").agg(*bits, *sums)
    entry = F.col("_place") * (1 << len(flags))
    for i, n in enumerate(flags):
        entry = entry + F.coalesce(F.col(f"_f_{n}"), F.lit(0)) * (1 << i)
    few = placed.where(F.col("_keys") <= FEW).select(*groups, "bucket", entry.alias(LISTED), *[F.col(f"_r_{n}").alias(n) for n in row_count])
    return few.unionByName(many, allowMissingColumns=True)


def merge_states(states: DataFrame, groups: list[str], flags: list[str], row_count: list[str] = ()) -> DataFrame:
    """Exact distinct counts of the union of states (days, loads, regions) per ``groups``, and the sums of their row counts."""
    listed = states.where(F.col(LISTED).isNotNull())
    bits = [
        F.expr(f"bitmap_construct_agg({LISTED} div {1 << len(flags)}) FILTER (WHERE ({LISTED} & {1 << i}) != 0)").alias(n) for i, n in enumerate(flags)
    ]
    listed = listed.groupBy(*groups, "bucket").agg(*bits)
    both = states.drop(LISTED).unionByName(listed, allowMissingColumns=True)
    merged = both.groupBy(*groups, "bucket").agg(
        *[F.expr(f"bitmap_or_agg({n})").alias(n) for n in flags], *[F.sum(n).alias(n) for n in row_count]
    )
    return merged.groupBy(*groups).agg(
        *[F.sum(F.expr(f"bitmap_count({n})")).cast("bigint").alias(n) for n in flags], *[F.sum(n).cast("bigint").alias(n) for n in row_count]
    )
