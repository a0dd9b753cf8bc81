"""Order-dependent operators that scale: global row numbers and run collapsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

# Rows of the sketch per bucket; buckets then differ in size by about its inverse square root.
SKETCH_PER_BUCKET = 100
MOST_SKETCH_ROWS = 100_000


def _order_key(df: DataFrame, columns: list[str]) -> Column:
    """One comparable value per row: the columns ascending, NULLS LAST (PostgreSQL's default for ASC). Instants count as microseconds."""
    parts = []
    for i, c in enumerate(columns):
        value = F.unix_micros(c) if isinstance(df.schema[c].dataType, TimestampType) else F.col(c)
        parts += [F.col(c).isNull().alias(f"n{i}"), value.alias(f"k{i}")]
    return F.struct(*parts)


def cut_points(df: DataFrame, columns: list[str], buckets: int) -> list:
    """Order keys that cut the rows into about ``buckets`` even ranges; fewer where keys are equal.

    A quantile sketch: the keys with the smallest hashes, a uniform sample of the
    distinct keys that merges from task to task and is the same on every run, however
    the rows are dealt. Only about twice as many rows as it holds, by their hash
    and the count of rows, leave the tasks, however many tasks there are.
    """
    size = min(SKETCH_PER_BUCKET * buckets, MOST_SKETCH_ROWS)
    keys = df.select(_order_key(df, columns).alias("key"), F.xxhash64(*columns).alias("hash"))
    share = 2 * size / max(df.count(), 1)
    if share < 1:
        keys = keys.where(F.pmod("hash", F.lit(1 << 40)) < int(share * (1 << 40)))
    rows = sorted((_comparable(r.key), r.key) for r in keys.orderBy("hash", "key").limit(size).collect())
    cuts = [rows[len(rows) * i // buckets] for i in range(1, buckets)] if rows else []
    return [key for i, (order, key) in enumerate(cuts) if i == 0 or order != cuts[i - 1][0]]


def _comparable(key) -> tuple:
    """Spark's order of a key in Python: NULL last (its flag is compared first), NaN above all numbers, text as UTF-8."""
    return tuple((0,) if v is None else (2,) if v != v else (1, v.encode() if isinstance(v, str) else v) for v in key)


def _literal(key, schema) -> Column:
    """The key as a literal; wall clocks as text, which no zone shifts."""
    plain = lambda v: str(v) if isinstance(v, dt.datetime) else v
    return F.struct(*[F.lit(plain(v)).cast(f.dataType).alias(f.name) for v, f in zip(key, schema.fields)])


def _bucket(key: Column, cuts: Column | None, n: int) -> Column:
    """How many of the ``n`` ascending ``cuts`` are not above ``key``: a binary search, as many steps as ``n`` has digits."""
    if not n:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])
    step = lambda at, by: F.when((at + by <= n) & (F.get(cuts, at + by - 1) <= key), at + by).otherwise(at)
    return F.coalesce(F.aggregate(steps, F.lit(0), step), F.lit(0))


def global_row_number(
    df: DataFrame,
    order_by: list[str],
    tiebreak: list[str],
    out: str = "seq_no",
    num_partitions: int | None = None,
    keep_position: bool = False,
    sketch: DataFrame | None = None,
) -> DataFrame:
    """W1 ``ROW_NUMBER() OVER (ORDER BY ...)`` without a single-partition window.

    1. cut points over (order keys, tie-break) from a quantile sketch
       (``cut_points``) become literals; with a unique tie-break the ranges
       are even although a third of the rows share one timestamp;
    2. rows are shuffled once, by the number of their range, and numbered
       within it;
    3. rows per range are counted on the same shuffle (one row per range),
       prefix-summed and broadcast as offsets.

    Nothing is cached or written, and building the plan runs the sketch alone.
    The number of a row depends on its keys and the cut points only, so a task
    that runs again gives the same numbers (rows equal in all keys may change
    places). ``sketch`` is a cheaper frame with about the same spread of keys
    (missing columns count as NULL), where ``df`` itself is dear.

    ``keep_position`` keeps the range ``_pid`` and the place in it, ``_mid``, so a
    subset of the rows can be renumbered later without a new sort (``renumber_kept``).
    """
    keys = list(dict.fromkeys([*order_by, *tiebreak]))
    spark = df.sparkSession
    buckets = num_partitions or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    source = df if sketch is None else sketch.select(
        *[F.col(c) if c in sketch.columns else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in keys]
    )
    cuts = cut_points(source, keys, buckets)
    schema = df.select(_order_key(df, keys).alias("key")).schema["key"].dataType
    points = F.array(*[_literal(k, schema) for k in cuts]) if cuts else None
    ranged = df.withColumn("_pid", _bucket(_order_key(df, keys), points, len(cuts))).repartition("_pid")
    place = Window.partitionBy("_pid").orderBy(*[F.col(c).asc_nulls_last() for c in keys])
    numbered = ranged.withColumn("_mid", F.row_number().over(place).cast("bigint")).where(_whole_row(ranged))
    numbered = numbered.join(F.broadcast(_partition_offsets(ranged)), "_pid").withColumn(out, F.col("_off") + F.col("_mid")).drop("_off")
    return numbered if keep_position else numbered.drop("_pid", "_mid")


def _whole_row(df: DataFrame) -> Column:
    """True for every row, but needs all columns: numbers and counts then read the same columns, so Spark runs their shuffle once."""
    return F.xxhash64(*df.columns).bitwiseAND(F.lit(0)) == 0


def _partition_offsets(ranged: DataFrame) -> DataFrame:
    """Rows before each range: one row per range (bounded), counted on the shuffle of the rows."""
    counts = ranged.groupBy("_pid").agg(F.count_if(_whole_row(ranged)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))


def renumber_kept(df: DataFrame, out: str) -> DataFrame:
    """Number the rows of ``df`` 1..n in their existing global order, for a
    frame that still carries ``_pid`` / ``_mid`` from ``global_row_number``.

    The ranges are even, so a running count within each (one window group per
    range) plus the offsets of the ranges renumbers a subset without a new
    sketch or shuffle.
    """
    within = Window.partitionBy("_pid").orderBy("_mid")
    ranked = df.withColumn("_pos", F.row_number().over(within))
    return (
        ranked.join(F.broadcast(_partition_offsets(df)), "_pid")
        .withColumn(out, (F.col("_off") + F.col("_pos")).cast("bigint"))
        .drop("_off", "_pos", "_pid", "_mid")
    )


def mark_runs(df: DataFrame, seq: str, key: str, out: str = "new_run") -> DataFrame:
    """``new_run`` = this row's key differs (null-safe) from the previous row's.

    For rows from ``global_row_number(..., keep_position=True)`` the previous row
    is the one before it in its range, or the last one of the range before (one
    row per range): one pass, no join of the rows.
    Other rows find it by an equi self-join on ``seq - 1``, not by a global
    ``lag``. The first row compares with NULL, so a NULL key on it starts no
    run, as in the template loop.
    """
    if "_pid" in df.columns and "_mid" in df.columns:
        last = df.groupBy("_pid").agg(F.max_by(F.struct(F.col(key).alias("k")), "_mid").alias("_last"))
        before = last.select("_pid", F.lag("_last").over(Window.orderBy("_pid")).alias("_before"))
        within = Window.partitionBy("_pid").orderBy("_mid")
        rows = df.join(F.broadcast(before), "_pid").withColumn("_lag", F.lag(F.struct(F.col(key).alias("k"))).over(within))
        previous = F.coalesce(F.col("_lag"), F.col("_before"))["k"]
        return rows.withColumn(out, ~F.col(key).eqNullSafe(previous)).drop("_before", "_lag")
    prev = df.select((F.col(seq) + 1).alias(seq), F.col(key).alias("_prev_key"))
    j = df.join(prev, seq, "left")
    return j.withColumn(out, ~F.col(key).eqNullSafe(F.col("_prev_key"))).drop("_prev_key")


def collapse_runs(df: DataFrame, seq: str, key: str, out: str = "display_index") -> DataFrame:
    """Keep the first row of each run of equal consecutive keys and renumber.

    When ``df`` comes from ``global_row_number(..., keep_position=True)`` the
    kept rows are renumbered inside the existing ranges.
    """
    kept = mark_runs(df, seq, key).where("new_run").drop("new_run")
    if "_pid" in kept.columns and "_mid" in kept.columns:
        return renumber_kept(kept, out)
    return global_row_number(kept, [seq], [], out=out)
