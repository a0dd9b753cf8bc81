"""New-versus-returning patients over the full visit history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def build_first_visits(history: DataFrame, key: str = "hn", ts: str = "created_at") -> DataFrame:
    """The maintained form: ``(key, first_created_at)`` for every patient."""
    return history.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ts).alias("first_created_at"))


def merge_first_visits(existing: DataFrame, new_visits: DataFrame, key: str = "hn", ts: str = "created_at") -> DataFrame:
    """Fold newly loaded visits into a maintained first-visit table (min is
    associative, so an append batch is merged without rereading history)."""
    fresh = build_first_visits(new_visits, key, ts)
    both = existing.select(key, "first_created_at").unionByName(fresh)
    return both.groupBy(key).agg(F.min("first_created_at").alias("first_created_at"))


# A key with more than a HOT_SHARE-th of the rows is hot: there are fewer than HOT_SHARE of them.
HOT_SHARE = 1000
# The rows of all hot keys together are dealt over about this many pieces.
PIECES = 2048


def subject_counts(subjects: DataFrame, key: str) -> DataFrame:
    """Rows per key of ``subjects`` (NULL keys left out), combined map-side."""
    return subjects.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def first_visits(
    history: DataFrame,
    subjects: DataFrame,
    key: str = "hn",
    ts: str = "created_at",
    maintained: DataFrame | None = None,
) -> DataFrame:
    """``MIN(ts)`` per key over *all* history rows of the keys in ``subjects``.

    History is not filtered by status/range/deletion. The minimum is taken
    before any join, combined map-side, so a hot key ships one row per task;
    the result (a row per key) is reduced to the keys of ``subjects``.
    """
    keys = subject_counts(subjects, key).select(key)
    if maintained is not None:
        # one row per patient already: no scan of the full history
        return maintained.select(key, "first_created_at").join(keys, key, "left_semi")
    return build_first_visits(history, key, ts).join(keys, key, "left_semi")


def _pieces(subjects: DataFrame, key: str) -> DataFrame:
    """``key``, ``pieces`` of the hot keys of ``subjects``: fewer than HOT_SHARE rows, less than HOT_SHARE + PIECES pieces in all."""
    counts = subject_counts(subjects, key)
    total = counts.agg(F.sum("n_rows")).scalar()
    hot = counts.where(F.col("n_rows") * HOT_SHARE > total)
    return hot.select(F.col(key).alias("_hot"), F.ceil(F.col("n_rows") * PIECES / total).cast("int").alias("_pieces"))


def join_first_visits(visits: DataFrame, first: DataFrame, key: str, how: str) -> DataFrame:
    """``visits`` joined on ``key`` with ``first`` (a row per key), whatever share of the rows one key or NULL holds.

    The hot keys are found by a count per key. Their visits are dealt over
    pieces by a hash of the whole row, and their one row of ``first`` is repeated
    for each piece; visits with a NULL key, which match nothing, are dealt by
    that hash alone. The list of hot keys is broadcast: its length is bounded by
    HOT_SHARE, whatever the data.
    """
    hot = F.broadcast(_pieces(visits, key))
    spread = F.xxhash64(*visits.columns)
    piece = F.when(F.col(key).isNull(), spread).when(F.col("_pieces").isNotNull(), F.pmod(spread, F.col("_pieces"))).otherwise(0)
    # Key and piece are one value: rows that lie together by the key alone already are dealt anew.
    at = lambda piece: F.struct(F.col(key).alias("key"), piece.cast("bigint").alias("piece"))
    dealt = visits.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_at", at(piece)).drop("_hot", "_pieces")
    numbers = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_pieces"), F.lit(1)).cast("bigint") - 1)
    copies = first.where(F.col(key).isNotNull()).join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_piece", F.explode(numbers))
    copies = copies.withColumn("_at", at(F.col("_piece"))).drop("_hot", "_pieces", "_piece", key)
    return dealt.join(copies, "_at", how).select(key, *[c for c in [*visits.columns, *first.columns] if c != key])


def flag_new_inner(
    visits: DataFrame, history: DataFrame, key: str = "hn", ts: str = "created_at", maintained: DataFrame | None = None
) -> DataFrame:
    """R5 rule: inner join to first visits (drops NULL keys); ``is_new = ts = first``."""
    fv = first_visits(history, visits, key, ts, maintained)
    known = visits.where(F.col(key).isNotNull())
    return join_first_visits(known, fv, key, "inner").withColumn("is_new", F.col(ts) == F.col("first_created_at"))


def flag_new_no_earlier(
    visits: DataFrame, history: DataFrame, key: str = "hn", ts: str = "created_at", maintained: DataFrame | None = None
) -> DataFrame:
    """R2 rule ``NOT EXISTS (earlier visit of the same key)`` without pairwise compares.

    A visit is OLD iff some history row of its key is strictly earlier,
    i.e. iff ``ts > min(ts)``; a NULL key has no earlier visit -> NEW.
    """
    fv = first_visits(history, visits, key, ts, maintained)
    out = join_first_visits(visits, fv, key, "left")
    return out.withColumn("is_new", ~F.coalesce(F.col(ts) > F.col("first_created_at"), F.lit(False)))
