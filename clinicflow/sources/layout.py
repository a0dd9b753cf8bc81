"""Storage layouts for the fact tables at scale: by day, or by key and co-located."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from clinicflow.params import PARTITION_DATE_COL
from clinicflow.session import ensure_checkpoint_dir
from clinicflow.sources.tables import LOGICAL_TABLES, Tables

# The key a table is bucketed by, and the column its files are sorted by. The
# report joins meet on these keys: visits, encounters and their queue calls on
# the visit, histories and patients on the patient.
CO_LOCATED = {
    "visit": ("vn", "created_at"),
    "encounter": ("vn", "created_at"),
    "queue": ("vn", "called_at"),
    "visit_history": ("hn", "created_at"),
    "first_visit": ("hn", "first_created_at"),
    "patient": ("hn", None),
}


def utc_day(df: DataFrame, ts_col: str):
    """The UTC date of a time column, whatever the session zone: instants are converted first, wall clocks are UTC."""
    ts = F.col(ts_col)
    if isinstance(df.schema[ts_col].dataType, TimestampType):
        ts = F.convert_timezone(None, F.lit("UTC"), ts)
    return F.to_date(ts)


def write_partitioned_facts(df: DataFrame, path: str, ts_col: str, mode: str = "overwrite") -> None:
    """Write a fact table as Parquet partitioned by ``part_date`` (the UTC date
    of ``ts_col``), the layout ``params.prune_partitions`` prunes on.

    ``REBALANCE`` lets AQE split a date that holds a large share of the rows
    over several tasks (even file sizes, no hot writer), and sorting by the
    timestamp inside each task keeps Parquet min/max statistics tight, so a
    range on ``ts_col`` also skips row groups within a day.
    """
    out = df.withColumn(PARTITION_DATE_COL, utc_day(df, ts_col))
    out = out.hint("rebalance", PARTITION_DATE_COL).sortWithinPartitions(PARTITION_DATE_COL, ts_col)
    out.write.mode(mode).partitionBy(PARTITION_DATE_COL).parquet(path)


def with_visit(queue: DataFrame, encounter: DataFrame) -> DataFrame:
    """Queue calls with the ``vn`` of their encounter, so that they can lie with the visits; calls of no encounter keep NULL.

    An ``en`` that several visits share gives a call for each; joined on (vn, en)
    they give the rows of the join on ``en`` alone.
    """
    of = encounter.select("en", "vn").where(F.col("en").isNotNull() & F.col("vn").isNotNull()).distinct()
    return queue.join(of, "en", "left")


def write_co_located(
    spark: SparkSession, t: Tables, database: str, buckets: int, root: str | None = None, names=tuple(CO_LOCATED), mode: str = "overwrite"
) -> None:
    """Write the tables as bucketed Parquet tables of a catalog database, read with ``Tables.from_catalog``.

    All tables of a key have the same number of buckets, so that Spark joins
    them, and groups them, bucket by bucket without a shuffle. Within a bucket
    rows are sorted by time: min/max statistics of row groups then skip those
    out of a report's range. ``root`` is the folder of the files (else the
    warehouse). ``buckets`` should give files of some hundred MB (about the largest
    table's size over that) and be no fewer than the shuffle partitions, else
    Spark shuffles a bucketed side anew when it joins a side that isn't bucketed.

    A bucket holds all rows of its keys, in one task: visits and encounters have
    few rows a key. Rows without a key lie in one bucket; ``visit_history``
    leaves them out, as no first visit is asked for them.
    """
    for name in names:
        key, order = CO_LOCATED[name]
        df = _source(t, name)
        if df is None:
            continue
        if name == "queue" and "vn" not in df.columns:
            df = with_visit(df, t.encounter)
        if name in ("visit_history", "first_visit"):
            df = df.where(F.col(key).isNotNull())
        # One task a bucket, so one file a bucket.
        writer = df.repartition(buckets, key).write.mode(mode).format("parquet").bucketBy(buckets, key)
        if order is not None:
            writer = writer.sortBy(order)
        if root is not None:
            writer = writer.option("path", f"{root.rstrip('/')}/{name}")
        writer.saveAsTable(f"{database}.{name}")
    for name in LOGICAL_TABLES:  # dimensions and the rest, as they are
        if name in names or (df := _source(t, name)) is None:
            continue
        writer = df.write.mode(mode).format("parquet")
        if root is not None:
            writer = writer.option("path", f"{root.rstrip('/')}/{name}")
        writer.saveAsTable(f"{database}.{name}")


def _source(t: Tables, name: str) -> DataFrame | None:
    if name == "visit_history":
        return t.history() if t.has("visit_history") or t.visit is not None else None
    if name == "first_visit":
        return t.first_visit_table()
    return getattr(t, name)


def scratch_database(spark: SparkSession, buckets: int, t: Tables, names=tuple(CO_LOCATED)) -> Tables:
    """A co-located copy of ``t`` in a database of its own under the checkpoint folder, removed when the application ends."""
    database = f"clinicflow_{uuid.uuid4().hex}"
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{database}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    write_co_located(spark, t, database, buckets, root, names)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return Tables.from_catalog(spark, database)
