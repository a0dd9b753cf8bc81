"""Logical tables of the reports.

``Tables`` holds one DataFrame per logical table. A deployment points it at
its own storage (``Tables.from_parquet``: one Parquet folder per table, facts
ideally partitioned by a ``visit_date`` column); tests and the driver use
stand-ins derived from the TPC-H-like test tables (``sources.standins``).

Tables can be given as DataFrames or as zero-argument factories; a factory
runs on first access only, so a report plans reads of just the tables it uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinicflow.sources.jdbc import time_slices

LOGICAL_TABLES = (
    "visit",
    "encounter",
    "queue",
    "appointment",
    "department",
    "clinic",
    "practitioner",
    "insurance_plan",
    "patient",
)
# Optional tables a deployment may keep (else derived from ``visit``):
# ``visit_history`` (hn, created_at) and ``first_visit`` (hn, first_created_at),
# the earliest visit per patient, maintained with operators.history.merge_first_visits.
# ``cashier``: content rows of the cashier report.
OPTIONAL_TABLES = ("visit_history", "first_visit", "cashier")


class Tables:
    """Named logical tables, resolved lazily."""

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame] | None):
        unknown = set(tables) - set(LOGICAL_TABLES) - set(OPTIONAL_TABLES)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        self._src = dict(tables)
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str) -> DataFrame | None:
        if name not in self._cache:
            src = self._src.get(name)
            self._cache[name] = src() if callable(src) else src
        return self._cache[name]

    def __getattr__(self, name: str):
        if name in LOGICAL_TABLES:
            return self._get(name)
        raise AttributeError(name)

    def has(self, name: str) -> bool:
        return self._src.get(name) is not None

    def optional(self, name: str) -> DataFrame | None:
        """An optional table, None where the deployment has none."""
        return self._get(name) if name in self._src else None

    def history(self) -> DataFrame:
        """``(hn, created_at)`` of *all* visits: the new/returning history."""
        h = self.optional("visit_history")
        return h if h is not None else self.visit.select("hn", "created_at")

    def first_visit_table(self) -> DataFrame | None:
        """The maintained ``(hn, first_created_at)`` table, if the deployment has one."""
        return self.optional("first_visit")

    @staticmethod
    def from_parquet(spark: SparkSession, root: str, names=LOGICAL_TABLES) -> "Tables":
        """One Parquet folder per logical table under ``root`` (read on first use), and the optional ones that are there.

        Instants (``timestamp``) are read as UTC wall clock (``timestamp_ntz``) by the reader's
        schema, so results don't depend on the session zone and ranges are still pushed to the scan.
        """
        base = root.rstrip("/")
        found = [n for n in OPTIONAL_TABLES if n not in names and _exists(spark, f"{base}/{n}")]
        return Tables(**{n: (lambda n=n: _read_utc(spark, f"{base}/{n}")) for n in (*names, *found)})

    @staticmethod
    def from_catalog(spark: SparkSession, database: str, names=LOGICAL_TABLES) -> "Tables":
        """Tables of a catalog database, as ``layout.write_co_located`` writes them: bucketed
        facts keep their layout, so joins on the bucket keys need no shuffle.

        Spark asks for buckets by *all* join keys unless
        ``spark.sql.requireAllClusterKeysForCoPartition`` is false; set it for the
        session where queue calls join on (vn, en). Results don't depend on it.
        """
        there = [n for n in (*names, *OPTIONAL_TABLES) if spark.catalog.tableExists(f"{database}.{n}")]
        return Tables(**{n: (lambda n=n: spark.table(f"{database}.{n}")) for n in there})

    @staticmethod
    def from_jdbc(
        spark: SparkSession,
        url: str,
        properties: dict,
        names=LOGICAL_TABLES,
        partitioning: dict | None = None,
        schema: str = "public",
        slices: dict | None = None,
    ) -> "Tables":
        """Logical tables read over JDBC (e.g. the PostgreSQL tables the reports
        were written against; the JDBC driver jar must be on the classpath).

        Tables are read on first use. ``slices`` maps a fact to ``(column, start,
        end, n)`` or ``(column, start, end, n, closed)`` for a report's range on an
        instant column: ``n`` tasks read a slice of the time each, by predicates on
        the raw column (``jdbc.time_slices``), so only rows of the range leave the
        database. ``partitioning`` maps a table to ``(column, lower, upper,
        num_partitions)`` for parallel reads of whole facts (Spark splits the numeric
        column range into ``num_partitions`` queries). Other predicates on columns that
        aren't instants are pushed by Spark itself. Instants (``timestamptz``) become
        UTC wall-clock ``timestamp_ntz`` (the plans' time model); see ``utc_wall_clock``.
        """
        partitioning, slices = partitioning or {}, slices or {}

        def reader(name: str):
            table = f"{schema}.{name}" if schema else name
            opts = dict(properties)
            if name in slices:
                column, start, end, n, *closed = slices[name]
                predicates = time_slices(column, start, end, n, closed=bool(closed and closed[0]))
                df = spark.read.jdbc(url, table, predicates=predicates, properties=opts)
            elif name in partitioning:
                col, lo, hi, n = partitioning[name]
                df = spark.read.jdbc(url, table, column=col, lowerBound=lo, upperBound=hi, numPartitions=n, properties=opts)
            else:
                df = spark.read.jdbc(url, table, properties=opts)
            return utc_wall_clock(df)

        return Tables(**{n: (lambda n=n: reader(n)) for n in names})

    def with_tables(self, **frames) -> "Tables":
        merged = dict(self._src)
        merged.update(frames)
        if "visit" in frames:
            for derived in ("visit_history", "first_visit"):
                if derived not in frames:
                    merged.pop(derived, None)
        return Tables(**merged)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def _read_utc(spark: SparkSession, path: str) -> DataFrame:
    from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType

    df = spark.read.parquet(path)
    if not any(isinstance(f.dataType, TimestampType) for f in df.schema.fields):
        return df
    ntz = lambda f: StructField(f.name, TimestampNTZType(), f.nullable) if isinstance(f.dataType, TimestampType) else f
    return spark.read.schema(StructType([ntz(f) for f in df.schema.fields])).parquet(path)


def utc_wall_clock(df: DataFrame) -> DataFrame:
    """Instants (``timestamp``) as UTC wall-clock ``timestamp_ntz`` columns."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import TimestampType

    cols = [
        F.convert_timezone(None, F.lit("UTC"), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)
