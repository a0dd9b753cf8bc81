"""Stand-in logical tables over the driver's TPC-H-like Parquet tables.

The test data has no hospital tables, so each logical table is a Spark view
over them (the same definitions are written in DuckDB SQL for the oracle).
All are lazy DataFrames; only the columns a report touches are read.

visit        orders (arrays are row-wise rules, no grouping)
encounter    lineitem grouped by (orderkey, linenumber)
queue        events (en = event_id)
appointment  events
dx_visit     events, one visit each, diagnosis = JSON array
department   nation;  clinic = supplier;  practitioner / patient = customer
insurance_plan  eight fixed rows
cashier      orders (content contract of the cashier report)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicflow.sources.tables import Tables

# --- fixed values: stand-in insurance plans (id, category code, name) --------
INSURANCE_PLANS = (
    (0, "UCS", "Universal"),
    (1, "SSS", "Social"),
    (2, "OFC", "Officer"),
    (3, "LGO", "Local"),
    (4, None, "เงินสด"),
    (5, None, "เงินสด เบิกได้"),
    (6, None, "Other"),
    (7, "XXX", "Foreign"),
)
# Patient gender spellings by c_custkey % 7.
GENDER_SPELLINGS = ("Male", "m", "1", "FEMALE", "หญิง", None, "other")
# Appointment status by event_id % 3.
APPOINTMENT_STATUS = ("booked", "fulfilled", "cancelled")
# --- end of fixed values ---------------------------------------------------------


# (session, path) -> DataFrame of a test table; the test files are read-only,
# so one schema read per session is enough. The key holds the session object
# itself (not its id), so a later session never sees another session's frames.
_READS: dict[tuple[SparkSession, str], DataFrame] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark, path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def _ntz(name: str):
    return F.col(name).cast("timestamp_ntz")


def _minutes(col):
    return F.make_dt_interval(F.lit(0), F.lit(0), col.cast("int"), F.lit(0))


def _id_array(k, first, second):
    """Array of ids per row: NULL, empty, with a NULL element, with a repeated
    id, or two ids, chosen by the row key ``k`` (a pure row-wise rule)."""
    none = F.lit(None).cast("bigint")
    return (
        F.when(k % 11 == 0, F.lit(None).cast("array<bigint>"))
        .when(k % 13 == 0, F.array().cast("array<bigint>"))
        .when(k % 17 == 0, F.array(first, none))
        .when(k % 3 == 0, F.array(first, second, first))
        .otherwise(F.array(first, second))
    )


def visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits, one per order. Arrays are row-wise functions of the order:
    departments from 25 ids, clinics from the supplier keys (taken modulo the
    supplier count, an uncorrelated scalar subquery)."""
    o = _read(spark, sf_dir, "orders")
    n_clinics = _read(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    status = F.col("o_orderstatus")
    return o.select(
        k.alias("vn"),
        cust.alias("hn"),
        (_ntz("o_orderdate") + _minutes(k % 1440)).alias("created_at"),
        (F.col("o_orderpriority") != "4-NOT SPECIFIED").alias("active"),
        F.when(k % 20 == 0, _ntz("o_orderdate")).alias("deleted_at"),
        F.when(status == "F", "completed")
        .when(status == "O", "open")
        .otherwise("pending")
        .alias("latest_status_code"),
        F.when(k % 9 == 0, F.array().cast("array<bigint>"))
        .otherwise(F.array(cust % 8))
        .alias("insurance_plan_ids"),
        _id_array(k, cust % 25, k % 25).alias("department_ids"),
        _id_array(k, cust % n_clinics, (k * 7) % n_clinics).alias("clinic_ids"),
    )


def visit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(hn, created_at)`` of every visit, straight from ``orders``.

    Same rows as ``visit.select('hn', 'created_at')`` (the lineitem side of
    the stand-in is a left join on a unique key), without aggregating lineitem.
    """
    o = _read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("hn"),
        (_ntz("o_orderdate") + _minutes(F.col("o_orderkey") % 1440)).alias("created_at"),
    )


def encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters: lineitem grouped by (orderkey, linenumber).

    ``min(status) = 'F'`` is written as boolean aggregates (no smaller value,
    some value equal), which hash-aggregate; ``min`` over strings would force
    a sort-based aggregation of all lineitem rows.
    """

    def min_equals(col: str, value: str):
        c = F.col(col)
        return (~F.bool_or(c < value)) & F.bool_or(c == value)

    g = (
        _read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_suppkey").alias("clinic_id"),
            F.min(_ntz("l_shipdate")).alias("first_ship"),
            F.max(_ntz("l_shipdate")).alias("last_ship"),
            F.min("l_partkey").alias("min_part"),
            min_equals("l_linestatus", "F").alias("finished"),
            min_equals("l_returnflag", "R").alias("returned"),
        )
    )
    return g.select(
        F.col("l_orderkey").alias("vn"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("en"),
        "clinic_id",
        F.col("first_ship").alias("created_at"),
        F.when(
            F.col("finished"),
            F.col("last_ship")
            + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("min_part") % 480).cast("int"), F.lit(30)),
        ).alias("completed_at"),
        F.when(F.col("returned"), F.col("last_ship")).alias("deleted_at"),
    )


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").alias("en"), _ntz("ts").alias("called_at")
    )


def appointment(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    r = F.col("event_id") % 3
    return e.select(
        F.col("event_id").alias("id"),
        _ntz("ts").alias("start"),
        F.col("user_id").alias("patient_hn"),
        (F.col("event_id") % 120).alias("clinic_id"),
        F.col("user_id").alias("practitioner_id"),
        F.col("event_type").alias("service_type"),
        F.when(r == 0, APPOINTMENT_STATUS[0])
        .when(r == 1, APPOINTMENT_STATUS[1])
        .otherwise(APPOINTMENT_STATUS[2])
        .alias("current_status"),
        F.when(F.col("event_id") % 17 == 0, _ntz("ts")).alias("deleted_at"),
    )


def dx_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits with a ``diagnosis`` JSON array, one per event (row-wise): NULL,
    ``[]``, some malformed texts, arrays with elements that are no objects, or one / two ``{code, display}`` items from ``props.k``; a code is
    JSON null when its number is a multiple of 10."""
    number = F.get_json_object("props", "$.k").cast("bigint")
    e = _read(spark, sf_dir, "events").withColumn("k", number)  # read once per row
    eid, k = F.col("event_id"), F.col("k")
    j = (k * 7 + eid) % 100

    def item(n):
        return F.struct(
            F.when(n % 10 != 0, F.concat(F.lit("C"), n.cast("string"))).alias("code"),
            F.concat(F.lit("dx "), n.cast("string")).alias("display"),
        )

    items = (
        F.when(eid % 23 == 0, F.lit(None))
        .when(eid % 5 == 0, F.array().cast("array<struct<code:string,display:string>>"))
        .when(eid % 2 == 0, F.array(item(k), item(j)))
        .otherwise(F.array(item(k)))
    )
    one = F.to_json(item(k), {"ignoreNullFields": "false"})
    text = (
        F.when(eid % 23 == 0, F.lit(None))
        .when(eid % 29 == 0, F.concat(F.lit("\n["), one, F.lit("]")))
        .when(eid % 31 == 0, F.concat(F.lit("[1,"), one, F.lit("]")))
        .when(eid % 37 == 0, F.concat(F.lit("["), one, F.lit(",[1]]")))
        .when(eid % 41 == 0, one)
        .when(eid % 43 == 0, F.concat(F.lit("["), one))
        .when(eid % 47 == 0, F.concat(F.lit('\t ["s",'), one, F.lit("]")))
        .otherwise(F.to_json(items, {"ignoreNullFields": "false"}))
    )
    return e.select(
        eid.alias("vn"),
        F.col("user_id").alias("hn"),
        _ntz("ts").alias("created_at"),
        F.lit(True).alias("active"),
        F.when(eid % 25 == 0, _ntz("ts")).alias("deleted_at"),
        F.when(eid % 6 == 0, "open").otherwise("completed").alias("latest_status_code"),
        text.alias("diagnosis"),
    )


def department(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        (F.col("n_regionkey") != 4).alias("active"),
        F.when(F.col("n_nationkey") == 7, F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")).alias(
            "deleted_at"
        ),
    )


def clinic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )


def practitioner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("display")
    )


def patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("c_custkey") % 7
    gender = F.lit(None).cast("string")
    for i in reversed(range(len(GENDER_SPELLINGS))):
        v = GENDER_SPELLINGS[i]
        gender = F.when(r == i, F.lit(v).cast("string")).otherwise(gender)
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("hn"),
        gender.alias("gender"),
        F.struct(F.struct(F.col("c_name").alias("name")).alias("th")).alias("info"),
    )


def insurance_plan(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(INSURANCE_PLANS),
        "id bigint, nhso_insurance_plan_category_code string, name string",
    )


def cashier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content rows of the cashier report (its producer is not in the source)."""
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("vn"),
        F.col("o_custkey").alias("hn"),
        F.when(F.col("o_orderstatus") == "F", "OPD")
        .when(F.col("o_orderstatus") == "O", "IPD")
        .alias("patient_type"),
        F.when(k % 2 == 0, "AT").otherwise("ET").alias("visit_time"),
        F.col("o_orderpriority").alias("insurance_name"),
        F.when(k % 11 == 0, F.lit(None).cast("decimal(20,2)"))
        .when(k % 13 == 0, F.lit(0).cast("decimal(20,2)"))
        .otherwise(F.col("o_totalprice").cast("decimal(20,2)"))
        .alias("amount"),
    )


def standin_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All stand-ins, each built on first access."""
    return Tables(
        visit=lambda: visit(spark, sf_dir),
        visit_history=lambda: visit_history(spark, sf_dir),
        encounter=lambda: encounter(spark, sf_dir),
        queue=lambda: queue(spark, sf_dir),
        appointment=lambda: appointment(spark, sf_dir),
        department=lambda: department(spark, sf_dir),
        clinic=lambda: clinic(spark, sf_dir),
        practitioner=lambda: practitioner(spark, sf_dir),
        insurance_plan=lambda: insurance_plan(spark),
        patient=lambda: patient(spark, sf_dir),
        cashier=lambda: cashier(spark, sf_dir),
    )


def diagnosis_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables for the diagnosis report: ``visit`` carries the JSON diagnosis."""
    return standin_tables(spark, sf_dir).with_tables(visit=lambda: dx_visit(spark, sf_dir))
