"""New-versus-returning joins where one patient or NULL holds most rows."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from clinicflow.operators.history import HOT_SHARE, PIECES, _pieces, flag_new_inner, flag_new_no_earlier

N = 60_000


@pytest.fixture
def skewed(spark):
    """Half the rows on one patient, a third without a patient, the rest on many."""
    hn = F.when(F.col("id") % 6 < 3, F.lit(7)).when(F.col("id") % 6 < 5, F.lit(None).cast("bigint")).otherwise(1000 + F.col("id") % 4000)
    return spark.range(N).select(F.col("id").alias("vn"), hn.alias("hn"), (F.col("id") * 7919 % 1000).cast("int").alias("created_at"))


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "211"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_no_task_gathers_a_hot_patient_or_null(spark, skewed, no_broadcast):
    joined = flag_new_no_earlier(skewed, skewed.select("hn", "created_at"))
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == N and len(sizes) == 211
    assert max(sizes) <= 3 * statistics.median(sizes), (max(sizes), statistics.median(sizes))


def test_flags_equal_the_rules_under_skew(spark, skewed):
    rows = skewed.collect()
    first = {}
    for r in rows:
        if r.hn is not None:
            first[r.hn] = min(first.get(r.hn, r.created_at), r.created_at)
    history = skewed.select("hn", "created_at")
    got = {r.vn: r.is_new for r in flag_new_no_earlier(skewed, history).collect()}
    assert got == {r.vn: r.hn is None or r.created_at <= first[r.hn] for r in rows}
    got = {r.vn: r.is_new for r in flag_new_inner(skewed, history).collect()}
    assert got == {r.vn: r.created_at == first[r.hn] for r in rows if r.hn is not None}


def test_hot_list_is_bounded(spark, skewed):
    hot = {r._hot: r._pieces for r in _pieces(skewed, "hn").collect()}
    known = N // 6 * 4
    assert hot == {7: -(-N // 2 * PIECES // known)}
    flat = spark.range(5000).select((F.col("id") % 900).alias("hn"))
    many = _pieces(flat, "hn").collect()
    assert len(many) < HOT_SHARE and sum(r._pieces for r in many) < HOT_SHARE + PIECES
    assert _pieces(flat.limit(0), "hn").collect() == []


def test_empty_and_all_null(spark):
    none = spark.createDataFrame([(1, None, 5), (2, None, 6)], "vn long, hn long, created_at int")
    assert {r.vn: r.is_new for r in flag_new_no_earlier(none, none).collect()} == {1: True, 2: True}
    assert flag_new_inner(none, none).collect() == []
    assert flag_new_no_earlier(none.limit(0), none).collect() == []
