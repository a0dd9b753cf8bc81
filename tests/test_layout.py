"""Storage layouts: UTC days in any session zone, co-located joins without a shuffle, time-sliced JDBC reads."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from clinicflow.operators.history import first_visits
from clinicflow.params import closed, half_open, prune_partitions
from clinicflow.plans import service_time
from clinicflow.sources.jdbc import time_slices
from clinicflow.sources.layout import scratch_database, with_visit, write_partitioned_facts
from clinicflow.sources.standins import standin_tables
from clinicflow.sources.tables import Tables

SF = "/root/testdata/sf0.001"
A, B = "1995-01-01 00:00:00", "2002-01-01 00:00:00"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Bangkok", "America/New_York"])
def test_a_day_of_instants_is_whole_in_any_session_zone(spark, tmp_path, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        hours = spark.range(72).select(
            F.col("id").alias("vn"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600).alias("created_at")
        )
        write_partitioned_facts(hours, str(tmp_path / "visit"), "created_at")
        visit = Tables.from_parquet(spark, str(tmp_path)).visit
        first, last = "2024-01-01 17:00:00", "2024-01-02 16:59:59.999999"  # a Bangkok day
        assert prune_partitions(visit, first, last).where(closed("created_at", first, last)).count() == 24
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.fixture(scope="module")
def stored(spark):
    t = standin_tables(spark, SF)
    few = Tables(visit=t.visit, encounter=t.encounter, queue=t.queue, visit_history=t.history(), patient=t.patient)
    return t, scratch_database(spark, 8, few)


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_service_rows_join_without_a_shuffle(spark, stored, no_broadcast):
    t, co_located = stored
    text = plan(service_time.service_rows(co_located, A, B))
    assert text.count("SortMergeJoin") == 2 and "Exchange" not in text, text
    assert "Exchange" in plan(service_time.service_rows(t, A, B))


def test_service_rows_equal_in_both_layouts(stored):
    t, co_located = stored
    want = service_time.service_rows(t, A, B)
    assert rows(service_time.service_rows(co_located, A, B).select(*want.columns)) == rows(want)
    assert want.where("called_at is not null").count() > 0


def test_first_visits_group_and_join_without_a_shuffle(spark, stored, no_broadcast):
    t, co_located = stored
    h = co_located.history()
    got = first_visits(h, h.where(half_open("created_at", A, B)))
    assert "Exchange" not in plan(got)
    history = t.history()
    assert rows(got) == rows(first_visits(history, history.where(half_open("created_at", A, B))))
    # window visits of the other key: only their keys are shuffled, never the history
    other = plan(first_visits(h, co_located.visit.where(half_open("created_at", A, B))))
    assert other.count("Exchange hashpartitioning") == 1


def test_calls_of_shared_or_unknown_encounters_keep_their_rows(spark):
    queue = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (9, "d"), (None, "e")], "en int, called_at string")
    encounter = spark.createDataFrame([(1, 10), (1, 11), (1, 10), (2, None), (3, 12), (None, 13)], "en int, vn int")
    got = sorted(map(tuple, with_visit(queue, encounter).select("en", "called_at", "vn").collect()), key=str)
    assert got == sorted([(1, "a", 10), (1, "a", 11), (1, "b", 10), (1, "b", 11), (2, "c", None), (9, "d", None), (None, "e", None)], key=str)


LITERAL = re.compile(r"created_at (>=|<|<=) TIMESTAMP WITH TIME ZONE '([^']+)'")


def holds(predicate, moment):
    test = {">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
    found = LITERAL.findall(predicate)
    assert len(found) == 2
    return all(test[op](moment, dt.datetime.fromisoformat(text)) for op, text in found)


@pytest.mark.parametrize("tz, offset", [("UTC", 0), ("Asia/Bangkok", 7), ("America/New_York", -5)])
@pytest.mark.parametrize("closed_end", [False, True])
def test_time_slices_hold_every_instant_once(tz, offset, closed_end):
    predicates = time_slices("created_at", "2026-01-01 00:00:00", "2026-01-03 12:00:00", 7, tz, closed_end)
    assert len(predicates) == 7
    zone = dt.timezone(dt.timedelta(hours=offset))
    start, end = dt.datetime(2026, 1, 1, tzinfo=zone), dt.datetime(2026, 1, 3, 12, tzinfo=zone)
    micro = dt.timedelta(microseconds=1)
    cuts = [dt.datetime.fromisoformat(LITERAL.findall(p)[0][1]) for p in predicates]
    assert cuts[0] == start
    for moment in [start, start - micro, end, end - micro, end + micro, *cuts, *[c - micro for c in cuts], start + 1234567 * micro]:
        inside = start <= moment and (moment <= end if closed_end else moment < end)
        assert sum(holds(p, moment) for p in predicates) == inside, moment


def test_time_slices_of_short_and_empty_ranges():
    day = dt.date(2026, 3, 1)
    assert time_slices("created_at", day, day, 4) == ["1 = 0"]
    assert time_slices("created_at", "2026-03-02", "2026-03-01", 4, closed=True) == ["1 = 0"]
    (one,) = time_slices("created_at", day, day, 4, closed=True)
    assert holds(one, dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc))
    two = time_slices("v.created_at", "2026-03-01 00:00:00", "2026-03-01 00:00:00.000002", 9)
    assert len(two) == 2 and two[1].startswith("v.created_at >= TIMESTAMP WITH TIME ZONE '2026-03-01 00:00:00.000001+00'")
    aware = dt.datetime(2026, 3, 1, tzinfo=dt.timezone(dt.timedelta(hours=9)))
    assert "2026-02-28 15:00:00" in time_slices("created_at", aware, "2026-03-02", 1)[0]
    with pytest.raises(ValueError):
        time_slices("created_at; drop", day, day, 1)
