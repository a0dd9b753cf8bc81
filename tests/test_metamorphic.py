"""Metamorphic checks on the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinicflow.plans import completed_visits, department, scheme, service_time
from clinicflow.sources.standins import standin_tables

SF = "/root/testdata/sf0.001"
A, M, B = "1995-01-01 00:00:00", "1998-06-01 00:00:00", "2002-01-01 00:00:00"


def test_scheme_total_is_sum_of_days(spark):
    t = standin_tables(spark, SF)
    daily = scheme.scheme_daily(t, A, B)
    sums = daily.agg(*[F.sum(c).alias(c) for c in scheme.COUNT_COLS]).collect()[0]
    total = scheme.scheme_total(daily).collect()[0]
    assert [sums[c] for c in scheme.COUNT_COLS] == [total[c] for c in scheme.COUNT_COLS]
    assert sum(total[c] for c in scheme.COUNT_COLS) > 0


def test_last_cumulative_equals_sum_of_percent(spark):
    t = standin_tables(spark, SF)
    c = department.department_content(department.department_summary(t, A, B)).collect()
    last = max(c, key=lambda r: r.department)
    assert last.commulative_view == sum(r.percent for r in c)
    # new + old >= distinct people (a patient can be both in one department)
    assert all(r.new_patients + r.old_patients >= r.total_patients for r in c)
    assert any(r.new_patients + r.old_patients > r.total_patients for r in c)


def test_half_open_ranges_split_additively(spark):
    t = standin_tables(spark, SF)
    whole = completed_visits.completed_rows(t, A, B).count()
    parts = completed_visits.completed_rows(t, A, M).count() + completed_visits.completed_rows(t, M, B).count()
    assert whole == parts > 0
    whole = service_time.service_rows(t, A, B).count()
    parts = service_time.service_rows(t, A, M).count() + service_time.service_rows(t, M, B).count()
    assert whole == parts > 0
