"""Column expressions: dates, Buddhist era, Thai formats, gender, numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinicflow.functions import dates as D
from clinicflow.functions import expr as X
from clinicflow.params import ts_lit


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0]["x"]


def test_buddhist_era_clamps_29_february(spark):
    assert one(spark, D.buddhist_date_text(ts_lit("2000-02-29 10:00:00"))) == "28/02/2543"
    assert one(spark, D.buddhist_date_text(ts_lit("2024-01-31 00:00:00"))) == "31/01/2567"


def test_thai_short_date_and_next_day(spark):
    assert one(spark, D.thai_short_date(ts_lit("2026-01-12 00:00:00"))) == "12 ม.ค. 69"
    assert one(spark, D.thai_short_date(ts_lit("2057-03-05 00:00:00"))) == "5 มี.ค. 00"
    assert one(spark, D.thai_short_date(ts_lit("2057-03-05 00:00:00"), pad_year=False)) == "5 มี.ค. 0"
    # +1 day carries over month / year ends and leap days
    assert one(spark, D.fmt_date(D.next_day(ts_lit("2024-02-28 00:00:00")))) == "29/02/2024"
    assert one(spark, D.fmt_date(D.next_day(ts_lit("2023-12-31 00:00:00")))) == "01/01/2024"


def test_parse_be_date_and_iso_part(spark):
    assert str(one(spark, D.parse_be_date(F.lit("31/01/2568")))) == "2025-01-31"
    assert one(spark, D.parse_be_date(F.lit("31/02/2568"))) is None
    assert one(spark, D.parse_be_date(F.lit("garbage"))) is None
    assert one(spark, D.iso_date_part(F.lit("2026-01-03T00:00:00+07:00"))) == "2026-01-03"


def test_report_zone_is_independent_of_session_zone(spark):
    assert str(one(spark, D.to_report_tz(ts_lit("2024-01-01 23:30:00")))) == "2024-01-02 06:30:00"
    assert one(spark, D.fmt_time(D.to_report_tz(ts_lit("2024-01-01 23:30:00")))) == "06:30"


def test_text_dates_sort_as_text(spark):
    df = spark.createDataFrame([("02/01/2024",), ("01/02/2024",)], "d string")
    assert [r.d for r in df.orderBy("d").collect()] == ["01/02/2024", "02/01/2024"]


def test_gender_placeholder_numbers(spark):
    df = spark.createDataFrame([("Male",), ("F",), ("2",), ("ชาย",), (None,), ("x",)], "g string")
    assert [r.x for r in df.select(X.gender_normalise("g").alias("x")).collect()] == [
        "male", "female", "female", "male", "unknown", "unknown",
    ]
    assert one(spark, X.placeholder(F.lit(""))) == "-"
    assert one(spark, X.blank_if_falsy(F.lit(0))) == ""
    assert one(spark, X.fmt_number(F.lit(1234567.5), 2)) == "1,234,567.50"
    assert one(spark, X.int_or_zero(F.lit("abc"))) == 0


def test_minutes_round_half_away_from_zero(spark):
    a = ts_lit("2024-01-01 00:00:00")
    assert one(spark, X.minutes_between(ts_lit("2024-01-01 00:02:30"), a)) == 3
    assert one(spark, X.minutes_between(ts_lit("2023-12-31 23:57:30"), a)) == -3
    assert one(spark, X.minutes_between(ts_lit("2024-01-01 00:00:29"), a)) == 0


def test_plan_category(spark):
    df = spark.createDataFrame([("UCS", "x"), (None, "เงินสด"), (None, "Other")], "c string, n string")
    assert [r.x for r in df.select(X.plan_category("c", "n").alias("x")).collect()] == ["UCS", "CASH", "OTHER"]


def test_formats_ignore_session_zone_dst_gap(spark):
    """A wall-clock time inside a daylight-saving gap of the session zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = ts_lit("2024-03-10 02:30:15")
        assert one(spark, D.fmt_time(t)) == "02:30"
        assert one(spark, D.fmt_date(t)) == "10/03/2024"
        assert one(spark, D.fmt_datetime(t)) == "2024-03-10 02:30:15"
        assert one(spark, X.minutes_between(ts_lit("2024-03-11 02:30:15"), ts_lit("2024-03-10 02:30:15"))) == 1440
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_jdbc_tables_are_lazy_and_instants_become_utc_wall_clock(spark):
    import datetime as dt

    from clinicflow.sources.tables import Tables, utc_wall_clock

    # nothing connects until a table is used
    t = Tables.from_jdbc(spark, "jdbc:postgresql://unused/db", {"user": "u"}, partitioning={"visit": ("vn", 0, 10, 2)})
    assert isinstance(t, Tables)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
    try:
        df = spark.sql("select timestamp'2024-01-01 07:00:00' as created_at, 1 as vn")
        out = utc_wall_clock(df).collect()[0]
        assert out.created_at == dt.datetime(2024, 1, 1, 0, 0) and out.vn == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
