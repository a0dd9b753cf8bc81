"""Property tests against brute-force Python on random inputs."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinicflow.operators.aggregates import distinct_by_flags
from clinicflow.operators.ordering import global_row_number, mark_runs

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from("ABC")), min_size=1, max_size=40))
def test_runs_match_template_loop(spark, keys):
    df = spark.createDataFrame([(i + 1, k) for i, k in enumerate(keys)], "seq long, hn string")
    got = {r.seq: r.new_run for r in mark_runs(df, "seq", "hn").collect()}
    last, expected = None, {}
    for i, k in enumerate(keys):
        expected[i + 1] = k != last
        if k != last:
            last = k
    assert got == expected


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.booleans()), max_size=60))
def test_distinct_by_flags_matches_count_distinct(spark, rows):
    df = spark.createDataFrame(rows, "g int, hn int, is_new boolean")
    out = distinct_by_flags(
        df, ["g"], "hn", {"new": F.col("is_new"), "old": ~F.col("is_new")}, total_distinct="people",
        row_count={"visits": F.lit(1)},
    )
    got = {r.g: (r.new, r.old, r.people, r.visits) for r in out.collect()}
    expected = {}
    for g in {r[0] for r in rows}:
        sub = [r for r in rows if r[0] == g]
        expected[g] = (
            len({r[1] for r in sub if r[2] and r[1] is not None}),
            len({r[1] for r in sub if not r[2] and r[1] is not None}),
            len({r[1] for r in sub if r[1] is not None}),
            len(sub),
        )
    assert got == expected


@SETTINGS
@given(st.lists(st.integers(0, 4), min_size=0, max_size=80), st.integers(1, 5))
def test_row_number_is_a_dense_sorted_numbering(spark, values, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v int")
    got = sorted((r.rn, r.v, r.id) for r in global_row_number(df, ["v"], ["id"], out="rn", num_partitions=parts).collect())
    expected = [(i + 1, v, rid) for i, (v, rid) in enumerate(sorted((v, rid) for rid, v in enumerate(values)))]
    assert got == expected


def test_percent_rounds_half_up_like_numeric(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from clinicflow.functions.expr import pct_half_up

    rnd = random.Random(11)
    pairs = [(rnd.randint(0, 5000), rnd.randint(0, 5000)) for _ in range(2000)] + [(1, 8), (1, 800), (0, 0), (3, 0)]
    df = spark.createDataFrame(pairs, "part long, whole long")
    got = {(r.part, r.whole): r.p for r in df.select("part", "whole", pct_half_up("part", "whole").alias("p")).collect()}
    for part, whole in pairs:
        want = (Decimal(part) * 100 / Decimal(whole)).quantize(Decimal("0.01"), ROUND_HALF_UP) if whole > 0 else Decimal("0.00")
        assert got[(part, whole)] == want, (part, whole)


def test_turnaround_minutes_round_half_away_from_zero(spark):
    import datetime as dt
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from clinicflow.functions.expr import minutes_between

    rnd = random.Random(5)
    base = dt.datetime(2024, 3, 10, 1, 0, 0)
    offs = [rnd.randint(-10**6, 10**6) * 1000 for _ in range(2000)] + [90_000_000, -90_000_000, 30_000_000, 0]
    rows = [(i, base, base + dt.timedelta(microseconds=o)) for i, o in enumerate(offs)]
    df = spark.createDataFrame(rows, "i long, a timestamp_ntz, b timestamp_ntz")
    got = {r.i: r.m for r in df.select("i", minutes_between("b", "a").alias("m")).collect()}
    for i, o in enumerate(offs):
        want = int((Decimal(o) / Decimal(60_000_000)).quantize(Decimal("1"), ROUND_HALF_UP))
        assert got[i] == want, o
