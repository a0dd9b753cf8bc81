"""Mergeable distinct counts, daily counts with corrections, and collations."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from clinicflow.operators.increments import apply_batch
from clinicflow.operators.percent import cumulative
from clinicflow.operators.states import FEW, distinct_states, merge_states, number_keys
from clinicflow.plans import department, diagnosis
from clinicflow.plans.base import Report
from clinicflow.sources.sinks import write_report
from clinicflow.sources.standins import standin_tables

SF = "/root/testdata/sf0.001"


def test_states_of_any_days_merge_to_exact_distincts(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(1, 6), rnd.choice("AB"), rnd.choice([None, *range(0, 200_000, 977)]), rnd.random() < 0.4) for _ in range(1500)]
    df = spark.createDataFrame(rows, "day int, g string, hn long, is_new boolean")
    numbers = number_keys(df, "hn")
    assert sorted(r.number for r in numbers.collect()) == list(range(1, numbers.count() + 1))
    spread = numbers.withColumn("number", F.col("number") * 1000)  # several buckets
    states = distinct_states(df, spread, ["day", "g"], "hn", {"new": F.col("is_new"), "people": F.lit(True)}, {"visits": F.lit(1)})
    assert states.select("bucket").distinct().count() > 3
    for days in ({1}, {2, 5}, {1, 2, 3, 4, 5, 6}):
        got = {tuple(r) for r in merge_states(states.where(F.col("day").isin(*days)), ["g"], ["new", "people"], ["visits"]).collect()}
        want = set()
        for g in "AB":
            some = [r for r in rows if r[0] in days and r[1] == g]
            people = {r[2] for r in some if r[2] is not None}
            want.add((g, len({r[2] for r in some if r[3] and r[2] is not None}), len(people), len(some)))
        assert got == want


def test_states_of_few_and_many_keys(spark):
    """Buckets on both sides of FEW merge; a day of few keys holds no bitmap."""
    many = spark.range(FEW + 5).selectExpr("1 AS day", "'A' AS g", "id AS hn", "id % 3 = 0 AS new")
    few = spark.range(0, 1000, 7).selectExpr("2 AS day", "'A' AS g", "id AS hn", "id % 2 = 0 AS new")
    edge = spark.range(FEW).selectExpr("3 AS day", "'B' AS g", "id AS hn", "CAST(NULL AS boolean) AS new")
    none = spark.range(3).selectExpr("4 AS day", "CAST(NULL AS string) AS g", "CAST(NULL AS bigint) AS hn", "true AS new")
    rows = many.union(few).union(edge).union(none)
    states = distinct_states(rows, number_keys(rows, "hn"), ["day", "g"], "hn", {"new": F.col("new"), "people": F.lit(True)}, {"visits": F.lit(1)})
    assert {(r.day, r["new"] is None) for r in states.collect()} == {(1, False), (2, True), (3, True), (4, True)}
    got = {tuple(r) for r in merge_states(states, ["g"], ["new", "people"], ["visits"]).collect()}
    first, second = set(range(FEW + 5)), set(range(0, 1000, 7))
    fresh = {i for i in first if i % 3 == 0} | {i for i in second if i % 2 == 0}
    assert got == {("A", len(fresh), len(first | second), len(first) + len(second)), ("B", 0, FEW, FEW), (None, 0, 0, 3)}


def test_known_numbers_stay_when_patients_come(spark):
    first = number_keys(spark.createDataFrame([(5,), (9,), (None,)], "hn int"), "hn")
    both = number_keys(spark.createDataFrame([(9,), (1,), (7,), (1,)], "hn int"), "hn", first)
    assert {r.hn: r.number for r in both.collect()} == {5: 1, 9: 2, 1: 3, 7: 4}


def test_window_states_equal_the_direct_summary(spark):
    t = standin_tables(spark, SF)
    a, b = "1996-01-01 00:00:00", "1997-12-31 23:59:59"
    states = department.department_states(t, a, b, number_keys(t.history(), "hn"))
    assert sorted(map(tuple, department.department_summary_of(t, states).collect())) == sorted(map(tuple, department.department_summary(t, a, b).collect()))


def test_corrections_equal_a_recomputation(spark):
    schema = "k int, day string, ok boolean, version int"
    contribution = lambda rows: rows.where("ok").groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    rnd, truth = random.Random(4), {}
    empty = spark.createDataFrame([], schema)
    current, state = empty, contribution(empty)
    for version in (1, 2, 3):
        batch = [(rnd.randint(1, 40), rnd.choice(["d1", "d2", "d3"]), rnd.random() < 0.7, version * 100 + i) for i in range(30)]
        batch += [(99, "d9", version == 1, version * 100)]  # counted first, taken back later: its day goes
        batch += [(batch[0][0], "d0", True, -1)]  # older than what is there: nothing
        for k, day, ok, v in batch:
            if k not in truth or truth[k][2] < v:
                truth[k] = (day, ok, v)
        frame = spark.createDataFrame(batch, schema)
        for _ in range(2):  # a batch that comes again changes nothing
            current, state = apply_batch(current, state, frame, "k", "version", contribution, ["day"], ["n"])
        want = {}
        for day, ok, _ in truth.values():
            if ok:
                want[day] = want.get(day, 0) + 1
        assert {r.day: r.n for r in state.collect()} == want
        assert {r.k: (r.day, r.ok, r.version) for r in current.collect()} == truth


THAI = ["ไต", "เด็ก", "กุมาร", "แพทย์", "ผิวหนัง", "อายุรกรรม", "หู"]
THAI_ORDER = ["กุมาร", "เด็ก", "ไต", "ผิวหนัง", "แพทย์", "หู", "อายุรกรรม"]  # by consonant, leading vowels after it


def test_thai_names_in_dictionary_order(spark, tmp_path):
    df = spark.createDataFrame([(n, 10) for n in THAI] + [(None, 10)], "department string, percent int")
    run = {r.department: r.c for r in cumulative(df, "percent", "department", "c", "th").collect()}
    assert run == {**{n: 10 * (i + 1) for i, n in enumerate(THAI_ORDER)}, None: 80}
    binary = {r.department: r.c for r in cumulative(df, "percent", "department", "c").collect()}
    assert binary == {**{n: 10 * (i + 1) for i, n in enumerate(sorted(THAI))}, None: 80}
    for collation, order in (("th", THAI_ORDER), (None, sorted(THAI))):
        path = str(tmp_path / str(collation))
        write_report(Report(spark.range(1), df.coalesce(1), order=("department",), collation=collation), path)
        lines = spark.read.json(f"{path}/content").coalesce(1).collect()
        assert [r.department for r in lines] == [*order, None]


def test_peers_and_groups_follow_a_case_folding_collation(spark):
    df = spark.createDataFrame([("i10", 1), ("I10", 2), ("j00", 4)], "department string, percent int")
    assert {r.department: r.c for r in cumulative(df, "percent", "department", "c", "UTF8_LCASE").collect()} == {"i10": 3, "I10": 3, "j00": 7}
    rows = spark.createDataFrame(
        [(1, "I10", "a", "01/01/2024", ("m",)), (2, "i10", "b", "01/01/2024", ("f",)), (3, "J00", "c", "02/01/2024", ("m",)), (4, "i10", "d", None, (None,))],
        "hn int, diagnosis_code string, diagnosis_name string, visit_date string, patient struct<gender:string>",
    )
    folded = sorted(map(tuple, diagnosis.diagnosis_by_gender(rows, None, "UTF8_LCASE").collect()))
    assert folded == [("I10", "a", 1, 1, 2), ("J00", "c", 1, 0, 1)]
    exact = sorted(map(tuple, diagnosis.diagnosis_by_gender(rows, None).collect()))
    assert exact == [("I10", "a", 1, 0, 1), ("J00", "c", 1, 0, 1), ("i10", "b", 0, 1, 1)]
