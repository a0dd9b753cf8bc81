"""Element-wise reading of the diagnosis JSON against Python's parser, and its cost."""

from __future__ import annotations

import json
import time

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinicflow.functions.jsonx import diagnosis_elements, is_rejected

TEXT = st.text(st.sampled_from('ab{}[]":,\\ \ncode'), max_size=8)
SCALAR = st.one_of(st.none(), st.booleans(), st.integers(-9, 9), TEXT)
OBJECT = st.dictionaries(st.sampled_from(["code", "display", "x"]), st.one_of(SCALAR, st.lists(SCALAR, max_size=2)), max_size=3)
VALUE = st.one_of(SCALAR, OBJECT, st.lists(st.one_of(SCALAR, OBJECT), max_size=5), st.just('{"code":"quoted"}'))


def field(value):
    """``->>``: text as it is, NULL for JSON null, other values as JSON text."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def expected(text):
    try:
        value = json.loads(text) if text is not None else None
    except ValueError:
        return None
    if not isinstance(value, list):
        return None
    return [(field(e.get("code")), field(e.get("display"))) if isinstance(e, dict) else (None, None) for e in value]


def decoded(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", diagnosis_elements("t").alias("e"), is_rejected("t").alias("r")).orderBy("i").collect()
    return [None if r.e is None else [(x.code, x.display) if x else (None, None) for x in r.e] for r in rows], [r.r for r in rows]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), VALUE.map(json.dumps), TEXT, st.lists(VALUE, max_size=6).map(json.dumps)), min_size=1, max_size=60))
def test_elements_equal_a_json_parser(spark, texts):
    texts = [t for t in texts if t is None or not t.strip() or _strict(t)]
    if not texts:
        return
    got, rejected = decoded(spark, texts)
    want = [expected(t) for t in texts]
    assert got == want, [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert rejected == [t is not None and w is None for t, w in zip(texts, want)]


def _strict(text):
    """Texts on which lenient and strict parsers agree: whole JSON, or no beginning of an array."""
    try:
        json.loads(text)
        return True
    except ValueError:
        return not text.lstrip().startswith("[")


def test_strings_that_look_like_objects_are_no_objects(spark):
    texts = [
        '["{\\"code\\":\\"q\\"}", {"code":"a"}]',
        '["\\u007b\\"code\\":\\"q\\"}", {"code":"b"}, 5, null, [{"code":"in"}], "s"]',
        '[{"code":"{x}","display":"{"}]',
        '[{"code":"a","display":1}, {"display":true}, {"code":{"k":[1,2]}}]',
        '[{"code":"a"},',
        "[]",
        "5",
        "",
    ]
    got, rejected = decoded(spark, texts)
    assert got == [
        [(None, None), ("a", None)],
        [(None, None), ("b", None), (None, None), (None, None), (None, None), (None, None)],
        [("{x}", "{")],
        [("a", "1"), (None, "true"), ('{"k":[1,2]}', None)],
        None,
        [],
        None,
        None,
    ]
    assert rejected == [False] * 4 + [True, False, True, True]


def test_time_is_linear_in_the_array(spark):
    def seconds(elements):
        text = json.dumps([{"code": f"C{i}", "display": f"dx {i}"} for i in range(elements)])
        df = spark.range(10).select(F.concat(F.lit(text), F.lit("")).alias("t"))
        count = df.select(F.explode(diagnosis_elements("t")).alias("e")).where("e.code is not null").agg(F.count(F.lit(1)))
        start = time.perf_counter()
        assert count.first()[0] == 10 * elements
        return time.perf_counter() - start

    seconds(200)
    small, large = min(seconds(500) for _ in range(3)), min(seconds(10_000) for _ in range(2))
    assert large < 20 * 3 * max(small, 0.05), (small, large)  # 20 times the elements; by place it took 400 times
