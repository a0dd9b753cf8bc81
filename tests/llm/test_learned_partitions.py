import math

import numpy as np

from clinicflow.llm import learned_partitions as op

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, every, k):
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    ids = np.array([i for i, _ in rows])
    out = {}
    for q in sorted({i for i in ids.tolist() if i % every == 0}):
        best = {}
        own = x[np.flatnonzero(ids == q)]
        for i, s in zip(ids.tolist(), (x @ own.T).max(axis=1).tolist()):
            if i != q:
                best[i] = max(best.get(i, -math.inf), s)
        out[q] = sorted(best.items(), key=lambda t: (-t[1], t[0]))[:k]
    return out


def rows_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_one_part_is_exact_with_ties_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(op, "PARTS", 1)  # every vector is ranked: what is left out can only come from the ranking
    monkeypatch.setattr(op, "BLOCK", 40)
    rnd = np.random.default_rng(1)
    rows = [(i, rnd.normal(size=5).round(2).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [(40, rows[40][1])]
    bad = [(1000, None), (1020, [0.0] * 5), (1040, [1.0, None, 1.0, 1.0, 1.0]), (1060, [math.nan] * 5), (1080, [math.inf] * 5), (1100, [1.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], SCHEMA)
    got, want = rows_of(op.search(df, k=7)), brute(rows, 20, 7)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_fewer_candidates_than_asked_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], "x"), (1, [1.0, 1.0], "x"), (2, [1.0, 3.0], "x")], SCHEMA)
    assert [i for i, _ in rows_of(op.search(df))[0]] == [2, 1]
    assert op.search(df.limit(0)).collect() == []
    assert op.search(df.filter("vec_id = 0")).collect() == []


def test_repeated_rows_take_no_place(spark, monkeypatch):
    monkeypatch.setattr(op, "PARTS", 1)
    rnd = np.random.default_rng(3)
    rows = 2 * [(i, rnd.normal(size=5).round(2).tolist()) for i in range(100)]
    rows += 30 * [(200, rows[20][1])] + [(200 + i, rows[20][1]) for i in range(1, 4)]
    got, want = rows_of(op.search(spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA))), brute(rows, 20, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and len(got[q]) == 20, q


def test_recall_with_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "PARTS", 6)
    monkeypatch.setattr(op, "BLOCK", 90)
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(12, 16))
    x = centres[rnd.integers(0, 12, 1200)] + 0.4 * rnd.normal(size=(1200, 16))
    x[300:500] = x[7]  # many copies of one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = rows_of(op.search(spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA), k=10)), brute(rows, 20, 10)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    assert [i for i, _ in got[320]][:3] == [7, 300, 301]


def test_recall_of_the_query(spark):
    from clinicflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    got = rows_of(QUERIES["op2_learned_partitions"](spark, sf))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, 20, 20)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_recall_at_fifty_thousand_vectors():
    """Parts asked as the query does, against brute force, on an even sphere, on clusters and with many copies."""
    rnd = np.random.default_rng(5)
    sphere = lambda n: (x := rnd.normal(size=(n, 64))) / np.linalg.norm(x, axis=1, keepdims=True)
    even = sphere(50_000)
    clustered = sphere(300)[rnd.integers(0, 300, 50_000)] + 0.05 * rnd.normal(size=(50_000, 64))
    copied = sphere(50_000)
    copied[::3] = copied[0]
    for name, x in (("even", even), ("clustered", clustered), ("copied", copied)):
        router = op.fit(x[rnd.choice(len(x), op.SAMPLE, replace=False)])
        part = router.probabilities(x).argmax(axis=1)
        counts = np.bincount(part, minlength=op.PARTS)
        asked = rnd.choice(len(x), 150, replace=False)
        recall = []
        for q, to in zip(asked, op.routes(router.probabilities(x[asked]), counts, 80)):
            s = x @ x[q]
            s[q] = -np.inf
            limit = np.partition(s, -20)[-20]
            near = s >= limit - 1e-12
            seen = np.isin(part, to)
            recall.append(min(20, (near & seen).sum()) / 20)
        assert np.mean(recall) >= 0.9, (name, np.mean(recall))
