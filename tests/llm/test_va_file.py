import hashlib
import math

import numpy as np

from clinicflow.llm import va_file as op

SCHEMA = "vec_id long, embedding array<float>, cells string, cluster int"


def brute(rows, centroids=16, rounds=3, scale=64, dims=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, sha) by whole scans in Python integers."""
    kept = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, name(r[0]), r[1]))
    c = [v for _, v in order[:centroids]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        to = [nearest(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), t in zip(kept, to) if t == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [(i, *nearest(v)) for i, v in kept]
    sums = {}
    for _, d, j in found:
        sums[j] = sums.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return [(i, j, d, sums[j], sum(sums.values()), sha[j]) for i, d, j in found]


def got(df, **kw):
    return sorted((tuple(r) for r in op.cluster(df, **kw).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 3) for i, v in rows], SCHEMA)


def test_equals_whole_scans_with_copies_ties_and_unusable_rows(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, (rnd.normal(size=6) * 0.2).tolist()) for i in range(300)]
    rows += [(400 + i, rows[9][1]) for i in range(120)] + 2 * [(7, rows[7][1]), (7, rows[8][1]), (None, rows[5][1])]
    rows += [(900 + i, [0.5, -0.5, 0.0, 0.0, 1.0, -1.0]) for i in range(5)]
    rows += [(1000, None), (1001, []), (1002, [0.1] * 5), (1003, [0.1] * 5 + [None]), (1004, [math.nan] * 6), (1005, [0.1] * 5 + [-math.inf])]
    for centroids, rounds in ((16, 3), (5, 1)):
        want = sorted(brute(rows, centroids, rounds, dims=6), key=str)
        assert got(frame(spark, rows), centroids=centroids, rounds=rounds, dims=6) == want


def test_empty_few_and_equal_vectors(spark):
    assert got(frame(spark, [(1, None)])) == []
    rows = [(i, [0.25] * 64) for i in range(3)]
    assert got(frame(spark, rows)) == sorted(brute(rows), key=str)  # as many centroids as vectors, all equal: ties to the first
    rows = [(i, [float(i), -0.1 * i]) for i in range(40)]
    assert got(frame(spark, rows), dims=2, bits=2) == sorted(brute(rows, dims=2), key=str)


def test_large_components_are_exact(spark):
    rows = [(i, [3000.0 * i, -250000.0 + i, 0.0]) for i in range(30)] + [(99, [3e38, 0.0, 0.0])]
    assert got(frame(spark, rows), dims=3) == sorted(brute(rows[:-1], dims=3), key=str)


def test_intervals_hold_the_distances_and_spare_fetches():
    rnd = np.random.default_rng(5)
    centre = rnd.integers(-60, 60, size=(16, 64))
    v = centre[rnd.integers(0, 16, 3000)] + rnd.integers(-6, 7, size=(3000, 64))
    cells = op.Cells(v[:500], v.min(axis=0), v.max(axis=0))
    look, approximation = op.Lookup(cells, centre), cells.of(v)
    score = (centre * centre).sum(axis=1) - 2 * (v @ centre.T)
    for d in range(64):
        part = centre[:, d] ** 2 - 2 * v[:, [d]] * centre[:, d]
        assert (look.least[d][approximation[:, d]] <= part).all() and (part <= look.most[d][approximation[:, d]]).all()
    to, fetched = op.assign(look, approximation, lambda rows: v[rows])
    assert (to == score.argmin(axis=1)).all()
    assert len(fetched) < 30  # clusters apart: cells alone assign 99 % of the vectors


def test_moves_change_sums_as_full_counts_do(spark):
    rnd = np.random.default_rng(6)
    v = rnd.integers(-40, 40, size=(500, 3))
    cells = op.Cells(v, v.min(axis=0), v.max(axis=0))
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, v array<long>")
    stored, shared = op._stored(rows, 3, 4)
    before, now = v[:8], v[8:16]
    full = lambda c: {r[0]: r[1:] for r in _sums(op._moved_sums(stored, shared, None, c), 3)}
    change = {r[0]: r[1:] for r in _sums(op._moved_sums(stored, shared, before, now), 3)}
    for j in range(8):
        zero = (0,) * 4
        a, b, c = full(before).get(j, zero), full(now).get(j, zero), change.get(j, zero)
        assert tuple(x + y for x, y in zip(a, c)) == tuple(b)
    assert (op.assign(op.Lookup(cells, now), cells.of(v), lambda at: v[at])[0] == ((v[:, None] - now[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def _sums(df, dims):
    from pyspark.sql import functions as F

    return [tuple(r) for r in df.groupBy("cluster").agg(F.sum("n"), *[F.sum(F.col("s")[d]) for d in range(dims)]).collect()]
