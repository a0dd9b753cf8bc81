import hashlib
import math

import numpy as np

from clinicflow.llm import bounded_codes as op

SCHEMA = "vec_id long, embedding array<float>, label string, code int, of string"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(vec_id, code, error, label_error, sha) by full scans in Python integers."""
    kept = [
        (i, l, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v, l in rows
        if v and all(x is not None and math.isfinite(x) and abs(x) < op.LIMIT / scale for x in v)
    ]
    sizes = [len(v) for _, _, v in kept if len(v) % parts == 0]
    n = max(set(sizes), key=lambda s: (sizes.count(s), s))
    kept = [r for r in kept if len(r[2]) == n]
    cut = lambda v, p: v[p * n // parts : (p + 1) * n // parts]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]
    nearest = lambda x, p: min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            to = [nearest(cut(v, p), p)[1] for _, _, v in kept]
            new = []
            for j, e in enumerate(books[p]):
                mine = [cut(v, p) for (_, _, v), t in zip(kept, to) if t == j]
                new.append([sum(col) // len(mine) for col in zip(*mine)] if mine else e)
            books[p] = new
    found = []
    for i, label, v in kept:
        best = [nearest(cut(v, p), p) for p in range(parts)]
        found.append((i, label, "".join("%02x" % j for _, j in best), sum(d for d, _ in best)))
    by = {}
    for _, label, _, e in found:
        by[label] = by.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, c, e, by[label], sha) for i, label, c, e in found]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], SCHEMA)


def got(df, **kw):
    return sorted((tuple(r) for r in op.encode(df, **kw).collect()), key=str)


def test_equals_full_scans_with_copies_ties_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(op, "HOT_SHARE", 3)  # both ways of joining label sums
    rnd = np.random.default_rng(7)
    rows = [(i, (rnd.normal(size=8) * 0.1).tolist(), [None, "a", "b", "c", "d", "e"][min(5, i % 11)]) for i in range(260)]
    rows += [(500 + i, rows[3][1], "b") for i in range(90)] + 2 * [(7, rows[9][1], None), (7, rows[8][1], "a"), (None, rows[5][1], "z")]
    rows += [(1000, None, "a"), (1001, [], "a"), (1002, [0.1] * 4, "a"), (1003, [0.1] * 7, "a"), (1004, [None] + [0.1] * 7, "a")]
    rows += [(1005, [math.nan] * 8, "a"), (1006, [math.inf] * 8, "a"), (1007, [1e6] * 8, "a")]
    for entries, rounds in ((16, 4), (256, 2)):
        assert got(frame(spark, rows), entries=entries, rounds=rounds) == sorted(brute(rows, entries=entries, rounds=rounds), key=str)


def test_empty_few_and_equal_vectors(spark):
    assert got(frame(spark, [(1, None, "a"), (2, [0.5] * 3, "b")])) == []
    rows = [(i, [0.25, -0.25, 0.5, 30000.0], "a") for i in range(5)]
    assert got(frame(spark, rows)) == sorted(brute(rows), key=str)


def rounds_of(x, entries, rounds, groups=op.GROUPS):
    """Codes of each round by bounds and by full scans, and the share of distances measured."""
    history = x[:entries][None].astype(np.int64)
    g = op.groups_of(history[0], groups)
    code, best, low, stamp = op.first_scan(x, history[0], g)
    shares = []
    for _ in range(rounds):
        counts = np.bincount(code, minlength=entries)
        sums = np.zeros_like(history[0])
        np.add.at(sums, code, x)
        history = np.concatenate([history, op.floor_means(sums, counts, history[-1])[None]])
        code, best, low, stamp, measured = op.next_scan(x, code, low, stamp, history, g)
        full = ((x[:, None] - history[-1][None]) ** 2).sum(axis=2)
        assert (code == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
        # Bounds hold for every entry of a group but the part's own one.
        bound = low - op.displacements(history, g)[stamp, np.arange(len(g))]
        full[np.arange(len(x)), code] = np.iinfo(np.int64).max
        for k, members in enumerate(g):
            assert (bound[:, k] <= np.sqrt(full[:, members].min(axis=1).astype(float))).all()
        shares.append(measured / full.size)
    return shares, stamp


def test_bounds_hold_and_spare_scans():
    rnd = np.random.default_rng(8)
    centre = rnd.integers(-1000, 1000, size=(64, 4))
    x = centre[rnd.integers(0, 64, 4000)] + rnd.integers(-40, 41, size=(4000, 4))
    shares, stamp = rounds_of(x, 64, 6)
    assert shares[-1] < 0.25, shares
    assert len(np.unique(stamp)) > 2  # bounds of several rounds are in use
    rounds_of(rnd.integers(-3, 4, size=(800, 2)), 30, 5)  # many ties and equal entries
    rounds_of(np.repeat(x[:40], 20, axis=0), 200, 3)


def test_net_displacement_is_tighter_than_summed_drift():
    there_and_back = np.array([[[0, 0]], [[30, 0]], [[1, 0]]])
    net = op.displacements(there_and_back, [np.array([0])])
    assert 1 <= net[0, 0] < 1.001 and 29 <= net[1, 0] < 29.001 and net[2, 0] == 0  # drifts sum up to 59


def test_distances_are_exact_beyond_doubles():
    x = np.array([[op.LIMIT - 1] * 16, [-op.LIMIT] * 16])
    c = np.array([[-op.LIMIT] * 16, [op.LIMIT - 2] * 16])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)) for e in c] for r in x]
    assert op.squared(x, c).tolist() == want
