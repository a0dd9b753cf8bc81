import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from clinicflow.llm import buckets
from clinicflow.llm import dart_minhash as op
from clinicflow.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1)))


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / max(sum(max(a[k], b[k]) for k in keys), 1)


def brute_classes(rows):
    """(id, class) by comparing all pairs."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingles(t) if t is not None else None for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] is None or rows[j][1] is None:
                continue
            if rows[i][1] == rows[j][1] or (sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    while len(rows) < n:
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 8, 40, 120, 400]))]
        for _ in range(rnd.choice([1, 1, 2, 6, 25])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 5, 12])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            rows.append((k, " ".join(copy)))
            k += 1
    return rows


def test_classes_equal_brute_force(spark):
    rows = corpus(3, 260) + [(9000, None), (9001, None), (9002, ""), (9003, ""), (9004, " \n"), (None, "only here once"), (None, ""), (0, None)]
    rows += [rows[5], rows[5], (9005, "a " * 300), (9006, "a " * 290), (9007, "a " * 200)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, class_id string, u int")
    got = sorted(((r.doc_id, r.class_id) for r in op.near_duplicate_classes(docs).collect()), key=str)
    assert got == brute_classes(rows)


def test_large_group_of_near_copies_is_one_class(spark):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(1500):
        copy = list(base)
        copy[rnd.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    got = op.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0} and len(got) == 1500


def test_far_copies_of_a_large_group_are_not_all_compared(spark, monkeypatch):
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(5000)}" for _ in range(150)]
    common = [f"c{i}" for i in range(40)]
    rows = []
    for i in range(500):
        copy = list(base)
        for at in rnd.sample(range(150), rnd.choice([2, 3, 4, 5, 6, 7, 8])):
            copy[at] = rnd.choice(common) if i % 3 else f"x{rnd.randrange(400)}"
        rows.append((i, " ".join(copy) + " a a a a a a a" * (i % 50 == 0)))
    rows += [(1000 + i, rows[i][1] + " end") for i in range(0, 500, 9)]
    asked, judged = [], op._judged
    monkeypatch.setattr(op, "_judged", lambda pairs, sets: asked.append(pairs.count()) or judged(pairs, sets))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id) for r in op.near_duplicate_classes(docs).collect()), key=str)
    assert got == brute_classes(rows)
    assert sum(asked) < 70 * len(rows), asked


def test_outlines_allow_every_near_pair(spark):
    rnd = random.Random(8)
    for repeated in (0, 3):  # cells that repeat one of their own set, as hashes cut to 32 bits may
        common = list(range(60))
        own = {}
        for k in range(90):
            cells = [c for c in common if rnd.random() > rnd.choice([0, 0.05, 0.2])] + [rnd.randrange(100, 400) for _ in range(rnd.randrange(12))]
            cells += cells[: rnd.randrange(repeated + 1)]
            own[k] = np.sort(np.array(cells, np.uint32)).tobytes()
        d = lambda a, b: 1.0 - op.similarity(own[a], own[b])
        crowded = spark.createDataFrame([(1, k, 0, 90, None if k == 0 else d(k, 0), k) for k in own], "bucket long, node long, leader long, n long, dl double, c long")
        sets = spark.createDataFrame([(k, bytearray(v)) for k, v in own.items()], "node long, cells binary")
        outlined, close = buckets.outlines(crowded, op._other_cells(crowded, sets), 0.2)
        member = {r.node: r for r in buckets._with_hope(outlined, 0.2).collect()}
        left = buckets._with_hope(outlined, 0.2).withColumnRenamed("node", "u")
        right = outlined.select(F.col("node").alias("v"), *[F.col(c).alias(f"{c}_v") for c in buckets.OUTLINE])
        allowed = {(r.u, r.v) for r in left.crossJoin(right).filter(buckets._possible(0.2)).select("u", "v").collect()}
        allowed |= {tuple(r) for r in close.collect()}
        near = [(a, b) for a in own for b in own if a > b and d(a, b) <= 0.2]
        assert len(member) == len(own) and len(near) > 50
        assert all(p in allowed for p in near)
        shared = {tuple(r) for r in close.collect()}
        assert all(member[a].hopeful and member[b].hopeful for a, b in near if (a, b) not in shared)


def test_other_cells_are_a_row_a_text_however_many_buckets_and_leaders(spark):
    per_text = []
    for n in (100, 800):
        rnd = random.Random(9)
        own = {k: [c for c in range(200) if rnd.random() > 0.1] + [rnd.randrange(10**3, 10**9) for _ in range(30)] for k in range(n)}
        leaders = range(n // 20)
        rows = [(b, k, b % len(leaders), rnd.random()) for k in own for b in rnd.sample(range(2 * len(leaders)), min(6, len(leaders)))]
        crowded = spark.createDataFrame(rows, "bucket long, node long, leader long, dl double")
        sets = spark.createDataFrame([(k, bytearray(np.sort(np.array(v, np.uint32)).tobytes())) for k, v in own.items()], "node long, cells binary")
        got = op._other_cells(crowded, sets).collect()
        assert len({r.node for r in got}) == len(got) == len({r[1] for r in rows})
        assert all(set(np.array(r.others, np.int32).view(np.uint32).tolist()) <= set(own[r.node]) for r in got)
        per_text.append(sum(len(r.others) for r in got) / len(got))
    assert per_text[1] < 1.1 * per_text[0]


def test_signature_agreement_estimates_weighted_similarity():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 2**63, 300).astype(np.uint64)
    b = a.copy()
    b[:60] = rnd.integers(0, 2**63, 60).astype(np.uint64)
    words, offsets = np.concatenate([a, b]), np.array([0, 300, 600])
    doc, cell = op.cells(words, offsets)
    signature, filled = op.signatures(doc, cell, 2, k=2048)
    want = op.similarity(*[np.sort((cell[doc == i] & np.uint64(0xFFFFFFFF)).astype(np.uint32)).tobytes() for i in (0, 1)])
    assert filled.all() and abs((signature[0] == signature[1]).mean() - want) < 0.04


def test_keep_one_of_each(spark):
    rows = corpus(4, 120) + [(9000, None), (None, "zzz"), (9002, "")]
    rows += [rows[3], rows[3]]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    left = op.keep_one_of_each(docs)
    assert left.columns == docs.columns
    want = {c for d, c in brute_classes(rows) if d is not None and rows}
    want |= {9000}
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([*want, None], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.near_duplicate_classes(docs).collect() == []
    assert op.keep_one_of_each(docs).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(7, 7)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 150)}}
