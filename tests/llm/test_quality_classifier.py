import random
import zlib

import numpy as np

from clinicflow.llm import quality_classifier as op

DOCS = "doc_id long, text string, score string"


def good(rnd):
    return "\n".join(" ".join(rnd.choice(["the", "house", "stands", "near", "a", "river", "and", "hills", f"w{rnd.randrange(900)}"]) for _ in range(12)).capitalize() + "." for _ in range(rnd.randint(2, 9)))


def bad(rnd):
    words = [f"w{rnd.randrange(900)}" for _ in range(60)]
    return rnd.choice([" | ".join(words), " ".join(w.upper() + "!!" for w in words), " ".join(w + rnd.choice(["###", "$$$"]) for w in words), "w1 " * 80])


def corpus(n=500):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        label = int(rnd.random() < 0.7)
        rows.append((i, good(rnd) if label else bad(rnd), "x"))
        labels.append((i, label))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "some text here", "x"), rows[3]]
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels + [(5000, 1), (None, 0), (7, None), (3, labels[3][1])], "doc_id long, quality int")
    got = op.classify(docs, known).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.98
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_without_labels_and_with_one_kind(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, None, "x")], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in op.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, quality int")
    assert {r.score for r in op.classify(docs, one).collect()} == {1.0}
    assert op.classify(docs.limit(0), none).collect() == []


def test_isotonic_is_rising_and_keeps_the_mean():
    rnd = np.random.default_rng(0)
    n = rnd.integers(1, 20, 50)
    s = rnd.binomial(n, np.linspace(0.1, 0.9, 50))
    x, y = op.isotonic(np.arange(50.0), n, s)
    assert (np.diff(y) > 0).all() and (np.diff(x) > 0).all()


def test_statistics_equal_brute_force(spark):
    text = "Ab  ab ab!\n\nXY | z9 #.\nAb"
    x = op.statistics(spark.createDataFrame([(1, text, "x")], DOCS)).first().x
    words = text.split()
    chars = sum(map(len, words))
    want = {"log_words": np.log1p(len(words)), "word_length": chars / len(words), "word_variety": len(set(words)) / len(words), "same_word_runs": 0, "capitals": 4 / chars, "digits": 1 / chars, "symbols": 2 / len(words), "exclamations": 1 / len(words), "lone_marks": 1 / len(words), "line_variety": 1.0, "line_ends": 2 / 3}
    for name, value in want.items():
        assert abs(x[op.STATISTICS.index(name)] - value) < 1e-12, name
