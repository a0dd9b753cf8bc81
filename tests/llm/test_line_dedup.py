import random
import re

from pyspark.sql import functions as F

from clinicflow.llm import line_dedup as op

WORDED = re.compile(r"[^\x20\x09-\x0D]")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rnd, text, n):
    out = list(text)
    for _ in range(n):
        kind, at = rnd.randrange(3), rnd.randrange(len(out) or 1)
        kind = kind if out else 1
        if kind == 0:
            out[at] = rnd.choice("xyzé\U0001f9ff")
        elif kind == 1:
            out.insert(at, rnd.choice("xyz "))
        else:
            del out[at]
    return "".join(out)


def brute(rows):
    """(id, line_no) -> (class place, links, removed)."""
    places = [(d, k, line) for d, t in rows if t is not None for k, line in enumerate(t.split("\n")) if WORDED.search(line)]
    order = lambda p: (p[0] is None, p[0] or 0, p[1])
    texts = sorted({p[2] for p in places})
    first = {t: min((p for p in places if p[2] == t), key=order)[:2] for t in texts}
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    links = dict.fromkeys(texts, 0)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if min(len(a), len(b)) >= op.MIN_CHARS and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                parent[find(a)] = find(b)
                links[a] += 1
                links[b] += 1
    least = {}
    for t in texts:
        root = find(t)
        least[root] = min(least.get(root, first[t]), first[t], key=order)
    return sorted(((d, k, *least[find(t)], links[t], (d, k) != least[find(t)]) for d, k, t in places), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    bases = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.choice([5, 23, 24, 30, 60]))) + "q" for _ in range(25)]
    rows = []
    for i in range(40):
        lines = [edited(rnd, rnd.choice(bases), rnd.choice([0, 0, 1, 2, 3])) for _ in range(rnd.randint(1, 5))]
        rows.append((i, "\n".join(lines)))
    return rows


def got_rows(df):
    return sorted(((r.doc_id, r.line_no, r.class_id, r.class_line, r.n_links, r.removed) for r in df.collect()), key=str)


def test_classes_and_links_equal_brute_force(spark):
    rows = corpus(1) + [(900, None), (901, ""), (902, " \n\t\n"), (None, "one more line that has no id at all"), (903, "short\nshort\n\nshort ")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, line string")
    assert got_rows(op.line_classes(docs)) == brute(rows)


def test_hot_segments_lose_no_class(spark, monkeypatch):
    monkeypatch.setattr(op, "HOT", 2)
    rows = corpus(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, want = got_rows(op.line_classes(docs)), brute(rows)
    assert [r[:4] for r in got] == [r[:4] for r in want]


def test_links_of_a_group_past_hot_are_whole(spark):
    rows = [(i, f"one and the same line but for its item {i:02d}") for i in range(1, 41)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(rows) > op.HOT and {r.n_links for r in op.line_classes(docs).collect()} == {39}


def test_links_of_hot_segments_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op, "HOT", 2)
    monkeypatch.setattr(op, "BLOCK", 3)
    rows = corpus(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_rows(op.line_classes(docs)) == brute(rows)


def test_automaton_equals_edit_distance(spark):
    rnd = random.Random(3)
    pairs = []
    for _ in range(400):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9)))
        pairs.append((a, edited(rnd, a, rnd.randint(0, 4))))
    for threshold in (0, 1, 2, 3):
        df = spark.createDataFrame(pairs, "a string, b string")
        near = op.within_distance(op.code_points(F.col("a")), op.code_points(F.col("b")), threshold)
        for r in df.select("a", "b", near.alias("near")).collect():
            assert r.near == (distance(r.a, r.b) <= threshold), (r, threshold)


def test_pieces_lose_no_near_pair(spark):
    rnd = random.Random(6)
    pairs = [("", ""), ("a", ""), ("ab", "ba"), ("é" * 9, "é" * 7), ("x" * 40, "y" * 40)]
    for _ in range(600):
        a = "".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 40)))
        pairs.append((a, edited(rnd, a, rnd.randint(0, 4))))
    unlike = 0
    for threshold in (1, 2):
        rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", op.plausible(F.col("a"), F.col("b"), threshold).alias("p")).collect()
        for r in rows:
            assert r.p or distance(r.a, r.b) > threshold, (r, threshold)
            unlike += not r.p
    assert unlike > 100


def test_removed_lines_leave_the_texts(spark):
    long = "this line is long enough to be compared"
    rows = [(1, f"{long}\nown words", "en", 5), (2, f"{long}!\nother words", "en", 5), (3, long, "en", 5), (4, None, "en", 0), (5, "", "en", 0), (6, "a\n\nb", "en", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    out = op.remove_duplicate_lines(docs)
    assert out.dtypes == docs.dtypes
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: (rows[0][1], 5), 2: ("other words", 11), 4: (None, 0), 5: ("", 0), 6: ("a\n\nb", 4)}
    assert op.remove_duplicate_lines(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(corpus(1), "doc_id long, text string")
    assert "Python" not in op.line_classes(docs)._jdf.queryExecution().executedPlan().toString()


def test_segment_keys_are_those_of_the_code_points(spark):
    """Equal segments of lines of any script have one key; places outside of the line have none."""
    lines = ["abcdefghijklmnopqrstuvwxyz", "\u0e44\u0e15\u0e40\u0e14\u0e47\u0e01" * 5, "a\U0001f9ff\u00e9" * 9, "x"]
    for threshold in (1, 2):
        own, moved = op.own_places(threshold), op.moved_places(threshold)
        assert len(set(own + moved)) == len(own) + len(moved) and (threshold != 2 or len(moved) == 9)
        keys = lambda places: op.segment_keys(F.col("line"), F.char_length("line"), threshold, places)
        rows = spark.createDataFrame([(x,) for x in lines], "line string").select("line", keys(own).alias("own"), keys(own + moved).alias("all")).collect()
        for r in rows:
            n, parts, seen = len(r.line), threshold + 1, {}
            for (gap, i, shift), key in zip(own + moved, r["all"]):
                m = n - gap
                at = sum(m // parts + (k >= parts - m % parts) for k in range(i)) + shift
                size = m // parts + (i >= parts - m % parts)
                assert (key is None) == (at < 0 or at + size > n)
                assert key is None or seen.setdefault((m, i, r.line[at : at + size]), key) == key
            assert r["own"] == r["all"][: len(own)] and len({k for k in seen.values()}) == len(seen)


def test_lines_meet_marks_and_classes_in_few_joins(spark):
    """Lines are joined with what is known of them by grouping: no left join of all lines with their class."""
    docs = spark.createDataFrame([(1, "one line of many words here\nanother line of other words"), (2, "one line of many words hers")], "doc_id long, text string")
    out = op.line_classes(docs)
    assert "LeftOuter" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert got_rows(out) == brute([(1, "one line of many words here\nanother line of other words"), (2, "one line of many words hers")])
