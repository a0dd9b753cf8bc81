import re

from clinicflow.llm import quality_rules as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None,
    "",
    " \t\n\n",
    "one two",
    " ".join(f"w{i}" for i in range(30)) + ".",
    "a b c d e f g h " * 5,
    "a a a a a a a a a a a a a a a a a a a a a a a a",
    "a b c d e f g h x a b c d e f g h y a b c d e f g h",
    "line one\nline one\n \n \nline two \nline one",
    " ".join(f"W{i}!!" for i in range(30)),
    "\n".join(["home | about | shop | contact | help"] * 1 + ["this is a plain line of some words here."] * 1 + [" ".join(f"v{i}" for i in range(40))]),
    " ".join(f"long{i % 997}" for i in range(5000)),
    "\U0001f9ff x " * 12,
]


def test_measures_equal_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = op.apply_rules(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        n, chars, symbols, dups, repeat = brute(r.row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dups, repeat)
        assert r.base_failed == (n < 20 or 100 * repeat > 30 * n)
    kept = {r.row.doc_id: r.kept for r in got}
    assert kept[4] and not kept[9] and not kept[0]
    assert kept[10]
    assert "home" not in next(r.cleaned_text for r in got if r.row.doc_id == 10)


def test_filter_keeps_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, TEXTS[10], None, "s", 5), (2, TEXTS[9], "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    out = op.filter_documents(docs)
    assert out.dtypes == docs.dtypes
    rows = out.collect()
    assert [r.doc_id for r in rows] == [1] and rows[0].n_chars == len(rows[0].text)
    assert op.filter_documents(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = op.apply_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
