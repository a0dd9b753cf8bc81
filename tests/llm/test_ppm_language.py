import math
import random
import zlib

import numpy as np

from clinicflow.llm import ppm_language as op

WORDS = {
    "en": "the of and house river stands near light with water that this from where which".split(),
    "de": "der die und haus fluss steht nahe licht mit wasser dass dieses von wo welche über".split(),
    "fr": "le la et maison rivière est près lumière avec eau que cette depuis où quelle été".split(),
}


def sentence(rnd, lang, n):
    return " ".join(rnd.choice(WORDS[lang]) for _ in range(n))


def test_held_out_accuracy_and_edges(spark):
    rnd = random.Random(1)
    rows = [(i, sentence(rnd, lang, rnd.randint(3, 60)), lang) for i, lang in enumerate(rnd.choices(list(WORDS), k=300))]
    truth = {i: lang for i, _, lang in rows}
    rows += [(900, None, "en"), (901, "", "en"), (902, "123 !!", "en"), (903, "the house", None), (None, "die und der", "de"), rows[0]]
    rows += [(904, "日本語", "en"), (905, "THE OF AND HOUSE " * 3000, "en")]
    docs = spark.createDataFrame([(i, t, g, "x") for i, t, g in rows], "doc_id long, text string, lang string, lang_pred string")
    got = op.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i in (900, 901, 902):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[905].lang_pred == "en" and by[904].lang_pred in WORDS
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 30 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in op.identify(docs).collect()] == ["und"]
    assert op.identify(docs.limit(0)).collect() == []


class Brute:
    """The definition: counts per context from the padded texts, probabilities by recursion."""

    def __init__(self, learnt):
        """``learnt``: (lang, text) pairs."""
        self.counts = {}
        used = {32}
        for lang, text in learnt:
            data = op.prepared(text)
            contexts = self.counts.setdefault(lang, {}) if data else None
            padded = b"   " + data
            for i in range(3, len(padded)):
                used.add(padded[i])
                for k in range(4):
                    followers = contexts.setdefault(padded[i - k : i], {})
                    followers[padded[i]] = followers.get(padded[i], 0) + 1
        self.langs = sorted(self.counts)
        self.symbols = sorted(used | {next(b for b in range(256) if b not in used)})
        self.known = {}

    def p(self, lang, context, s):
        key = (lang, context, s)
        if key not in self.known:
            self.known[key] = self._p(lang, context, s)
        return self.known[key]

    def _p(self, lang, context, s):
        followers = self.counts[lang].get(context, {})
        if not context:
            return (1 + followers.get(s, 0)) / (len(self.symbols) + sum(followers.values()))
        if not followers:
            return self.p(lang, context[1:], s)
        weight = sum(followers.values()) + len(followers)
        if s in followers:
            return followers[s] / weight
        rest = sum(self.p(lang, context[1:], x) for x in self.symbols if x not in followers)
        return len(followers) / weight * self.p(lang, context[1:], s) / rest

    def nats(self, text):
        padded = b"   " + op.prepared(text)
        return [-sum(math.log(self.p(lang, padded[i - 3 : i], padded[i])) for i in range(3, len(padded))) for lang in self.langs]

    def answer(self, text):
        if not op.prepared(text):
            return "und", 0.0
        nats = self.nats(text)
        best = min(nats)
        return self.langs[nats.index(best)], 1 / sum(math.exp(best - x) for x in nats)


def agrees(got, rows):
    """``got`` of ``identify`` against the definition; ``rows``: (id, text, lang)."""
    brute = Brute([(lang, t) for i, t, lang in rows if lang is not None and t is not None and i is not None and zlib.crc32(str(i).encode()) % 5])
    assert len(got) == len(rows)
    want = {i: brute.answer(t) for i, t, _ in rows}
    for r in got:
        lang, score = want[r.doc_id]
        assert abs(r.score - score) < 1e-6
        if score > 0.51 or not score:
            assert r.lang_pred == lang
    return brute


def mixed_rows(rnd):
    rows = [(i, sentence(rnd, lang, rnd.randint(1, 12)), lang) for i, lang in enumerate(rnd.choices(list(WORDS), k=60))]
    return rows + [(100, None, "en"), (101, "", "de"), (102, "zzz qqq", None), (103, "日本 the", "en"), (104, "12", "fr")]


def test_query_equals_the_definition_whatever_the_tasks_hold(spark):
    rows = mixed_rows(random.Random(4))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for cells in (op.TABLE_CELLS, 600, 0):
        agrees(op.identify(docs, cells=cells).collect(), rows)


def test_tasks_hold_a_part_of_the_tree(spark):
    rows = mixed_rows(random.Random(4))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, part, nothing = (op.learn(docs, cells=c).held for c in (op.TABLE_CELLS, 600, 0))
    assert whole.complete and not part.complete and not nothing.complete
    assert 0 < len(part.grams[3]) < len(whole.grams[3]) and not len(nothing.grams[2])


def test_registered_query_equals_the_definition(spark, tmp_path):
    from clinicflow.llm.queries import QUERIES

    rows = mixed_rows(random.Random(7))
    docs = spark.createDataFrame([(i, t, g, "s", 1) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    agrees(QUERIES["op4_language"](spark, str(tmp_path)).collect(), rows)


def test_many_languages(spark):
    rnd = random.Random(5)
    rows = []
    for k in range(100):
        letters = [chr(0x4E00 + 40 * k + i) for i in range(30)] + list("abc")
        rows += [(3 * k + i, "".join(rnd.choices(letters, k=12)), f"l{k:02}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    agrees(op.identify(docs).collect(), rows)
    agrees(op.identify(docs, cells=20_000).collect(), rows)


def test_two_hundred_thousand_grams(spark):
    """Far more grams than tasks hold: nothing is lost of any order."""
    rnd = random.Random(6)
    low, high = range(0x4E00, 0x9F00), range(0x3400, 0x4D00)
    rows = [(i, "".join(chr(rnd.choice(low if i % 2 else high)) for _ in range(2500)), "ab"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = op.learn(docs.filter("doc_id < 50"), cells=20_000)
    assert trees.three.selectExpr("sum(size(followers))").first()[0] > 200_000 > len(trees.held.grams[3])
    brute = Brute([(lang, t) for i, t, lang in rows if i < 50])
    some = [(1000 + i, t[:40], None) for i, t, _ in rows[45:]]
    got = op.predict(spark.createDataFrame(some, "doc_id long, text string, lang string"), trees).collect()
    for r in got:
        lang, score = brute.answer(dict((i, t) for i, t, _ in some)[r.doc_id])
        assert r.lang_pred == lang and abs(r.score - score) < 1e-6


def test_code_lengths_equal_the_definition(spark):
    rnd = random.Random(4)
    rows = [(i, sentence(rnd, lang, 40), lang) for i, lang in enumerate(("en", "de"))]
    trees = op.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    brute = Brute([(lang, t) for _, t, lang in rows])
    texts = ["the river über haus zzz", "", "eau"]
    ((first, got, rest),) = trees.held.score([op.prepared(t) for t in texts])
    assert first == 0 and not len(rest[0])
    for row, text in zip(got, texts):
        assert np.allclose(row, brute.nats(text), rtol=1e-9)
    # The probabilities after each context add up to one.
    for lang in brute.langs:
        for context in list(brute.counts[lang])[:200]:
            assert abs(sum(brute.p(lang, context, s) for s in brute.symbols) - 1) < 1e-9
