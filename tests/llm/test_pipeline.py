"""Every stage of the pipeline on its own input, against brute force."""

import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from clinicflow.llm import quality_classifier, quality_rules
from clinicflow.llm.common import table, written
from tests.llm import test_dart_minhash, test_packing
from tests.llm import test_quality_rules as rules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    """Input and output rows of each stage."""
    docs = table(spark, SF, "documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, after, docs.collect(), after.collect())
        docs = after
    return out


def test_columns_stay(results):
    first = next(iter(results.values()))[0].dtypes
    for _, after, *_ in list(results.values())[:-1]:
        assert after.dtypes == first


def test_quality_rules(results):
    _, _, before, after = results["quality_rules"]
    boiler = re.compile(quality_rules.BOILERPLATE)
    want = {}
    for r in before:
        words, chars, _, _, repeated = rules.brute(r.text)
        kept = []
        for line in (r.text or "").split("\n"):
            n = len(rules.WORD.findall(line))
            bad = 100 * len(re.findall(quality_rules.LINE_MARK, line)) > 30 * n or len(re.findall(quality_rules.SEPARATOR, line)) >= 3
            if not n or not (bad or (boiler.search(line) and n <= 30)):
                kept.append(line)
        left = sum(map(len, rules.WORD.findall("\n".join(kept))))
        if words >= 20 and 100 * repeated <= 30 * words and 100 * (chars - left) <= 30 * chars:
            want[r.doc_id] = "\n".join(kept)
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_quality_classifier(spark, results):
    before, _, _, after = results["quality_classifier"]
    model = quality_classifier.fit(
        quality_classifier.statistics(table(spark, SF, "documents"), keep=["doc_id"]), table(spark, SF, "labels")
    )
    rows = quality_classifier.statistics(before).collect()
    import numpy as np

    scores = model.score(np.array([r.x for r in rows]))
    assert sorted(r.doc_id for r in after) == sorted(r.row.doc_id for r, s in zip(rows, scores) if s >= 0.7)


def near(a, b):
    """Whether two lines are at most two edits apart, by searching the edits."""
    if a == b:
        return True
    reach = {(0, 0)}
    for _ in range(3):
        ends = set()
        for i, j in reach:
            while i < len(a) and j < len(b) and a[i] == b[j]:
                i, j = i + 1, j + 1
            ends.add((i, j))
        if (len(a), len(b)) in ends:
            return True
        reach = {(i + x, j + y) for i, j in ends for x, y in ((1, 1), (1, 0), (0, 1)) if i + x <= len(a) and j + y <= len(b)}
    return False


def test_line_dedup(results):
    _, _, before, after = results["line_dedup"]
    places = [(r.doc_id, k, line) for r in before for k, line in enumerate(r.text.split("\n")) if line.strip(" \t\n\x0b\f\r")]
    parent = {line: line for *_, line in places}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_length = defaultdict(list)
    for line in parent:
        by_length[len(line)].append(line)
    for n, lines in by_length.items():
        if n >= 24:
            for a in lines:
                for b in lines + by_length.get(n + 1, []) + by_length.get(n + 2, []):
                    if a != b and near(a, b):
                        parent[find(a)] = find(b)
    first = {}
    for place in places:
        root = find(place[2])
        first[root] = min(first.get(root, place[:2]), place[:2])
    want = {}
    for r in before:
        lines = [x for k, x in enumerate(r.text.split("\n")) if not x.strip(" \t\n\x0b\f\r") or first[find(x)] == (r.doc_id, k)]
        if any(x.strip(" \t\n\x0b\f\r") for x in lines):
            want[r.doc_id] = "\n".join(lines)
    assert {r.doc_id: r.text for r in after} == want
    assert Counter(r.doc_id for r in after).most_common(1)[0][1] == 1


def test_near_dedup(results):
    _, _, before, after = results["minhash_near_dedup"]
    classes = test_dart_minhash.brute_classes([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({c for _, c in classes})


def test_packing_and_run(spark, results):
    _, _, before, after = results["best_fit_packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n = test_packing.check(after, [(r.doc_id, r.text) for r in before], library, 2048)
    assert n <= 1.05 * -(-sum(r.length for r in after) // 2048) + 1
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in after)
