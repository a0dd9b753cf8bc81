import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from clinicflow.llm import packing as op

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_equal_the_library(library):
    rnd = random.Random(3)
    bits = [" ", "  ", "\n", "\t", " ", "́", "e", "É", "THE", "don't", "x'S", "it's,", "('ll", "ÜBER", "straße.", "ÀÉ", "\xa0", "\xad", "İ", "\u0301", "ǅ", "12", "!!", "日本", "\U0001f9ff", "<|endoftext|>", "\x1c", "\x85", "ﬁ", "Σ", "σς"]
    own = op.load(PATH)
    for _ in range(2000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 20)))
        assert array("I", own.ids(text)).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def check(rows, texts, library, capacity):
    """Pieces are those of the documents; sequences are gapless and hold at most the capacity."""
    cut = defaultdict(list)
    for doc_id, text in texts:
        ids = library_ids(library, text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            cut[doc_id].append((k, at, len(part), zlib.crc32(array("I", part).tobytes())))
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in cut.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents_with_nulls_repeats_and_long_texts(spark, library):
    rnd = random.Random(1)
    texts = [(i, " ".join(rnd.choice(["river", "house", "a", "unlikely"]) for _ in range(rnd.randint(0, 90)))) for i in range(300)]
    texts += [(900, None), (901, ""), (902, "word " * 1000), (None, "no id"), texts[0], texts[0]]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, length string")
    rows = op.pack(op.pieces(docs, PATH, capacity=128), capacity=128).collect()
    n = check(rows, texts, library, 128)
    total = sum(r.length for r in rows)
    assert n <= 1.03 * -(-total // 128)
    assert op.pack(op.pieces(docs.limit(0), PATH)).collect() == []


def test_evolution_is_no_worse_than_best_fit_and_stays_valid():
    rnd = np.random.default_rng(5)
    sizes = np.sort(rnd.integers(300, 1500, 400))[::-1].copy()
    start = op.first_population(sizes, 2048, rnd)
    for f, p in op.evolve(start, sizes, 2048, rnd):
        assert np.bincount(p, weights=sizes).max() <= 2048 and len(p) == 400
    best = op.evolve(start, sizes, 2048, rnd, generations=20)[0][1]
    assert len(np.unique(best)) <= len(np.unique(start[0]))


def test_query_over_the_whole_table(spark, library):
    from clinicflow.llm.queries import QUERIES

    rows = QUERIES["op6_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(rows, texts, library, 2048)


def triplets(rnd, n):
    """Pieces that fill ``n`` sequences exactly, three in each: hard for best fit."""
    first = rnd.integers(op.CAPACITY * 3 // 10, op.CAPACITY // 2, n)
    second = rnd.integers(op.CAPACITY // 4, np.maximum((op.CAPACITY - first) // 2, op.CAPACITY // 4 + 1))
    return np.sort(np.concatenate([first, second, op.CAPACITY - first - second]))[::-1]


def test_evolution_needs_fewer_than_best_fit():
    for seed in range(3):
        sizes = triplets(np.random.default_rng(seed), 200)
        plain = op.best_fit(sizes.tolist(), range(len(sizes)), op.CAPACITY)
        best = op.evolve(op.first_population(sizes, op.CAPACITY, np.random.default_rng(1)), sizes, op.CAPACITY, np.random.default_rng(2))[0][1]
        assert np.bincount(best, weights=sizes).max() <= op.CAPACITY
        assert len(np.unique(best)) <= 206 < 220 < len(np.unique(plain))


def test_mutation_and_exchange_keep_every_piece():
    rnd = np.random.default_rng(5)
    for _ in range(50):
        sizes = rnd.integers(1, op.CAPACITY, int(rnd.integers(1, 60)))
        bins = op.best_fit(sizes.tolist(), range(len(sizes)), op.CAPACITY)
        child = op.mutate(bins, sizes, sizes.tolist(), op.CAPACITY, rnd)
        assert len(child) == len(sizes) and child.min() >= 0
        assert np.bincount(child, weights=sizes).max() <= op.CAPACITY


def packed_sequences(spark, sizes):
    cut = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = op.pack(cut).select("sequence_id", "offset", "length").collect()
    assert sorted(r.length for r in rows) == sorted(sizes.tolist())
    ends = defaultdict(list)
    for r in rows:
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    for places in ends.values():
        places.sort()
        assert [a for a, _ in places] == [0] + [b for _, b in places[:-1]] and places[-1][1] <= op.CAPACITY
    return len(ends)


def test_regions_lose_nothing_against_one_best_fit(spark):
    rnd = np.random.default_rng(9)
    sizes = np.minimum(rnd.geometric(1 / 500, 9000) + 1, op.CAPACITY - 1)
    plain = op.best_fit(np.sort(sizes)[::-1].tolist(), range(len(sizes)), op.CAPACITY)
    assert packed_sequences(spark, sizes) <= len(np.unique(plain))


def test_spark_packs_better_than_best_fit(spark):
    sizes = triplets(np.random.default_rng(3), 300)
    plain = op.best_fit(sizes.tolist(), range(len(sizes)), op.CAPACITY)
    assert packed_sequences(spark, sizes) < len(np.unique(plain)) - 20


def test_other_tokenizers_go_through_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, other = op.CachedTokenizer(path), Tokenizer.from_file(path)
    assert not own.cuts and op.load(PATH).cuts
    for text in ("", "A b  c\n\nd", " it's\t(x) ", "über 日本"):
        assert array("I", own.ids(text)).tolist() == other.encode(text, add_special_tokens=False).ids


def test_every_plain_character_and_word_shape(library):
    own = op.load(PATH)
    plain = sorted(op._PLAIN)
    rnd = random.Random(8)
    texts = plain + [" ".join("".join(rnd.choices(plain, k=rnd.randint(1, 9))) for _ in range(6)) for _ in range(1500)]
    texts += ["a\r\n\tb", "x <|ENDOFTEXT|> y", "<|startoftext|>don't", "ab" * 3000]
    for text in texts:
        assert array("I", own.ids(text)).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_full_caches_are_emptied(monkeypatch, library):
    monkeypatch.setattr(op, "CACHE_WORDS", 3)
    own = op.CachedTokenizer(PATH)
    text = " ".join(f"Wort{chr(97 + i % 26)}, don't ({i})" for i in range(60)) + " " + "x" * 5000
    assert array("I", own.ids(text)).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.cache) <= 3 and len(own.words) <= 3


class Captured:
    """Stands for a table: ``mapInArrow`` gives the function."""

    dtypes = [("doc_id", "bigint")]

    def __init__(self, spark):
        self.sparkSession = spark

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_pipeline_tasks_leave_no_remembered_words(spark, monkeypatch):
    import corpus_pipeline

    own = op.load(PATH)
    monkeypatch.setattr(op, "pack", lambda run: run)
    run = corpus_pipeline.pack_sequences(spark, Captured(spark), "")
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["Some words, some more", None])], names=["doc_id", "text"])
    first = [x.to_pydict() for x in run(iter([batch]))]
    assert first[0]["doc_id"] == [1, 2] and not own.cache and not own.words
    kept = op.pieces(Captured(spark), PATH)
    assert [x.to_pydict() for x in kept(iter([batch]))] == first and own.cache and own.words
    assert len([x for x in run(iter([batch]))]) == 1 and not own.cache
