import hashlib
import random
from array import array

import public_tokenizers
import pytest
import sentencepiece

from clinicflow.llm import sentencepiece_bpe as op

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def bpe():
    return op.load(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_random_texts_equal_the_library(bpe, library):
    rnd = random.Random(7)
    bits = [" ", "  ", "▁", "a", "b", "é", "\n", "\t", "the", "ing", "\U0001f9ff", "梦", "<s>", "<0x0A>", "\x00", "\r\n", "!!", " " * 20]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert bpe.encode(text) == ids
        assert bpe.decode(ids) == library.decode(ids)


def test_random_ids_decode_as_the_library(bpe, library):
    rnd = random.Random(8)
    for _ in range(2000):
        ids = [rnd.randrange(32000) if rnd.random() < 0.5 else rnd.randrange(3, 259) for _ in range(rnd.randint(0, 8))]
        assert bpe.decode(ids) == library.decode(ids)


def test_long_word_without_spaces(bpe, library):
    text = "".join(random.Random(9).choice("abcdefghiéß") for _ in range(50_000))
    assert bpe.encode(text) == library.encode(text, add_bos=True, add_eos=True)


def test_documents_nulls_empty_repeated_and_clashing_columns(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a b", "y"), (3, "a b", "y"), (None, "c\n d", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.decoded): r for r in op.encode_documents(docs, MODEL).collect()}
    assert len(op.encode_documents(docs, MODEL).collect()) == 5
    assert got[(1, "")].ids == [1, 2] and got[(2, "")].n_tokens == 2
    for doc_id, text, _ in rows[2:]:
        ids = library.encode(text, add_bos=True, add_eos=True)
        row = got[(doc_id, text)]
        assert row.ids == ids
        assert row.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.encode_documents(docs, MODEL).collect() == []


def test_query_over_the_whole_table(spark, library):
    from clinicflow.llm.queries import QUERIES

    rows = QUERIES["op1_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
