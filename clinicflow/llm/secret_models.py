"""Secrets by two character Markov models: of random strings and of ordinary identifiers.

Base detectors find ``assign``, ``access`` and ``hex`` spans. What they match is the
labelled sample of random strings. Runs of at least ``SHORTEST`` letters, digits and
joints (``_-/+=``) outside of base spans, with a letter, are candidates; they have no
label. All that is outside of both is the sample of ordinary identifiers. Identifiers are
words with joints or with an upper-case letter after a lower-case one; both models start
anew there, and joints have no weight. Within a word a model gives a letter or digit its
chance after the two before it, smoothed by the chance after one and after none; half of
the random model's chances without context are uniform, so that secrets over other symbols
than those of the base detectors count as random too. A candidate is a ``random`` span if
its log-likelihood ratio exceeds the log odds of candidates to base spans, times
``MARGIN``. Ratios are rounded to thousandths per symbol, so their sums don't depend on an
order.

Documents are read twice. Counting adds up symbol triples per task before the
shuffle; the driver gets at most a row per triple of the 62 symbols and class, and the
models go to the tasks as a table of 1 MB.

Null and empty texts have no spans. Texts are scanned whole, whatever their length.
Repeated ids and rows are scored each by itself. Without any base span the random
model is uniform; an empty table gives no rows. Only the id and text column are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.llm.common import ship

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
KINDS = ("assign", "access", "hex", "random")
SHORTEST = 16
SMOOTHING = 64
MARGIN = 100
UNIT = 1000

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # greedy: a run of 18 or more, as a shorter one holds no longer one
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)

SIZE = len(SYMBOLS) + 1
ORDINARY, RANDOM = 0, 1

_NUMBER = np.zeros(256, np.uint8)
_NUMBER[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(1, SIZE)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of the base detectors, ordered by start, then kind."""
    found = [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(found)


def outside(text: str, spans) -> str:
    """The text with blanks for the spans, given as (start, end) in order."""
    if not spans:
        return text
    out, at = [], 0
    for start, end in spans:
        if end > at:
            out += [text[at:start], " " * (end - max(start, at))]
            at = end
    return "".join(out) + text[at:]


def candidates(rest: str) -> list[tuple[int, int]]:
    return [m.span() for m in RUN.finditer(rest) if any(c.isalpha() for c in m.group())]


def triples(text: str) -> np.ndarray:
    """The number of each symbol with the two before it in its word (0: before the word), as one number each."""
    n = _NUMBER[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)].astype(np.int32)
    before = np.r_[np.int32(0), n[:-1]]
    starts = (n > 0) & (n <= 26) & (before > 26) & (before <= 52)  # an upper-case letter after a lower-case one
    b = np.where(starts, 0, before)
    a = np.where(b == 0, 0, np.r_[np.int32(0), b[:-1]])
    return ((a * SIZE + b) * SIZE + n)[n > 0]


class Models:
    """Weights of the triples, and the least weight of a secret."""

    def __init__(self, counts: np.ndarray, n_ordinary: int, n_random: int):
        ordinary, random = (_chances(c.reshape(SIZE, SIZE, SIZE), uniform=k == RANDOM) for k, c in enumerate(counts))
        ratio = np.log(random) - np.log(ordinary)
        self.weights = np.floor(UNIT * ratio + 0.5).astype(np.int32).ravel()
        self.least = UNIT * math.log(MARGIN * (n_ordinary + 1) / (n_random + 1))

    def score(self, run: str) -> int:
        return int(self.weights[triples(run)].sum(dtype=np.int64))

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """``(start, kind, end)`` of all spans of a text, ordered by start, then kind."""
        base = base_spans(text)
        rest = outside(text, [(a, b) for a, _, b, _ in base])
        found = [(a, 3, b) for a, b in candidates(rest) if self.score(rest[a:b]) > self.least]
        return sorted([s[:3] for s in base] + found)


def _chances(n: np.ndarray, uniform: bool) -> np.ndarray:
    """P(c | a, b); by counts, smoothed with P(c | b), that with P(c), and that with the uniform distribution."""
    symbols = SIZE - 1
    n = n.astype(np.float64)
    total = n.sum()
    mass = symbols + (total if uniform else 0)
    none = (n.sum(axis=(0, 1)) + mass / symbols) / (total + mass)
    pair = n.sum(axis=0)
    one = (pair + SMOOTHING * none) / (pair[:, 1:].sum(axis=1, keepdims=True) + SMOOTHING)
    return (n + SMOOTHING * one[None]) / (n[:, :, 1:].sum(axis=2, keepdims=True) + SMOOTHING)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ---- Spark


def learn(docs: DataFrame, text_col: str = "text") -> Models:
    """The models of a table of documents: triples counted over all of them."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(f"`{text_col}`").alias("text")).filter(F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, runs = np.zeros((2, SIZE**3), np.int64), [0, 0]
        for batch in batches:
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                rest = outside(text, [(a, b) for a, _, b, _ in base])
                unknown = candidates(rest)
                runs[RANDOM] += len(base)
                runs[ORDINARY] += len(unknown)
                for k, t in ((ORDINARY, outside(rest, unknown)), (RANDOM, " ".join(value for *_, value in base))):
                    if t:
                        seen = triples(t)
                        if len(seen) < SIZE**2:
                            np.add.at(counts[k], seen, 1)
                        else:
                            counts[k] += np.bincount(seen, minlength=SIZE**3)
        kind, triple = np.nonzero(counts)
        n = counts[kind, triple]
        rows = [np.r_[kind, ORDINARY, RANDOM], np.r_[triple, -1, -1], np.r_[n, runs]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(rows, ("i4", "i4", "i8"))], names=["kind", "triple", "n"])

    counted = texts.mapInArrow(count, "kind int, triple int, n long").groupBy("kind", "triple").agg(F.sum("n").alias("n")).toPandas()
    counts, runs = np.zeros((2, SIZE**3), np.int64), {ORDINARY: 0, RANDOM: 0}
    for k, t, n in zip(counted["kind"], counted["triple"], counted["n"]):
        if t < 0:
            runs[k] = int(n)
        else:
            counts[k, t] = n
    return Models(counts, runs[ORDINARY], runs[RANDOM])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", models: Models | None = None) -> DataFrame:
    """Per document its id as ``doc_id``, and ``spans``: an array of ``kind``, ``start``, ``end`` (code points) in order."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(models or learn(docs, text_col))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in model.spans(text)] if text else [] for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=["doc_id", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")


def digest(found: DataFrame) -> DataFrame:
    """``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` (joined) of each document's spans."""
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans")
    )
