"""Near-duplicate documents by DartMinHash signatures.

A document is a weighted set: its shingles of five words, weighted by how often
they occur. The weight axis of a shingle is cut into unit regions, one for each
occurrence, and every region (a *cell*) has its own fixed stream of darts: ranks
that a unit-rate Poisson process drawn from the cell's hash puts down in rising
order, each dart aimed at one of K coordinates. A document throws the darts of
its cells up to a rank that makes about K ln K + 2K of them, and keeps the
earliest dart for each coordinate; if a coordinate stays empty the rank limit
doubles. Equal coordinates of two signatures have the weighted Jaccard
similarity (sum of the smaller over sum of the larger weights) as probability.
The work is a few darts for each cell, instead of K hashes.

Equal texts are put together first. Signatures are cut into bands; texts that
share a bucket (equal band) are compared with the most central text of the bucket,
so a large group of copies gives a star, never all its pairs; texts that don't get
into its class that way are compared further, where their seldom cells allow a link (see ``buckets``). A pair counts as a
link if the exact similarity of its cells reaches ``threshold``. Classes are the
connected components of the links. A link is missed where two texts share no band
(chance 0.0002 at 0.8 with 16 bands of 4).

Words are runs of anything but ASCII white space. Texts of one to four words
are one shingle; texts without a word are only ever equal to others. Null texts
are alone in their class (their own id). A null id takes the class of its
text's smallest id and stays out of it as a name; repeated rows get a row each.
Only the id and the text column are read. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.llm.buckets import bucket_links, outlines, with_leaders
from clinicflow.llm.common import ship, written

SHINGLE = 5
COORDINATES = 64
ROWS = 4
THRESHOLD = 0.8
SLICE_WORDS = 400_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a fixed bijection of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _salted(x: np.ndarray, salt: int) -> np.ndarray:
    return mix(x + np.uint64((salt * int(_GOLD)) & 0xFFFFFFFFFFFFFFFF))


def cells(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells (shingle and occurrence number) of documents: document number and hash of each.

    ``words``: hashes of all words, document after document; ``offsets``: where each document begins, and the end.
    """
    lengths = np.diff(offsets)
    doc = np.repeat(np.arange(len(lengths)), np.maximum(lengths - (SHINGLE - 1), (lengths > 0).astype(lengths.dtype)))
    counts = np.bincount(doc, minlength=len(lengths))
    first = np.repeat(offsets[:-1], counts) + (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts))
    shingle = np.zeros(len(doc), np.uint64)
    last = offsets[1:][doc] - 1 if len(doc) else first
    for k in range(SHINGLE):
        at = first + k
        inside = at <= last
        word = words[np.minimum(at, last)] if len(doc) else shingle
        shingle = mix(shingle * _GOLD + np.where(inside, word, np.uint64(k + 1)) + np.uint64(1))
    # Occurrence numbers: equal (document, shingle) stand together once sorted.
    key = shingle ^ mix(doc.astype(np.uint64) + np.uint64(77))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(fresh)
    occurrence = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.append(starts, len(ordered))))
    out = np.empty_like(shingle)
    out[order] = mix(shingle[order] + occurrence.astype(np.uint64) * _M2)
    return doc, out


def signatures(doc: np.ndarray, cell: np.ndarray, n_docs: int, k: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """DartMinHash of each document: an (n_docs, k) array of dart names, and which documents have cells."""
    weight = np.bincount(doc, minlength=n_docs)
    filled = weight > 0
    out = np.zeros((n_docs, k), np.uint64)
    limit = np.zeros(n_docs)
    limit[filled] = (k * math.log(k) + 2 * k) / weight[filled]
    todo = filled.copy()
    while todo.any():
        mine = todo[doc]
        d, c = doc[mine], cell[mine]
        rank = np.zeros(len(c))
        names, ranks, slots, number = [], [], [], 0
        while len(c):
            draw = _salted(c, 2 * number + 1)
            uniform = ((draw >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))
            rank = rank - np.log(uniform)
            hit = rank < limit[d]
            d, c, rank = d[hit], c[hit], rank[hit]
            name = _salted(c, 2 * number + 2)
            names.append(name)
            ranks.append(rank)
            slots.append(d * k + (name >> np.uint64(40)).astype(np.int64) % k)
            number += 1
        name, slot = np.concatenate(names), np.concatenate(slots)
        late_first = np.argsort(-np.concatenate(ranks), kind="stable")
        best = np.zeros(n_docs * k, np.uint64)
        got = np.zeros(n_docs * k, bool)
        best[slot[late_first]] = name[late_first]  # the earliest dart is written last
        got[slot] = True
        best, got = best.reshape(n_docs, k), got.reshape(n_docs, k).all(axis=1)
        done = todo & got
        out[done] = best[done]
        todo &= ~got
        limit[todo] *= 2
    return out, filled


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, k = signature.shape
    bands = k // rows
    key = np.zeros((n, bands), np.uint64) + np.arange(bands, dtype=np.uint64)
    parts = signature[:, : bands * rows].reshape(n, bands, rows)
    for r in range(rows):
        key = mix(key * _GOLD + parts[:, :, r])
    return key


def _slices(offsets: np.ndarray):
    """Runs of documents with about SLICE_WORDS words each."""
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_WORDS, side="right")) - 1
        stop = min(max(stop, start + 1), len(offsets) - 1)
        yield start, stop
        start = stop


def _word_lists(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    words = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return words[offsets[0] : offsets[-1]], offsets - offsets[0]


def _sketch(batches):
    for batch in batches:
        words, offsets = _word_lists(batch.column(2))
        for a, b in _slices(offsets):
            own = offsets[a : b + 1] - offsets[a]
            doc, cell = cells(words[offsets[a] : offsets[b]], own)
            signature, filled = signatures(doc, cell, b - a)
            keys = band_keys(signature).view(np.int64)
            bands = keys.shape[1]
            values = pa.array(keys[filled].ravel(), pa.int64())
            ends = np.concatenate([[0], np.cumsum(np.where(filled, bands, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), lists], names=["id", "tkey", "bands"]
            )


def _cell_sets(batches):
    """Sorted cell hashes (low 32 bits) of each text, for exact similarities."""
    for batch in batches:
        words, offsets = _word_lists(batch.column(1))
        out = []
        for a, b in _slices(offsets):
            doc, cell = cells(words[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            bounds = np.searchsorted(doc, np.arange(b - a + 1))
            low = (cell & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            out += [np.sort(low[bounds[i] : bounds[i + 1]]).tobytes() for i in range(b - a)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["node", "cells"])


def similarity(left: bytes, right: bytes) -> float:
    """Weighted Jaccard similarity of two sorted cell lists."""
    a, b = np.frombuffer(left, np.uint32), np.frombuffer(right, np.uint32)
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / max(len(a) + len(b) - shared, 1)


def _word_hashes(text):
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda x: x != "")
    return F.transform(words, lambda x: F.xxhash64(x))


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: its id, ``class_id`` (smallest id of the class) and ``text_key`` (null for null)."""
    ship(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_col]
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    keyed = source.withColumn("tkey", F.unhex(F.md5(F.col("text").cast("binary"))))
    hashed = keyed.select("id", "tkey", F.coalesce(_word_hashes(F.col("text")), F.array().cast("array<bigint>")).alias("w"))
    sketched = written(hashed.mapInArrow(_sketch, f"id {id_type}, tkey binary, bands array<bigint>"), "sketches")

    texts = written(
        sketched.filter("tkey is not null")
        .groupBy("tkey")
        .agg(F.min("id").alias("rep"), F.any_value("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "texts",
    )
    component = _components(keyed, texts, threshold)
    classed = texts.select("tkey", "rep", "node").join(component, "node", "left")
    classed = classed.withColumn("component", F.coalesce("component", "node"))
    names = classed.groupBy("component").agg(F.min("rep").alias("class_id"))
    named = classed.join(names, "component").select("tkey", "class_id")
    return sketched.join(named, "tkey", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("tkey").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.col("tkey").alias("text_key"),
    )


def _components(keyed: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(``node``, ``component``) of the texts that are linked to others."""
    members = texts.select("node", F.explode("bands").alias("bucket")).distinct()
    members = written(with_leaders(members), "buckets")
    if members.isEmpty():
        return members.select("node", F.col("leader").alias("component"))
    sets = _candidate_sets(keyed, texts, members)
    limit = 1.0 - threshold
    return bucket_links(members, lambda pairs: _judged(pairs, sets), limit, lambda crowded: outlines(crowded, _other_cells(crowded, sets), limit))[1]


def _candidate_sets(keyed: DataFrame, texts: DataFrame, rest: DataFrame) -> DataFrame:
    """(node, cells) of the texts that share a bucket with another one."""
    wanted = texts.select("node", "tkey", "rep").join(rest.select("node").distinct(), "node", "left_semi")
    found = (
        keyed.withColumnRenamed("tkey", "k")
        .join(wanted.select("node", F.col("tkey").alias("k"), F.col("rep").alias("r")), "k")
        .filter(F.col("id").eqNullSafe(F.col("r")))
        .select("node", _word_hashes(F.col("text")).alias("w"))
    )
    return written(found.mapInArrow(_cell_sets, "node long, cells binary").dropDuplicates(["node"]), "cells")


def _other_cells(crowded: DataFrame, sets: DataFrame) -> DataFrame:
    """The cells of the members that ``outlines`` asks for: leaders' whole sets, and what others have outside of their nearest leader's."""
    leaders = crowded.select(F.col("leader").alias("node")).distinct()
    nearest = crowded.filter("node <> leader").groupBy("node").agg(F.min_by("leader", F.struct(F.coalesce("dl", F.lit(2.0)), "leader")).alias("leader"))
    nearest = nearest.join(leaders, "node", "left_anti").unionByName(leaders.withColumn("leader", F.lit(None).cast("long")))
    theirs = sets.join(leaders, "node", "left_semi").select(F.col("node").alias("leader"), F.col("cells").alias("b"))
    both = nearest.join(sets, "node").join(theirs, "leader", "left").select("node", "cells", "b")

    def others(batches):
        for batch in batches:
            sizes, spare, leads, found = [], [], [], []
            for a, b in zip(batch.column(1), batch.column(2)):
                mine = np.frombuffer(a.as_buffer(), np.uint32)
                kinds = np.unique(mine)
                sizes.append(len(mine))
                spare.append(len(mine) - len(kinds))
                leads.append(not b.is_valid)
                rest = kinds if leads[-1] else np.setdiff1d(kinds, np.frombuffer(b.as_buffer(), np.uint32))
                found.append(rest.view(np.int32))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *found]), pa.int32()))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spare, pa.int64()), pa.array(leads, pa.bool_()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "spare", "leads", "others"])

    return written(both.mapInArrow(others, "node long, size long, spare long, leads boolean, others array<int>"), "other-cells")


def _judged(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``u``, ``v``) with their exact Jaccard distance ``d``."""
    with_u = pairs.join(sets.select(F.col("node").alias("u"), F.col("cells").alias("a")), "u")
    both = with_u.join(sets.select(F.col("node").alias("v"), F.col("cells").alias("b")), "v")

    def measure(batches):
        for batch in batches:
            d = [1.0 - similarity(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d, pa.float64())], names=["u", "v", "d"])

    return both.select("u", "v", "a", "b").mapInArrow(measure, "u long, v long, d double")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id. Rows without an id or a text stay."""
    classes = written(near_duplicate_classes(docs, id_col, text_col), "classes")
    others = classes.filter("class_id is not null and class_id <> " + f"`{id_col}`").select(
        F.col(id_col).alias("_id"), F.col("text_key").alias("_key")
    )
    key = F.unhex(F.md5(F.col(f"`{text_col}`").cast("binary")))
    first = docs.withColumn("_key", key).withColumn("_id", F.col(f"`{id_col}`"))
    left = first.join(others.distinct(), ["_id", "_key"], "left_anti")
    # Rows that repeat id and text are one document; those without either are kept apart.
    alone = left.filter("_id is null or _key is null")
    once = left.filter("_id is not null and _key is not null").dropDuplicates(["_id", "_key"])
    return once.unionByName(alone).select(*[F.col(f"`{c}`") for c in docs.columns])
