"""Vector codes from one codebook per part, learnt in whole numbers with norm-of-sum bounds.

Vectors are cut into equal consecutive parts. In each round every part goes to
the nearest entry of its codebook, then an entry becomes the floored mean of its
parts. A part keeps, for each group of entries, a lower bound of its distance to
the group's entries (but its own one) and the stamp of the round that measured
it. All codebooks so far are kept. In a later round a group's bound falls by no
more than the greatest net displacement of its entries, the distance between
where an entry is and where it was in the stamped round: the norm of the sum of
its moves, at most the sum of their norms. Only groups whose bound doesn't
stay above the exact distance to the part's own entry are scanned again, exactly;
their bounds get a new stamp. Bounds are rounded down and displacements up, so
the codes equal those of full scans.

Rows with their codes, bounds and stamps are written once per round and the
table of the round before is removed; sums of parts are added up per task before
they are shuffled (a row per task, part and used entry). The driver holds the
codebooks alone.

Takes part: vectors not null, without null or non-finite components or such of
``LIMIT`` or more in size (their sums would not fit in 64 bits), as long as most
are (ties: the longer) and cut into whole parts by ``parts``. Null ids come last
in the order in which vectors become first entries; rows that repeat an id are
vectors of their own, ordered by their components. With fewer vectors than
entries there is an entry for each vector. An empty table gives no rows. Only
the id, vector and label columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.llm.common import discard, ship, written, written_at

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
GROUPS = 16
LIMIT = 1 << 25
SLICE = 4096
HOT_SHARE = 1000
ROUNDING = 1e-9


# ---- assignment of one part


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries; in doubles where these hold the numbers exactly."""
    bound = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0), 1)
    if 4 * x.shape[1] * int(bound) ** 2 < 1 << 52:
        x, c = x.astype(np.float64), c.astype(np.float64)
    out = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
    return out.astype(np.int64)


def groups_of(codebook: np.ndarray, groups: int = GROUPS) -> list[np.ndarray]:
    """Entries that lie near each other, ascending numbers in each group; the groups change no result."""
    c = codebook.astype(np.float64)
    centre = c[np.linspace(0, len(c) - 1, min(groups, len(c))).astype(int)]
    for _ in range(5):
        to = ((c[:, None, :] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
        centre = np.array([c[to == g].mean(axis=0) if (to == g).any() else centre[g] for g in range(len(centre))])
    return [np.flatnonzero(to == g) for g in range(len(centre)) if (to == g).any()]


def displacements(history: np.ndarray, groups: list[np.ndarray]) -> np.ndarray:
    """For each earlier round and group the greatest net displacement of an entry since, rounded up."""
    net = np.sqrt(((history[-1] - history).astype(np.float64) ** 2).sum(axis=2))  # round, entry
    return np.stack([net[:, g].max(axis=1) for g in groups], axis=1) * (1 + ROUNDING)


def first_scan(x: np.ndarray, codebook: np.ndarray, groups: list[np.ndarray]):
    """Codes, squared distances, bounds and stamps of the first round, by full scans."""
    d = squared(x, codebook)
    code = d.argmin(axis=1)
    rows = np.arange(len(x))
    best = d[rows, code]
    d[rows, code] = np.iinfo(np.int64).max
    low = np.stack([np.sqrt(d[:, g].min(axis=1).astype(np.float64)) for g in groups], axis=1)
    return code, best, _down(low), np.zeros((len(x), len(groups)), np.uint8)


def _down(low: np.ndarray) -> np.ndarray:
    return np.nextafter((low * (1 - ROUNDING)).astype(np.float32), np.float32(-np.inf))


def next_scan(x, code, low, stamp, history: np.ndarray, groups: list[np.ndarray]):
    """Codes, squared distances, bounds and stamps under the last codebook of ``history``; also how many distances were measured."""
    codebook, now = history[-1], len(history) - 1
    own = ((x - codebook[code]) ** 2).sum(axis=1)
    reach = np.sqrt(own.astype(np.float64)) * (1 + ROUNDING) + ROUNDING
    bound = low.astype(np.float64) - displacements(history, groups)[stamp, np.arange(len(groups))]
    open_ = bound <= reach[:, None]
    best, new = own.copy(), code.copy()
    scanned, measured = [], len(x)
    for g, members in enumerate(groups):
        rows = np.flatnonzero(open_[:, g])
        if not len(rows):
            continue
        d = squared(x[rows], codebook[members])
        measured += d.size
        at = d.argmin(axis=1)
        least = d[np.arange(len(rows)), at]
        d[np.arange(len(rows)), at] = np.iinfo(np.int64).max
        scanned.append((g, rows, members[at], least, d.min(axis=1)))
        closer = (least < best[rows]) | ((least == best[rows]) & (members[at] < new[rows]))
        best[rows[closer]], new[rows[closer]] = least[closer], members[at][closer]
    low, stamp = low.copy(), stamp.copy()
    for g, rows, nearest, least, second in scanned:
        rest = np.where(new[rows] == nearest, second, least)
        low[rows, g], stamp[rows, g] = _down(np.sqrt(rest.astype(np.float64))), now
    # An entry given up, in a group that wasn't scanned, counts in that group's bound from now on.
    group = np.empty(len(codebook), np.int64)
    for g, members in enumerate(groups):
        group[members] = g
    left = np.flatnonzero(new != code)
    left = left[~open_[left, group[code[left]]]]
    low[left, group[code[left]]] = _down(np.minimum(bound[left, group[code[left]]], np.sqrt(own[left].astype(np.float64))))
    stamp[left, group[code[left]]] = now
    return new, best, low, stamp, measured


def floor_means(sums: np.ndarray, counts: np.ndarray, before: np.ndarray) -> np.ndarray:
    return np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], before)


def codebooks_sha(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in codebooks.ravel()).encode()).hexdigest()


# ---- Spark


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), SLICE):
            yield batch.slice(start, SLICE)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int, scale: int) -> tuple[DataFrame, int]:
    """``vec_id``, ``label``, ``v`` (floor(scale * x) of each component) of the vectors that take part, and their length."""
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("x")
    )
    rows = rows.filter(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT / scale)) & (F.size("x") > 0))
    lengths = rows.filter(F.size("x") % parts == 0).groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    most = lengths.first()
    length = most["n"] if most else 0
    return rows.filter(F.size("x") == length).select("vec_id", "label", F.transform("x", lambda x: F.floor(x * scale)).alias("v")), length


def encode(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """Per vector: ``vec_id``, ``code`` (two hex digits a part), ``error``, ``label_error``, ``codebooks_sha256``."""
    spark = vectors.sparkSession
    ship(spark)
    rows, length = whole_vectors(vectors, id_col, vector_col, label_col, parts, scale)
    # The ids first, so that only the vectors up to the last one of them are sent to the driver.
    ids = rows.select("vec_id").orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()
    low = rows.filter(F.col("vec_id") <= F.lit(ids[-1][0])) if len(ids) == entries and ids[-1][0] is not None else rows
    first = low.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    id_kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    if not first:
        return spark.createDataFrame([], f"vec_id {id_kind}, code string, error long, label_error long, codebooks_sha256 string")
    codebooks = np.array([r.v for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)  # part, entry, component
    history = [codebooks]
    groups = [groups_of(codebooks[p]) for p in range(parts)]
    state, place = None, None
    for _ in range(rounds):
        state, place = _next_state(rows, state, place, history, groups, id_kind, label_kind)
        sums, counts = np.zeros_like(codebooks), np.zeros(codebooks.shape[:2], np.int64)
        added = _part_sums(state, codebooks.shape)
        for r in added.groupBy("part", "entry").agg(F.sum("n"), *[F.sum(F.col("s")[i]) for i in range(sums.shape[2])]).collect():
            counts[r[0], r[1]], sums[r[0], r[1]] = r[2], r[3:]
        history.append(floor_means(sums, counts, history[-1]))
    state, _ = _next_state(rows, state, place, history, groups, id_kind, label_kind)
    coded = state.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error")
    return _with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha(history[-1])).alias("codebooks_sha256")
    )


def _next_state(rows: DataFrame, state: DataFrame | None, before: str | None, history: list[np.ndarray], groups, id_kind: str, label_kind: str):
    """The rows with the codes, bounds and stamps of this round, written; the table of the round before goes."""
    books = np.stack(history)  # round, part, entry, component
    parts = books.shape[1]
    fresh = state is None
    edges = np.cumsum([0] + [len(g) for g in groups])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            if fresh:
                v = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            else:
                v = _matrix(batch.column(2), "<i4").astype(np.int64)
                old, low, stamp = (_matrix(batch.column(i), kind) for i, kind in ((3, "u1"), (4, "<f4"), (5, "u1")))
            code = np.empty((len(v), parts), np.uint8)
            new_low, new_stamp = np.empty((len(v), edges[-1]), "<f4"), np.empty((len(v), edges[-1]), np.uint8)
            error = np.zeros(len(v), np.int64)
            for p, x in enumerate(np.split(v, parts, axis=1)):
                at = slice(edges[p], edges[p + 1])
                if fresh:
                    found = first_scan(x, books[0, p], groups[p])
                else:
                    found = next_scan(x, old[:, p].astype(np.int64), low[:, at], stamp[:, at], books[:, p], groups[p])[:4]
                code[:, p], new_low[:, at], new_stamp[:, at] = found[0], found[2], found[3]
                error += found[1]
            columns = [batch.column(0), batch.column(1), _binary(v.astype("<i4")), _binary(code), _binary(new_low), _binary(new_stamp)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(error)], names=["vec_id", "label", "v", "code", "low", "stamp", "error"])

    source = rows if fresh else state.drop("error")
    schema = f"vec_id {id_kind}, label {label_kind}, v binary, code binary, low binary, stamp binary, error long"
    new, path = written_at(source.mapInArrow(scan, schema), "codes")
    if before is not None:
        discard(rows.sparkSession, before)
    return new, path


def _part_sums(state: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Per task and used entry: ``part``, ``entry``, ``n`` and the componentwise sums ``s`` of its parts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = shape
        sums, counts = np.zeros(shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in _slices(batches):
            v, code = _matrix(batch.column(0), "<i4").reshape(-1, parts, width), _matrix(batch.column(1), "u1")
            for p in range(parts):
                np.add.at(sums[p], code[:, p], v[:, p])
                counts[p] += np.bincount(code[:, p], minlength=entries)
        part, entry = np.nonzero(counts)
        if len(part):
            columns = [part.astype(np.int32), entry.astype(np.int32), counts[part, entry]]
            s = pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), s], names=["part", "entry", "n", "s"])

    return state.select("v", "code").mapInArrow(add, "part int, entry int, n long, s array<long>")


def _with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of equal labels summed, nulls together.

    Sums are combined per task. Labels of more than a HOT_SHARE-th of the rows, fewer than
    HOT_SHARE of them, are broadcast, so no task gathers the rows of one; the others are joined by label.
    """
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    total = sums.agg(F.sum("n")).scalar()
    hot = F.broadcast(sums.filter(F.col("n") * HOT_SHARE > total).select(F.col("label").alias("of"), "label_error"))
    joined = coded.join(hot, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    rest = sums.filter(F.col("n") * HOT_SHARE <= total).select(F.col("label").alias("of"), F.col("label_error").alias("rest"))
    cold = joined.filter(F.col("label_error").isNull()).drop("label_error")
    cold = cold.join(rest, F.col("label").eqNullSafe(F.col("of"))).drop("of").withColumnRenamed("rest", "label_error")
    return joined.filter(F.col("label_error").isNotNull()).unionByName(cold)
