"""Centroid clustering of whole-number vectors, assigned through a vector approximation file.

Every vector is stored once with its approximation: for each component the
number of the cell (``BITS`` bits) that holds it. The cells of a component are
bounded by quantiles of a sample and by its least and greatest value in the
table. For each centroid a lookup table gives, for each component and cell, the
least and the greatest that the component adds to the squared distance (less the
vector's own squared length, which all centroids share); their sums over the
components are the ends of an interval that holds the distance. A vector whose
nearest interval ends before all others begin is assigned by its cells alone;
for the others the vector itself is fetched and compared with the centroids
whose intervals overlap. The tables hold whole numbers, so no rounding can
decide an assignment.

An assignment depends on the vector and the centroids only. So a round keeps no
state: it asks for the assignments to the centroids before and now, fetches the
vectors that moved between them, and changes the sums of both clusters by them.
A round reads the stored table once and shuffles one row per task and moved
cluster. Cells and vector are columns of one row, so that a fetch needs no join.

Takes part: vectors of exactly ``dims`` components, none null or non-finite, and
none of ``LIMIT`` or more in size after scaling (their sums would not fit in 64
bits). Null ids have no hash and rank last as first centroids; rows that repeat an
id are vectors of their own, ranked by their components. With fewer vectors than
centroids there is a centroid for each vector. An empty table gives no rows.
Only the id and the vector column are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.llm.common import ship, written

DIMS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
BITS = 6
SAMPLE = 4096
LIMIT = 1 << 24
SLICE = 4096


# ---- cells and intervals


class Cells:
    """The cells of each component: ``low`` and ``high`` are the least and greatest whole number in each."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, greatest: np.ndarray, bits: int = BITS):
        n = 1 << bits
        ranks = np.quantile(sample, np.arange(1, n) / n, axis=0, method="inverted_cdf")
        self.cuts = np.ceil(ranks).astype(np.int64).T  # component, cut: a cell holds its lower cut
        self.low = np.concatenate([np.minimum(least[:, None], self.cuts[:, :1]), self.cuts], axis=1)
        self.high = np.concatenate([self.cuts - 1, np.maximum(greatest[:, None], self.cuts[:, -1:])], axis=1)

    def of(self, v: np.ndarray) -> np.ndarray:
        """The cell of each component, a byte each."""
        out = np.empty(v.shape, np.uint8)
        for d in range(v.shape[1]):
            out[:, d] = np.searchsorted(self.cuts[d], v[:, d], side="right")
        return out


class Lookup:
    """For one set of centroids: what each component and cell adds at least and at most to each distance."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        c = centroids.T[:, None, :]  # component, 1, centroid
        ends = [c * c - 2 * c * edge[:, :, None] for edge in (cells.low, cells.high)]
        self.least, self.most = np.minimum(*ends), np.maximum(*ends)
        self.centroids = centroids

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """Rows by centroids: True where the centroid may be nearest, as its interval meets that of the nearest end."""
        least = np.zeros((len(cells), len(self.centroids)), np.int64)
        most = np.zeros_like(least)
        for d in range(cells.shape[1]):
            least += self.least[d][cells[:, d]]
            most += self.most[d][cells[:, d]]
        return least <= most.min(axis=1, keepdims=True)


def assign(look: Lookup, cells: np.ndarray, fetch) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties to the smaller number), and the rows that had to be fetched.

    ``fetch(rows)`` gives the whole vectors of the numbered rows.
    """
    open_ = look.candidates(cells)
    nearest = open_.argmax(axis=1)
    rows = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(rows):
        v, c = fetch(rows), look.centroids
        score = np.where(open_[rows], (c * c).sum(axis=1) - 2 * (v @ c.T), np.iinfo(np.int64).max)
        nearest[rows] = score.argmin(axis=1)
    return nearest, rows


def floor_means(sums: np.ndarray, counts: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count); the centroid before where a cluster is empty."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], before)


def centroid_sha(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


# ---- Spark


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, dims: int) -> DataFrame:
    """``vec_id`` and ``v`` (array<long>, floor(scale * x) of each component) of the vectors that take part."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    sound = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT / scale))
    rows = rows.filter((F.size("x") == dims) & sound)
    return rows.select("vec_id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors from little-endian 32-bit whole numbers, one binary value each."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), dims).astype(np.int64)


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def _stored(rows: DataFrame, dims: int, bits: int) -> DataFrame:
    """The vectors with their approximations, written once."""
    spark = rows.sparkSession
    ends = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.count("*").alias("n"))
    ends = np.array(sorted((r.d, r.a, r.b, r.n) for r in ends.collect()), np.int64)  # a row per component
    # A share of the rows by hash, so that the tasks together send the driver few more rows than the sample holds.
    draw = F.xxhash64(F.col("vec_id").cast("string"), F.lit("cells"))
    share = F.pmod(draw, F.lit(1 << 30)) < 2 * SAMPLE / ends[0, 3] * (1 << 30)
    drawn = rows.filter(F.coalesce(share, F.lit(False))).orderBy(draw, "v").limit(SAMPLE).select("v").collect()
    sample = np.array([r.v for r in drawn] or [ends[:, 1], ends[:, 2]], np.int64)
    shared = spark.sparkContext.broadcast(Cells(sample, ends[:, 1], ends[:, 2], bits))

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _binary(v.astype("<i4")), _binary(cells.of(v))], names=["vec_id", "v", "cells"]
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return written(rows.mapInArrow(approximate, f"vec_id {kind}, v binary, cells binary"), "va-file"), shared


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    dims: int = DIMS,
    bits: int = BITS,
) -> DataFrame:
    """Per vector: ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = whole_vectors(vectors, id_col, vector_col, scale, dims)
    hashed = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(hashed.asc_nulls_last(), "v").limit(centroids).select("v").collect()
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not first:
        return spark.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    now = np.array([r.v for r in first], np.int64)
    stored, shared = _stored(rows, dims, bits)
    before, sums, counts = None, np.zeros_like(now), np.zeros(len(now), np.int64)
    for _ in range(rounds):
        moved = _moved_sums(stored, shared, before, now)
        for r in moved.groupBy("cluster").agg(F.sum("n"), *[F.sum(F.col("s")[d]) for d in range(dims)]).collect():
            counts[r[0]] += r[1]
            sums[r[0]] += np.array(r[2:], np.int64)
        before, now = now, floor_means(sums, counts, now)
    placed = written(_distances(stored, shared, now), "va-placed")
    inertia = {r.cluster: r.s for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    each = F.create_map(*[F.lit(x) for c in range(len(now)) for x in (c, inertia.get(c, 0))])
    sha = F.create_map(*[F.lit(x) for c in range(len(now)) for x in (c, centroid_sha(now[c]))])
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        each[F.col("cluster")].cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        sha[F.col("cluster")].alias("centroid_sha256"),
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), SLICE):
            yield batch.slice(start, SLICE)


def _cells(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), dims)


def _moved_sums(stored: DataFrame, shared, before: np.ndarray | None, now: np.ndarray) -> DataFrame:
    """Per task, what the vectors that moved from the assignment before to that of now change in each cluster: ``cluster``, ``n``, ``s``."""

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(shared.value, now)
        past = None if before is None else Lookup(shared.value, before)
        dims = now.shape[1]
        sums, counts = np.zeros_like(now), np.zeros(len(now), np.int64)
        for batch in _slices(batches):
            fetch = lambda at, column=batch.column(0): _matrix(column.take(pa.array(at)), dims)
            cells = _cells(batch.column(1), dims)
            new, _ = assign(look, cells, fetch)
            old = np.full(len(new), -1) if past is None else assign(past, cells, fetch)[0]
            rows = np.flatnonzero(new != old)
            if len(rows):
                v = fetch(rows)
                np.add.at(sums, new[rows], v)
                counts += np.bincount(new[rows], minlength=len(now))
                left = old[rows] >= 0
                np.subtract.at(sums, old[rows][left], v[left])
                counts -= np.bincount(old[rows][left], minlength=len(now))
        at = np.flatnonzero((counts != 0) | (sums != 0).any(axis=1))
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(counts[at]), pa.array(sums[at].tolist(), pa.list_(pa.int64()))],
                names=["cluster", "n", "s"],
            )

    return stored.select("v", "cells").mapInArrow(change, "cluster int, n long, s array<long>")


def _distances(stored: DataFrame, shared, now: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` of every vector under the centroids ``now``."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(shared.value, now)
        for batch in _slices(batches):
            v = _matrix(batch.column(1), now.shape[1])
            to, _ = assign(look, _cells(batch.column(2), now.shape[1]), lambda at: v[at])  # noqa: B023
            distance = ((v - now[to]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(to.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    kind = stored.schema["vec_id"].dataType.simpleString()
    return stored.mapInArrow(place, f"vec_id {kind}, cluster int, distance long")
