"""Nearest neighbours by inner product through learned partitions.

On a bounded sample of the vectors the graph of nearest neighbours is built and
cut into balanced parts (balanced splits along main directions, then sweeps in
which a vector moves to the part of most of its neighbours while that part has
room). A small network learns how the neighbours of a vector are spread over the
parts. It puts every vector of the table into its most probable part, and sends
each query to as many of its most probable parts as hold ``COVER`` of the
probability (and enough vectors). There all vectors are ranked by their exact
inner product in double precision. There are ``PARTS`` parts whatever the size of the
table (fewer only where the sample is too small for them).

Parts are searched in blocks of about ``BLOCK`` vectors and ``BLOCK`` queries, so a part
that holds many copies is split over tasks. A query asks its blocks in turns, the most
probable first, ``GROWTH`` times as many in each turn as in all before. It takes its
k-th best score so far along, and a block returns only what reaches it; so each turn
returns a few times k rows a query, however many blocks it asks.

Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part; nor do null ids. Rows that repeat an id count
as one candidate (its best score), and never as a neighbour of that id. Only the
id and the vector column are read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicflow.llm.common import ship, written

NEIGHBOURS = 20
EVERY = 20
SAMPLE = 4000
GRAPH = 20
PARTS = 64
FIRST = 2
GROWTH = 8
COVER = 0.95
BLOCK = 2000
SLACK = 1.15
HIDDEN = 128
EPOCHS = 30
SEED = 11


# ---- fitting, on the bounded sample


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(x), k), np.int32)
    for start in range(0, len(x), 1000):
        s = x[start : start + 1000] @ x.T
        s[np.arange(len(s)), np.arange(start, start + len(s))] = -np.inf
        out[start : start + 1000] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 8) -> np.ndarray:
    """A part for each vector, none larger than SLACK times the mean."""
    part = np.zeros(len(x), np.int64)

    def split(members: np.ndarray, first: int, n: int) -> None:
        if n == 1:
            part[members] = first
            return
        centred = x[members] - x[members].mean(axis=0)
        direction = np.linalg.svd(centred[:2000], full_matrices=False)[2][0]
        order = members[np.argsort(centred @ direction, kind="stable")]
        cut = len(order) * (n // 2) // n
        split(order[:cut], first, n // 2)
        split(order[cut:], first + n // 2, n - n // 2)

    split(np.arange(len(x)), 0, parts)
    both = [list(row) for row in graph]
    for i, row in enumerate(graph):
        for j in row:
            both[j].append(i)
    room = int(np.ceil(len(x) / parts * SLACK))
    size = np.bincount(part, minlength=parts)
    rnd = np.random.default_rng(SEED)
    for _ in range(sweeps):
        moved = 0
        for i in rnd.permutation(len(x)):
            near = np.bincount(part[both[i]], minlength=parts).astype(float)
            near[(size >= room) & (np.arange(parts) != part[i])] = -1
            best = int(near.argmax())
            if near[best] > near[part[i]]:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
                moved += 1
        if moved < len(x) // 200:
            break
    return part


class Router:
    """A network of one hidden layer from a vector to the probabilities of the parts."""

    def __init__(self, x: np.ndarray, targets: np.ndarray):
        rnd = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
        weights = [rnd.normal(size=(x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]), np.zeros(HIDDEN)]
        weights += [rnd.normal(size=(HIDDEN, targets.shape[1])) * np.sqrt(1 / HIDDEN), np.zeros(targets.shape[1])]
        self.weights = weights
        z = (x - self.mean) / self.scale
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        step = 0
        for epoch in range(EPOCHS):
            rate = 3e-3 * (1 - epoch / EPOCHS) + 1e-4
            order = rnd.permutation(len(z))
            for start in range(0, len(z), 256):
                b = order[start : start + 256]
                hidden = np.maximum(z[b] @ weights[0] + weights[1], 0)
                error = (self._softmax(hidden @ weights[2] + weights[3]) - targets[b]) / len(b)
                back = (error @ weights[2].T) * (hidden > 0)
                grads = [z[b].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
                step += 1
                for k, g in enumerate(grads):
                    g = g + 1e-5 * weights[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _softmax(s: np.ndarray) -> np.ndarray:
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return self._softmax(np.maximum(z @ self.weights[0] + self.weights[1], 0) @ self.weights[2] + self.weights[3])


def fit(sample: np.ndarray) -> Router | None:
    """The router of a table, from a sample of it; None where the sample has no room for two parts."""
    parts = min(PARTS, len(sample) // (2 * GRAPH))
    if parts < 2:
        return None
    graph = neighbour_graph(sample, GRAPH)
    part = balanced_parts(sample, graph, parts)
    targets = np.zeros((len(sample), parts))
    np.add.at(targets, (np.repeat(np.arange(len(sample)), GRAPH), part[graph].ravel()), 1.0 / GRAPH)
    return Router(sample, targets)


def routes(probability: np.ndarray, counts: np.ndarray, need: int) -> list[np.ndarray]:
    """For each query the most probable parts that hold COVER of the probability and ``need`` ids."""
    order = np.argsort(-probability, axis=1, kind="stable")
    mass = np.cumsum(np.take_along_axis(probability, order, axis=1), axis=1)
    held = np.cumsum(counts[order], axis=1)
    enough = (mass >= COVER) & (held >= need)
    last = np.where(enough.any(axis=1), enough.argmax(axis=1), order.shape[1] - 1)
    return [order[i, : last[i] + 1] for i in range(len(order))]


# ---- search


def _vectors(packed) -> np.ndarray:
    """Vectors from little-endian doubles, one binary value each."""
    packed = [v.as_py() for v in packed] if isinstance(packed, pa.Array) else packed
    return np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), -1)


def best_of_block(q_ids, q, c_ids, c, k: int, least: np.ndarray | None = None) -> pd.DataFrame:
    """The k best candidate ids of each query, each by its best row; ties to the smaller id; scores are summed alike for equal vectors.

    ``least``: the score that a candidate must reach, for each query.
    """
    least = np.full(len(q_ids), -np.inf) if least is None else least
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    starts = np.flatnonzero(np.r_[True, c_ids[1:] != c_ids[:-1]])
    found, scores = [], []
    for i, s in enumerate(q @ c.T):
        s[c_ids == q_ids[i]] = -np.inf
        if least[i] > -np.inf:
            s[s < least[i] - 1e-9 * (1 + abs(least[i]))] = -np.inf
        if len(starts) > k:
            best = np.maximum.reduceat(s, starts)
            limit = np.partition(best, len(best) - k)[len(best) - k]
            s[s < limit - 1e-9 * (1 + abs(limit))] = -np.inf
        near = np.flatnonzero(s > -np.inf)
        exact = (c[near] * q[i]).sum(axis=1)
        near, exact = near[exact >= least[i]], exact[exact >= least[i]]
        first = np.argsort(-exact, kind="stable")
        first = first[np.sort(np.unique(c_ids[near[first]], return_index=True)[1])[:k]]
        found.append(c_ids[near[first]])
        scores.append(exact[first])
    queries = np.repeat(q_ids, [len(f) for f in found])
    return pd.DataFrame({"query_id": queries, "vec_id": np.concatenate(found), "score": np.concatenate(scores)})


def search(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    every: int = EVERY,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest found of each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & sound)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == lengths["n"])
    total = lengths["count"]
    # The sample holds an id once, however often its rows repeat.
    draw = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.filter(draw < 2 * SAMPLE / total).groupBy("id").agg(F.min("v").alias("v")).orderBy(draw, "id").limit(SAMPLE).toPandas()
    router = fit(np.array(drawn["v"].tolist())) if len(drawn) else None
    shared = spark.sparkContext.broadcast(router)  # a few hundred kB

    def assign(batches):
        model = shared.value
        for batch in batches:
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            part = model.probabilities(v).argmax(axis=1) if model else np.zeros(len(v), np.int64)
            packed = pa.array([row.astype("<f8").tobytes() for row in v], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, pa.array(part.astype(np.int32))], names=["id", "v", "part"])

    placed = written(rows.mapInArrow(assign, "id long, v binary, part int"), "vectors")
    held = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # one number per part
    parts = max(held) + 1
    # Each id counts in one part, so that repeated ids don't stand for different candidates.
    ids = {r["part"]: r["count"] for r in placed.groupBy("id").agg(F.min("part").alias("part")).groupBy("part").count().collect()}
    counts = np.array([ids.get(p, 0) for p in range(parts if router is None else router.weights[3].size)])

    blocks = [-(-held.get(p, 0) // BLOCK) for p in range(len(counts))]

    def route(batches):
        model = shared.value
        for batch in batches:
            v = _vectors(batch.column(1))
            to = routes(model.probabilities(v), counts, 4 * k) if model else [np.zeros(1, np.int64)] * len(v)
            visits = [[{"part": int(p), "block": b} for p in t for b in range(blocks[p])] for t in to]
            kind = pa.list_(pa.struct([("part", pa.int32()), ("block", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(visits, kind)], names=["id", "v", "visits"])

    asked = placed.filter(F.col("id") % every == 0).select("id", "v")
    asked = asked.mapInArrow(route, "id long, v binary, visits array<struct<part:int,block:int>>")
    asked = written(asked.select("id", "v", F.posexplode("visits").alias("turn", "visit")).select("id", "v", "turn", "visit.*"), "queries")
    last = asked.agg(F.max("turn")).first()[0]
    number = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), n.cast("long")).cast("int")
    in_part = F.create_map(*[F.lit(x) for p, n in enumerate(blocks) for x in (p, max(n, 1))])
    stored = placed.withColumn("block", number("block", in_part[F.col("part")]))

    def rank(left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        least = left["least"].fillna(-np.inf).to_numpy(np.float64)
        q, c = _vectors(list(left["v"])), _vectors(list(right["v"]))
        return best_of_block(left["id"].to_numpy(), q, right["id"].to_numpy(), c, k, least)

    keys = ["part", "block", "chunk"]
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found, begin, end = None, 0, FIRST
    while last is not None and begin <= last:
        turn = asked.filter((F.col("turn") >= begin) & (F.col("turn") < end)).drop("turn")
        if found is None:
            turn = turn.withColumn("least", F.lit(None).cast("double"))
        else:
            reached = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
            turn = turn.join(reached, "id", "left")
        # Queries of a block are dealt into chunks; the block goes to each of them.
        chunks = F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks")
        sizes = written(turn.groupBy("part", "block").agg(chunks), "chunks")
        queries = turn.join(sizes, ["part", "block"]).withColumn("chunk", number("chunk", F.col("chunks"))).drop("chunks")
        candidates = stored.join(sizes, ["part", "block"])
        candidates = candidates.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
        ranked = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(rank, "query_id long, vec_id long, score double")
        both = ranked if found is None else ranked.unionByName(found.drop("rank"))
        once = both.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        found = written(once.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")
        begin, end = end, end * GROWTH
    return found if found is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
