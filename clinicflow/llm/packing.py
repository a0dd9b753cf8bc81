"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

Documents are tokenized (ids, then an end id); only those longer than a sequence
are cut, into full pieces and a last one. Full pieces are sequences of their own.
The rest is dealt by hash over regions of about ``REGION`` pieces, so that no
region grows with the data, and every region is packed by ``ISLANDS`` populations:

* a chromosome is a grouping of the region's pieces into bins; the first ones
  come from best-fit on decreasing and on disturbed orders;
* crossover injects whole well-filled bins of one parent into the other, removes
  the bins that then hold a piece twice, and puts their other pieces back, first
  in place of smaller pieces of bins that they fill better, then by best fit,
  largest first; mutation takes the emptiest bin and a few others apart and does
  the same; fitness is the mean squared filling (Falkenauer). Generations end at
  the bound of the sum, or when the best one hasn't improved for ``PATIENCE``;
* after each epoch the elites of an island migrate to the next island of its region
  (a shuffle), and the islands go on with them.

The best chromosome of each region wins. Bins that are then not full (below
``REPACK_BELOW``) are taken apart, and their pieces are packed again in new
regions, so that the loss doesn't grow with the number of regions.

Null text counts as empty: such a document is its end id alone. Repeated rows
are packed as documents of their own. Only the id and the text column are read.
An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicflow.llm.common import ship, written

CAPACITY = 2048
END_ID = 0
REGION = 4000
ISLANDS = 2
EPOCHS = 2
POPULATION = 5
GENERATIONS = 60
PATIENCE = 12
ELITES = 2
INJECTED = 0.4
MUTATED = 6
REPACK_BELOW = 1.0
CACHE_WORDS = 1_000_000

# ---- tokenizing


# Characters that NFC leaves alone and whose lower case is one character wherever they stand.
_PLAIN = frozenset(map(chr, (*range(0x21, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x250))))
_PROBES = ("a b", "It's  12 o'clock,\nisn't it?", " x\n\ny ", "(a) - 'b' ... \u00e9t\u00e9 \u65e5\u672c", "3 4 56")


class Remembered(dict):
    """Ids of short strings, found once by ``find``; emptied when it is full."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, key: str) -> bytes:
        ids = self.find(key)
        if len(key) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[key] = ids
        return ids


class CachedTokenizer:
    """Ids of whole texts from a tokenizers file.

    If the file's words are the matches of one pattern in lower case, none with a
    blank, texts are cut at blanks and line ends, and plain parts into those words,
    whose ids the library's model gives; ids of parts and words are remembered in
    bounded caches. Texts go through the library whole if the file is of another
    kind or the cut ones' ids differ on probes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = re.compile(r"[^ \n]+")
        self.model = self.tokenizer.model
        self.words = Remembered(self._word_ids)
        self.cache = Remembered(self._part_ids)
        self.pattern = self._kept_pattern()
        self.cuts = self.pattern is not None and all(self._cut_ids(t) == self._whole_ids(t) for t in _PROBES)

    def _kept_pattern(self):
        """The pattern whose matches are the file's words, if they are found in lower-case NFC text; else None."""
        file = json.loads(self.tokenizer.to_str())
        first = file.get("pre_tokenizer") or {}
        first, *others = first.get("pretokenizers") or [first]
        if any(o.get("type") != "ByteLevel" or o.get("use_regex") or o.get("add_prefix_space") for o in others):
            return None
        added = [t for t in file.get("added_tokens") or [] if t.get("content")]
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or regex.search(r"\s", t["content"]) for t in added):
            return None
        self.added = re.compile("|".join(re.escape(t["content"].lower()) for t in added) or "(?!)")
        normal = file.get("normalizer") or {}
        kinds = {n.get("type") for n in normal.get("normalizers") or [normal]}
        if first.get("behavior") != "Removed" or not first.get("invert") or kinds - {"NFC", "Replace", "Lowercase"} or "Lowercase" not in kinds:
            return None
        pattern = regex.compile((first.get("pattern") or {}).get("Regex") or "")
        blank = any(regex.search(r"\s", m) for t in _PROBES for m in pattern.findall(t))
        if blank or pattern.groups or pattern.search(""):
            return None
        # What the file's byte level makes of each plain character.
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.bytes = {ord(c): "".join(w for w, _ in spell(c)) for c in {c.lower() for c in _PLAIN}}
        return pattern

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self._cut_ids(text or "") if self.cuts else self._whole_ids(text or "")

    def forget(self) -> None:
        """Gives back the memory of what is remembered."""
        self.cache.clear()
        self.words.clear()

    def _whole_ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _cut_ids(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, self.parts.findall(text)))

    def _part_ids(self, part: str) -> bytes:
        low = part.lower()
        if _PLAIN.issuperset(part) and not self.added.search(low):
            return b"".join(map(self.words.__getitem__, self.pattern.findall(low)))
        return self._whole_ids(part)

    def _word_ids(self, word: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(word.translate(self.bytes))]).tobytes()


_tokenizers: dict[str, CachedTokenizer] = {}


def load(path: str) -> CachedTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = CachedTokenizer(path)
    return _tokenizers[path]


def pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False, keep_words: bool = True
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and the ids).

    ``keep_words``: whether a worker remembers words from one task to the next (up to 400 MB); if other steps follow
    in the same executors, idle workers would hold them for a minute or more.
    """
    ship(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_col]
    end = array("I", (END_ID,)).tobytes()

    def run(batches):
        tokenizer = load(tokenizer_path)
        try:
            yield from cut(tokenizer, batches)
        finally:
            if not keep_words:
                tokenizer.forget()

    def cut(tokenizer, batches):
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                raw = tokenizer.ids(text.as_py()) + end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(array("I", part).tolist())
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crc)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    return docs.select(id_col, text_col).mapInArrow(run, schema + (", ids array<long>" if with_ids else ""))


# ---- one region


class Space:
    """Bins with free room, best fit by bisection over (room, bin)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[tuple[int, int]] = []
        self.next = 0

    def place(self, size: int) -> int:
        k = bisect.bisect_left(self.rooms, (size, -1))
        if k == len(self.rooms):
            number, left = self.next, self.capacity - size
            self.next += 1
        else:
            room, number = self.rooms.pop(k)
            left = room - size
        if left:
            bisect.insort(self.rooms, (left, number))
        return number


def best_fit(sizes: list[int], order, capacity: int) -> np.ndarray:
    """Bin number of each piece, placed in the given order."""
    space, bins = Space(capacity), np.empty(len(sizes), np.int32)
    for i in order:
        bins[i] = space.place(sizes[i])
    return bins


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> float:
    filled = np.bincount(bins, weights=sizes)
    filled = filled[filled > 0]
    return float(((filled / capacity) ** 2).mean()) if len(filled) else 1.0


def crossover(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, size_list: list[int], capacity: int, rnd) -> np.ndarray:
    """Whole well-filled bins of ``right`` injected into ``left``; displaced pieces return by best fit."""
    filled = np.bincount(right, weights=sizes)
    order = np.argsort(-filled + rnd.uniform(0, 0.02 * capacity, len(filled)), kind="stable")
    taken = order[: max(1, int(len(order) * INJECTED * rnd.uniform(0.5, 1.5)))]
    taken = taken[filled[taken] > 0]
    is_taken = np.zeros(len(filled), bool)
    is_taken[taken] = True
    injected = is_taken[right]
    broken = np.zeros(int(left.max()) + 1, bool)
    broken[left[injected]] = True
    displaced = broken[left] & ~injected
    child = np.where(injected, right + (int(left.max()) + 1), left)
    settled = ~displaced
    return put_back(child, displaced, sizes, size_list, capacity)


def mutate(bins: np.ndarray, sizes: np.ndarray, size_list: list[int], capacity: int, rnd) -> np.ndarray:
    """The emptiest bin and a few others taken apart; their pieces return."""
    filled = np.bincount(bins, weights=sizes)
    held = np.flatnonzero(filled)
    gone = np.zeros(len(filled), bool)
    gone[held[np.argsort(filled[held], kind="stable")[:1]]] = True
    gone[rnd.choice(held, min(len(held), int(rnd.integers(2, 2 + MUTATED))), replace=False)] = True
    return put_back(bins, gone[bins], sizes, size_list, capacity)


def put_back(bins: np.ndarray, displaced: np.ndarray, sizes: np.ndarray, size_list: list[int], capacity: int) -> np.ndarray:
    """Displaced pieces put back: first in place of smaller ones that they fill a bin better than, the rest by best fit, largest first."""
    settled = ~displaced
    names, compact = np.unique(bins[settled], return_inverse=True)
    out = np.empty(len(bins), np.int32)
    out[settled] = compact
    room = (capacity - np.bincount(compact, weights=sizes[settled], minlength=len(names))).astype(np.int64).tolist()
    loose = sorted((size_list[i], int(i)) for i in np.flatnonzero(displaced))
    if loose:
        spare = np.array(room, np.int64)
        kept = np.flatnonzero(settled)
        least, most = sizes[kept] + 1, sizes[kept] + spare[compact]
        held = np.array([size for size, _ in loose])
        # Only pieces that a displaced one can replace, judged before the first exchange, are looked at.
        for i in kept[np.searchsorted(held, most, side="right") > np.searchsorted(held, least)].tolist():
            number, size = int(out[i]), size_list[i]
            k = bisect.bisect_right(loose, (size + room[number], len(size_list))) - 1
            if k >= 0 and loose[k][0] > size:
                larger, other = loose.pop(k)
                out[other] = number
                room[number] -= larger - size
                bisect.insort(loose, (size, i))
    space = Space(capacity)
    space.next = len(names)
    space.rooms = sorted((r, b) for b, r in enumerate(room) if r)
    for size, i in reversed(loose):
        out[i] = space.place(size)
    return out


def first_population(sizes: np.ndarray, capacity: int, rnd) -> list[np.ndarray]:
    size_list = sizes.tolist()
    out = [best_fit(size_list, np.argsort(-sizes, kind="stable"), capacity)]
    while len(out) < POPULATION:
        noise = rnd.uniform(0.0, 0.5 * len(out) / POPULATION, len(sizes))
        out.append(best_fit(size_list, np.argsort(-sizes * (1 - noise), kind="stable"), capacity))
    return out


def evolve(population: list[np.ndarray], sizes: np.ndarray, capacity: int, rnd, generations: int = GENERATIONS) -> list[tuple[float, np.ndarray]]:
    """Generations of tournament, crossover and replacement of the worst; best first."""
    size_list = sizes.tolist()
    least = -(-int(sizes.sum()) // capacity)
    ranked = sorted(((fitness(p, sizes, capacity), k, p) for k, p in enumerate(population)), key=lambda x: (-x[0], x[1]))
    number = len(ranked)
    idle = 0
    for _ in range(generations):
        if idle >= PATIENCE or len(np.unique(ranked[0][2])) <= least:
            break
        before = ranked[0][0]
        for _ in range(max(1, POPULATION // 2)):
            a, b = rnd.choice(len(ranked), 2, replace=len(ranked) < 2)
            a, b = min(a, b), max(a, b)
            crossed = crossover(ranked[b][2], ranked[a][2], sizes, size_list, capacity, rnd)
            for child in (crossed, mutate(ranked[a][2], sizes, size_list, capacity, rnd)):
                ranked.append((fitness(child, sizes, capacity), number, child))
                number += 1
        ranked = sorted(ranked, key=lambda x: (-x[0], x[1]))[:POPULATION]
        idle = 0 if ranked[0][0] > before else idle + 1
    return [(f, p) for f, _, p in ranked]


# ---- regions and islands as Spark groups


def _in_order(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["length", "key"], ascending=[False, True], kind="stable")


def _seed(region: int, island: int, epoch: int):
    return np.random.default_rng([int(region) & 0xFFFFFFFF, int(island), epoch])


def _pack_regions(items: DataFrame, capacity: int, tag: str) -> DataFrame:
    """(key, length, region, bin) of ``items`` (key long, length long, region long)."""
    on_islands = items.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    chromosome = "region long, island int, fitness double, bins binary"

    def elites(region, island, population) -> pd.DataFrame:
        best = population[:ELITES]
        return pd.DataFrame({"region": region, "island": island, "fitness": [f for f, _ in best], "bins": [p.astype("<i4").tobytes() for _, p in best]})

    def start(key, pdf):
        sizes = _in_order(pdf)["length"].to_numpy()
        rnd = _seed(key[0], key[1], 0)
        return elites(key[0], key[1], evolve(first_population(sizes, capacity, rnd), sizes, capacity, rnd))

    def going_on(epoch):
        def go_on(key, left, right):
            sizes = _in_order(left)["length"].to_numpy()
            right = right.sort_values(["fitness", "bins"], ascending=[False, True], kind="stable")
            population = [np.frombuffer(b, "<i4").astype(np.int32) for b in right["bins"]]
            return elites(key[0], key[1], evolve(population, sizes, capacity, _seed(key[0], key[1], epoch)))

        return go_on

    islands = written(on_islands.groupBy("region", "island").applyInPandas(start, chromosome), f"{tag}-epoch")
    for epoch in range(1, EPOCHS):
        migrants = islands.withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        arrived = islands.unionByName(migrants)

        grouped = on_islands.groupBy("region", "island").cogroup(arrived.groupBy("region", "island"))
        islands = written(grouped.applyInPandas(going_on(epoch), chromosome), f"{tag}-epoch")

    best = islands.groupBy("region").agg(F.max_by("bins", F.struct("fitness", "island")).alias("bins"))

    def assign(key, left, right):
        left = _in_order(left)
        return pd.DataFrame({"key": left["key"], "length": left["length"], "region": key[0], "bin": np.frombuffer(right["bins"].iloc[0], "<i4")})

    grouped = items.groupBy("region").cogroup(best.groupBy("region"))
    return grouped.applyInPandas(assign, "key long, length long, region long, bin int")


def _dealt(items: DataFrame, salt: str) -> DataFrame:
    """Pieces over regions of about REGION by hash."""
    regions = max(1, -(-items.count() // REGION))
    return items.select("key", "length", F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(regions)).alias("region"))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` added to the pieces (columns as from ``pieces``)."""
    ship(cut.sparkSession)
    keyed = written(cut.withColumn("key", F.monotonically_increasing_id()), "pieces")
    items = keyed.filter(F.col("length") < capacity).select("key", "length")
    first = written(_pack_regions(_dealt(items, "first"), capacity, "pack"), "packed")
    filled = first.groupBy("region", "bin").agg(F.sum("length").alias("filled"))
    poor = filled.filter(F.col("filled") < REPACK_BELOW * capacity).select("region", "bin")
    loose = written(first.join(poor, ["region", "bin"], "left_semi").select("key", "length"), "loose")
    good = first.join(poor, ["region", "bin"], "left_anti")
    again = written(_pack_regions(_dealt(loose, "again"), capacity, "repack"), "repacked")
    # The new grouping replaces the old one only where it needs fewer bins.
    fewer = again.select("region", "bin").distinct().count() < poor.count()
    if fewer:
        packed = good.withColumn("round", F.lit(0)).unionByName(again.withColumn("round", F.lit(1)))
    else:
        packed = first.withColumn("round", F.lit(0))
    return keyed.join(_placed(packed, keyed, capacity), "key").drop("key")


def _placed(packed: DataFrame, keyed: DataFrame, capacity: int) -> DataFrame:
    """(key, sequence_id, offset): bins are numbered and their pieces put one after the other."""
    inside = Window.partitionBy("round", "region", "bin").orderBy("key")
    sequence = F.col("round").cast("long") * (1 << 58) + F.col("region") * (1 << 20) + F.col("bin")
    shared = packed.select("key", sequence.alias("sequence_id"), (F.sum("length").over(inside) - F.col("length")).alias("offset"))
    full = keyed.filter(F.col("length") >= capacity).select("key", (-F.col("key") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return shared.unionByName(full)
