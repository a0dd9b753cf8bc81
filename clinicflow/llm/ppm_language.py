"""Language identification by prediction by partial matching.

For each language a byte context tree of orders 0 to 3 holds how often each byte
followed each context in the learnt texts. The probability of a byte after a
context is its count over the total plus the number of different followers;
the rest is the escape to the next shorter context, whose probabilities are
renormalised over the bytes not seen in the longer one (exclusion), down to an
order 0 that no byte escapes. A context that a language never held passes on to
the next shorter one, which makes the order variable. The statistics are frozen,
so the code length of a text is an exact sum over its bytes; the language with
the shortest code wins.

Texts are taken in lower case with everything that is no letter in ASCII turned
into single spaces. All counts of all rows given are kept, in tables: one row per
language and context of order 2 or 3, with the code length of each follower and
of the escape; orders 0 and 1 are a dense array (65,792 cells a language). The
contexts that occur most go to the tasks as a broadcast of at most ``cells``
values. If that holds the whole tree, documents are scored in one pass. If not,
a document's four-byte grams after other contexts, added up per document, are
joined with the tables; the bound decides where a value is looked up, never which.

Null texts and texts without a letter give ``und`` with score 0; so does every
text if nothing was learnt. Ties take the first language in order. Repeated rows
are scored alike. Only the id, text and language columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.llm.common import id_crc, ship, written

ORDER = 3
TABLE_CELLS = 8_000_000
SLICE_BYTES = 1_000_000
FOLDS, HELD_OUT = 5, 0

_LETTER = regex.compile(r"\p{L}")
_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_START = b" " * ORDER


def prepared(text: str | None) -> bytes:
    """The byte stream that is modelled; empty if the text has no letter."""
    if not text or not _LETTER.search(text):
        return b""
    words = text.lower().encode("utf-8").translate(_TABLE).split()
    return b" ".join(words) + b" "


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte grams (context and follower as one number) of each byte of the texts, and each text's first place."""
    lengths = np.array([len(t) for t in texts], np.int64)
    firsts = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(_START + t for t in texts), np.uint8).astype(np.uint32)
    inside = np.ones(len(data), bool)  # the spaces before a text are only context
    starts = firsts + ORDER * np.arange(len(texts))
    inside[(starts[:, None] + np.arange(ORDER)).ravel()] = False
    grams = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    return grams[inside[3:]], firsts


# ---- learning


def _count(batches):
    """Four-byte grams of each partition by language, added up before they leave it."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def settle(lang: str) -> None:
        size[lang] = 0
        codes, counts = np.unique(grams_of(waiting.pop(lang))[0], return_counts=True)
        if lang in held:
            codes = np.concatenate([held[lang][0], codes])
            counts = np.concatenate([held[lang][1], counts])
            codes, back = np.unique(codes, return_inverse=True)
            counts = np.bincount(back, weights=counts).astype(np.int64)
        held[lang] = (codes, counts)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = prepared(text.as_py())
            if data:
                waiting.setdefault(lang, []).append(data)
                size[lang] = size.get(lang, 0) + len(data)
                if size[lang] >= 4 * SLICE_BYTES:
                    settle(lang)
    for lang in list(waiting):
        settle(lang)
    for lang, (codes, counts) in held.items():
        for k in range(0, len(codes), 50_000):
            part = slice(k, k + 50_000)
            n = len(codes[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n), pa.array(codes[part].astype(np.int64)), pa.array(counts[part].astype(np.int64))],
                names=["lang", "gram", "n"],
            )


class Shallow:
    """Code lengths of orders 0 and 1: an array over (language, byte before, byte)."""

    def __init__(self, counts: np.ndarray):
        """``counts`` over (language, byte before, byte)."""
        singles = counts.sum(axis=1)
        used = singles.any(axis=0)
        used[32] = True
        used[np.flatnonzero(~used)[:1]] = True  # one byte stands for all those never learnt
        self.used = used
        zero = (1.0 + singles) / (used.sum() + singles.sum(axis=1, keepdims=True))
        total, seen = counts.sum(axis=2, keepdims=True), counts > 0
        weight = np.maximum(total + seen.sum(axis=2, keepdims=True), 1)
        rest = np.where(seen | ~used, 0.0, zero[:, None, :]).sum(axis=2, keepdims=True)
        below = np.broadcast_to(zero[:, None, :], counts.shape)
        escaped = below * np.where(total > 0, seen.sum(axis=2, keepdims=True) / weight / rest, 1.0)
        self.nats = -np.log(np.where(seen, counts / weight, escaped))

    def context(self, followers: np.ndarray, n: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, float]:
        """Code lengths of the followers of a longer context and of its escape; ``below``: nats of the next shorter one."""
        unseen = self.used.copy()
        unseen[followers] = False
        weight = n.sum() + len(n)
        return -np.log(n / weight), float(np.log(np.exp(-below[unseen]).sum()) - np.log(len(n) / weight))


_LEVEL = "lang int, context long, followers array<int>, nats array<double>, escape double, total long"


def _level_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.float64(), pa.int64()]
    names = ["lang", "context", "followers", "nats", "escape", "total"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _contexts(grams: DataFrame) -> DataFrame:
    """Followers (at most 256) of each context: ``seen`` holds (follower, n)."""
    one = F.struct(F.col("gram").bitwiseAND(255).cast("int").alias("follower"), "n")
    return grams.groupBy("lang", F.shiftright("gram", 8).alias("context")).agg(F.array_sort(F.collect_list(one)).alias("seen"))


def _levels(grams: DataFrame, langs: list[str]) -> tuple[Shallow, DataFrame, DataFrame]:
    """Orders 0 and 1 as an array, orders 2 and 3 as tables (lang as its place in ``langs``)."""
    spark = grams.sparkSession
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    grams = grams.select(F.element_at(number, F.col("lang")).alias("lang"), "gram", "n")
    triples = grams.groupBy("lang", F.col("gram").bitwiseAND(0xFFFFFF).alias("gram")).agg(F.sum("n").alias("n"))
    pairs = triples.groupBy("lang", F.col("gram").bitwiseAND(0xFFFF).alias("gram")).agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), 65536))  # at most 65,536 rows a language
    counts[pairs["lang"].to_numpy(), pairs["gram"].to_numpy()] = pairs["n"].to_numpy()
    shared = spark.sparkContext.broadcast(Shallow(counts.reshape(-1, 256, 256)))

    def second(batches):
        shallow = shared.value
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                followers = np.array([x["follower"] for x in row["seen"]])
                n = np.array([x["n"] for x in row["seen"]], np.float64)
                nats, escape = shallow.context(followers, n, shallow.nats[row["lang"], row["context"] & 255])
                rows.append((row["lang"], row["context"], followers, nats, escape, int(n.sum())))
            if rows:
                yield _level_batch(rows)

    def third(batches):
        shallow = shared.value
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                below = shallow.nats[row["lang"], row["context"] & 255] + row["escape"]
                below[row["followers"]] = row["nats"]
                followers = np.array([x["follower"] for x in row["seen"]])
                n = np.array([x["n"] for x in row["seen"]], np.float64)
                nats, escape = shallow.context(followers, n, below)
                rows.append((row["lang"], row["context"], followers, nats, escape, int(n.sum())))
            if rows:
                yield _level_batch(rows)

    two = written(_contexts(triples).mapInArrow(second, _LEVEL), "ppm-two")
    below = two.select("lang", F.col("context").alias("shorter"), "followers", "nats", "escape")
    deep = _contexts(grams).withColumn("shorter", F.col("context").bitwiseAND(0xFFFF)).join(below, ["lang", "shorter"])
    three = written(deep.drop("shorter").mapInArrow(third, _LEVEL), "ppm-three")
    return shared.value, two, three


# ---- what the tasks hold


class Held:
    """Code lengths after the contexts that tasks hold, for all languages at once."""

    def __init__(self, shallow: Shallow, two, three, complete: bool):
        """``two``, ``three``: rows of those orders as pandas frames; ``complete``: there are no others."""
        self.low = np.ascontiguousarray(shallow.nats.reshape(len(shallow.nats), -1).T)
        self.complete = complete
        self.contexts, self.escapes, self.grams, self.nats = {}, {}, {}, {}
        for order, rows in ((2, two), (3, three)):
            self._add(order, rows)

    def _add(self, order: int, rows) -> None:
        langs = self.low.shape[1]
        lang, context = rows["lang"].to_numpy(np.int64), rows["context"].to_numpy(np.int64)
        self.contexts[order], place = np.unique(context, return_inverse=True)
        escapes = np.zeros((len(self.contexts[order]), langs))
        escapes[place, lang] = rows["escape"].to_numpy()
        self.escapes[order] = escapes
        many = np.array([len(f) for f in rows["followers"]], np.int64)
        codes = np.repeat(context << 8, many) | (np.concatenate(rows["followers"].tolist()) if len(rows) else np.zeros(0, np.int64))
        codes, at = np.unique(codes, return_inverse=True)
        nats = np.full((len(codes), langs), np.nan)
        nats[at, np.repeat(lang, many)] = np.concatenate(rows["nats"].tolist()) if len(rows) else np.zeros(0)
        below = self.escapes[order][np.searchsorted(self.contexts[order], codes >> 8)] + self._shorter(codes, order)
        self.grams[order], self.nats[order] = codes, np.where(np.isnan(nats), below, nats)

    def _shorter(self, codes: np.ndarray, order: int) -> np.ndarray:
        return self.low[codes & 0xFFFF] if order == 2 else self.look_up(codes & 0xFFFFFF, 2)[0]

    def look_up(self, codes: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
        """(codes, languages) nats, and which codes' contexts aren't held."""
        found, at = _places(self.grams[order], codes)
        out = np.empty((len(codes), self.low.shape[1]))
        out[found] = self.nats[order][at[found]]
        left = np.flatnonzero(~found)
        known, context = _places(self.contexts[order], codes[left] >> 8)
        out[left] = self._shorter(codes[left], order)
        out[left[known]] += self.escapes[order][context[known]]
        away = np.zeros(len(codes), bool)
        away[left[~known]] = True
        return out, away

    def score(self, texts: list[bytes]):
        """Slices of texts as (first text, nats (texts, languages), grams still to be added (text, gram, n))."""
        k = 0
        while k < len(texts):
            first, room = k, SLICE_BYTES
            while k < len(texts) and (k == first or len(texts[k]) <= room):
                room -= len(texts[k])
                k += 1
            yield first, *self._slice(texts[first:k])

    def _slice(self, texts: list[bytes]):
        grams, firsts = grams_of(texts)
        out = np.zeros((len(texts), self.low.shape[1]))
        none = np.zeros(0, np.int64)
        filled = np.flatnonzero([len(t) > 0 for t in texts])
        if not len(filled):
            return out, (none, none, none)
        codes, back = np.unique(grams, return_inverse=True)
        nats, away = self.look_up(codes.astype(np.int64))
        rest = (none, none, none)
        if not self.complete and away.any():
            nats[away] = 0.0
            places = np.flatnonzero(away[back])
            owner = np.searchsorted(firsts, places, side="right") - 1
            pairs, n = np.unique(owner * len(codes) + back[places], return_counts=True)
            rest = (pairs // len(codes), codes[pairs % len(codes)].astype(np.int64), n)
        for j in range(out.shape[1]):
            out[filled, j] = np.add.reduceat(nats[back, j], firsts[filled])
        return out, rest


def _places(held: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(held):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
    return held[at] == wanted, at


@dataclass
class Trees:
    """Frozen statistics: what tasks hold, and the tables of orders 2 and 3 with everything."""

    langs: list[str]
    held: Held
    two: DataFrame
    three: DataFrame


def learn(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", cells: int = TABLE_CELLS) -> Trees | None:
    """Context trees of the languages in ``rows``; None if there is nothing to learn from."""
    ship(rows.sparkSession)
    usable = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    counted = usable.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    grams = written(counted, "ppm-grams")
    langs = sorted(r["lang"] for r in grams.select("lang").distinct().collect())
    if not langs:
        return None
    shallow, two, three = _levels(grams, langs)

    # Contexts in steps of how often they occur. A context's end occurs at least as often, so it is held as well.
    size = (F.size("followers") + 1).alias("size")
    every = two.select(F.lit(2).alias("order"), "context", "total", size).unionByName(three.select(F.lit(3).alias("order"), "context", "total", size))
    ranked = every.groupBy("order", "context").agg(F.sum("total").alias("total"), F.sum("size").alias("size"))
    ranked = ranked.withColumn("step", F.floor(4 * F.log2("total")))
    steps = sorted(((r["step"], r["size"]) for r in ranked.groupBy("step").agg(F.sum("size").alias("size")).collect()), reverse=True)
    room, least = cells // len(langs), None
    for step, values in steps:
        room -= values
        if room < 0:
            break
        least = step
    complete = least == steps[-1][0]

    def often(order: int, table: DataFrame):
        if not complete:
            chosen = ranked.filter((F.col("order") == order) & (F.col("step") >= F.lit(least)))
            table = table.join(chosen.select("context"), "context", "left_semi")
        return table.select("lang", "context", "followers", "nats", "escape").toPandas()

    return Trees(langs, Held(shallow, often(2, two), often(3, three), complete), two, three)


# ---- prediction


def _decided(known: np.ndarray, nats: np.ndarray, langs: list[str]) -> tuple[list[str], np.ndarray]:
    best = nats.argmin(axis=1)
    share = np.exp(nats.min(axis=1, keepdims=True) - nats).sum(axis=1)
    return [langs[b] if k else "und" for b, k in zip(best, known)], np.where(known, 1.0 / share, 0.0)


def _away(spark, grams: DataFrame, trees: Trees) -> DataFrame:
    """(gram, nats array over the languages) of grams whose contexts the tasks don't hold."""

    def by(table: DataFrame, key, value: str, name: str, key_name: str) -> DataFrame:
        entries = F.map_from_entries(F.collect_list(F.struct("lang", value)))
        return table.groupBy(key.alias(key_name)).agg(entries.alias(name))

    def cells(table: DataFrame) -> DataFrame:
        each = table.select("lang", "context", F.explode(F.arrays_zip("followers", "nats")).alias("cell"))
        code = F.shiftleft("context", 8).bitwiseOR(F.col("cell.followers").cast("long"))
        return each.select("lang", code.alias("code"), F.col("cell.nats").alias("nats"))

    low = spark.createDataFrame(
        pa.table({"pair": pa.array(np.arange(65536)), "low": pa.array(list(trees.held.low), pa.list_(pa.float64()))})
    )
    out = grams.select(
        "gram",
        F.shiftright("gram", 8).alias("context3"),
        F.col("gram").bitwiseAND(0xFFFFFF).alias("triple"),
        F.shiftright(F.col("gram").bitwiseAND(0xFFFFFF), 8).alias("context2"),
        F.col("gram").bitwiseAND(0xFFFF).alias("pair"),
    )
    out = out.join(by(cells(trees.three), F.col("code"), "nats", "nats3", "gram"), "gram", "left")
    out = out.join(by(trees.three, F.col("context"), "escape", "escape3", "context3"), "context3", "left")
    out = out.join(by(cells(trees.two), F.col("code"), "nats", "nats2", "triple"), "triple", "left")
    out = out.join(by(trees.two, F.col("context"), "escape", "escape2", "context2"), "context2", "left")
    out = out.join(low, "pair")

    def value(name: str, j):
        return F.element_at(F.col(name), j)

    def one(j):
        short = F.coalesce(value("nats2", j), F.coalesce(value("escape2", j), F.lit(0.0)) + F.get("low", j))
        return F.coalesce(value("nats3", j), F.coalesce(value("escape3", j), F.lit(0.0)) + short)

    numbers = F.array(*[F.lit(j) for j in range(len(trees.langs))])
    return out.select("gram", F.transform(numbers, one).alias("value"))


def predict(docs: DataFrame, trees: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred`` and ``score`` (posterior probability of the shortest code)."""
    spark = docs.sparkSession
    ship(spark)
    id_type = dict(docs.dtypes)[id_col]
    answer = f"`{id_col}` {id_type}, lang_pred string, score double"
    if trees is None:
        return docs.select(id_col, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared, langs = spark.sparkContext.broadcast(trees.held), trees.langs  # bounded by the cells
    answers = [id_col, "lang_pred", "score"]

    def at_once(batches):
        for batch in batches:
            texts = [prepared(t.as_py()) for t in batch.column(1)]
            known = np.array([len(t) > 0 for t in texts], bool)
            nats = [part for _, part, _ in shared.value.score(texts)]
            if nats:
                found, scores = _decided(known, np.concatenate(nats), langs)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(scores)], names=answers)

    if trees.held.complete:
        return docs.select(id_col, text_col).mapInArrow(at_once, answer)

    def in_parts(batches):
        """A row per document with what is held, and rows of (gram, n) that are to be added to it."""
        for batch in batches:
            texts = [prepared(t.as_py()) for t in batch.column(1)]
            for first, nats, (owner, gram, n) in shared.value.score(texts):
                rows, more = np.arange(first, first + len(nats)), len(owner)
                take = pa.array(np.concatenate([rows, first + owner]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(2).take(take),
                        pa.array([len(texts[i]) > 0 for i in rows] + [None] * more, pa.bool_()),
                        pa.array(list(nats) + [None] * more, pa.list_(pa.float64())),
                        pa.array([None] * len(rows) + gram.tolist(), pa.int64()),
                        pa.array([None] * len(rows) + n.tolist(), pa.int64()),
                    ],
                    names=[id_col, "_key", "_known", "_nats", "_gram", "_n"],
                )

    keyed = docs.select(id_col, text_col, F.monotonically_increasing_id().alias("_key"))
    schema = f"`{id_col}` {id_type}, _key long, _known boolean, _nats array<double>, _gram long, _n long"
    parts = written(keyed.mapInArrow(in_parts, schema), "ppm-parts")
    loose = parts.filter("_gram is not null").select("_key", F.col("_gram").alias("gram"), "_n")
    values = _away(spark, loose.select("gram").distinct(), trees)
    added = loose.join(values, "gram").groupBy("_key")
    added = added.agg(F.array(*[F.sum(F.col("_n") * F.get("value", F.lit(j))) for j in range(len(langs))]).alias("_more"))
    whole = parts.filter("_gram is null").join(added, "_key", "left")
    nats = F.when(F.col("_more").isNull(), F.col("_nats")).otherwise(F.zip_with("_nats", "_more", lambda a, b: a + b))

    def decide(batches):
        for batch in batches:
            if batch.num_rows:
                known = np.array(batch.column(1).to_pylist(), bool)
                found, scores = _decided(known, np.array(batch.column(2).to_pylist()), langs)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(scores)], names=answers)

    return whole.select(id_col, "_known", nats.alias("_nats")).mapInArrow(decide, answer)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", cells: int = TABLE_CELLS) -> DataFrame:
    """Learn from the rows that aren't held out (crc32 of the id mod 5 is not 0), predict all rows."""
    fold = id_crc(id_col) % FOLDS
    trees = learn(docs.filter(fold != HELD_OUT), lang_col, text_col, cells)
    held_out = F.coalesce(fold == HELD_OUT, F.lit(False))
    return predict(docs, trees, id_col, text_col).select(id_col, held_out.alias("held_out"), "lang_pred", "score")
