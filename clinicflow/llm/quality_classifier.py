"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each document is described by statistics of its whole text (lengths, variety of
words and lines, shares of capitals, digits, symbols, line ends), computed with
built-in functions. Random cosine features approximate a Gaussian kernel over
the standardised statistics. Every partition of the labelled rows adds up its
part of the normal equations; the parts are summed by Spark and the small system
is solved with a ridge penalty. Raw scores of a separate calibration part are
counted into bins, and pooled adjacent violators turn them into an isotonic
mapping to 0..1, joined by straight lines.

Labels are learnt only from rows whose crc32(id as text) mod 4 is not 2: 0 and 1
for the regression, 3 for the calibration. If there are more than ``TRAIN_ROWS``
labelled rows, those with the smallest hash fractions are used (a bounded sample;
the bound is a parameter). Labels, languages, sources and ids are no inputs of a score.

Null text counts as empty; empty texts get a score like others. Labels that are
null, repeated or without document change nothing or count as often as given.
Without labels of both kinds every score is their mean (0.5 if there are none).
All input columns come back inside the struct column ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.llm.common import id_crc, ship, written

TRAIN_ROWS = 200_000
SUM_PARTITIONS = 16
FEATURES = 192
WIDTH = 3.0
RIDGE = 1e-3
SEED = 20
BINS = 2000
LOW, HIGH = -0.5, 1.5
ACCEPT = 0.7
FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3

STATISTICS = [
    "log_words",
    "word_length",
    "word_variety",
    "same_word_runs",
    "capitals",
    "digits",
    "symbols",
    "exclamations",
    "lone_marks",
    "letters",
    "line_variety",
    "line_ends",
    "line_words",
]


def statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, or all) and ``x``, the statistics of the text as an array of doubles."""
    columns = docs.columns if keep is None else keep
    out = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t")
    )
    count = lambda pattern: F.regexp_count("t", F.lit(pattern)).cast("double")
    out = out.withColumn("w", F.transform(F.filter(F.split("t", r"[\x20\x09-\x0D]+", -1), lambda x: x != ""), lambda x: F.xxhash64(x)))
    out = out.withColumn("lines", F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    out = out.withColumn("n", F.size("w").cast("double")).withColumn("chars", F.char_length("t") - count(r"[\x20\x09-\x0D]"))
    words, chars, lines = F.greatest("n", F.lit(1.0)), F.greatest("chars", F.lit(1.0)), F.greatest(F.size("lines"), F.lit(1))
    same = F.size(F.filter("w", lambda x, i: x == F.get("w", i - 1)))
    ended = F.size(F.filter("lines", lambda x: x.rlike(r"[.!?…\"»”)]\s*$")))
    measures = [
        F.log1p("n"),
        F.col("chars") / words,
        F.size(F.array_distinct("w")) / words,
        same / words,
        count(r"\p{Lu}") / chars,
        count(r"\p{N}") / chars,
        count(r"[#*$%&|<>^~_={}\\]") / words,
        count(r"!") / words,
        count(r"(?<=[\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D](?=[\x20\x09-\x0D])") / words,
        count(r"\p{L}") / chars,
        F.size(F.array_distinct("lines")) / lines,
        ended / lines,
        F.log1p(F.col("n") / lines),
    ]
    return out.select("row", F.array(*[m.cast("double") for m in measures]).alias("x"))


class Model:
    """Standardisation, random projection, ridge weights and the calibration curve."""

    def __init__(self, mean, scale, prior: float):
        rnd = np.random.default_rng(SEED)
        self.mean, self.scale, self.prior = mean, scale, prior
        self.directions = rnd.normal(size=(len(mean), FEATURES)) / WIDTH
        self.phases = rnd.uniform(0, 2 * np.pi, FEATURES)
        self.weights = None
        self.curve: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        cosines = np.cos(z @ self.directions + self.phases) * np.sqrt(2.0 / FEATURES)
        return np.hstack([cosines, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        raw = self.raw(x)
        if self.curve is None:
            return np.clip(raw, 0, 1)
        return np.clip(np.interp(raw, *self.curve), 0, 1)


def isotonic(places: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators over ordered bins: block centres and block means, for straight lines between."""
    blocks: list[list[float]] = []  # count, label sum, place sum
    for place, n, s in zip(places, counts, sums):
        blocks.append([float(n), float(s), float(place) * float(n)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n1, s1, p1 = blocks.pop()
            blocks[-1][0] += n1
            blocks[-1][1] += s1
            blocks[-1][2] += p1
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def fit(described: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from the rows of ``labels`` (id, label) that have a row in ``described`` (of ``statistics``)."""
    ship(described.sparkSession)
    usable = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    usable = usable.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS
    usable = usable.withColumn("fold", fold).filter(F.col("fold") != HELD_OUT)
    total = usable.count()
    if total > train_rows:
        share = F.pmod(F.xxhash64("id", F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
        usable = usable.filter(share < train_rows / total)
    rows = described.select(F.col("row")[id_col].alias("id"), "x").join(usable, "id").select("fold", "y", "x")
    rows = written(rows, "quality-train")
    ends = rows.agg(
        F.count("*").alias("n"),
        F.avg("y").alias("prior"),
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(STATISTICS))],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(len(STATISTICS))],
    ).first()
    if not ends["n"]:
        return Model(np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)), 0.5)
    mean = np.array([ends[f"m{i}"] for i in range(len(STATISTICS))])
    scale = np.array([ends[f"s{i}"] for i in range(len(STATISTICS))])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), float(ends["prior"]))
    if model.prior in (0.0, 1.0):
        return model

    def partial(batches):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = model.features(_matrix(batch.column(1)))
            y = batch.column(0).to_numpy(zero_copy_only=False)
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ y
        rows_ = pa.array(np.arange(FEATURES + 1), pa.int32())
        yield pa.RecordBatch.from_arrays([rows_, pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    fitting = rows.filter(F.col("fold") != CALIBRATION).select("y", "x").repartition(SUM_PARTITIONS)
    sums = (
        fitting.mapInArrow(partial, "i int, sums array<double>")
        .select("i", F.posexplode("sums").alias("j", "v"))
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .toPandas()
    )
    system = np.zeros((FEATURES + 1, FEATURES + 2))
    system[sums["i"], sums["j"]] = sums["v"]
    gram, right = system[:, :-1], system[:, -1]
    penalty = RIDGE * max(gram[-1, -1], 1.0) * np.eye(FEATURES + 1)
    penalty[-1, -1] = 0
    model.weights = np.linalg.solve(gram + penalty / FEATURES, right)

    def binned(batches):
        for batch in batches:
            raw = model.raw(_matrix(batch.column(1)))
            number = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(number), batch.column(0)], names=["bin", "y"])

    bins = (
        rows.filter(F.col("fold") == CALIBRATION)
        .select("y", "x")
        .mapInArrow(binned, "bin int, y double")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum("y").alias("s"))
        .toPandas()
        .sort_values("bin")
    )
    if len(bins):
        places = LOW + (bins["bin"].to_numpy() + 0.5) * (HIGH - LOW) / BINS
        model.curve = isotonic(places, bins["n"].to_numpy(), bins["s"].to_numpy())
    return model


def score(described: DataFrame, model: Model) -> DataFrame:
    """``row``, ``score`` (0..1) and ``predicted`` (1 if the score is at least ACCEPT)."""
    ship(described.sparkSession)
    row_type = described.schema["row"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            values = model.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["row", "score"])

    scored = described.select("row", "x").mapInArrow(run, f"row {row_type}, score double")
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``score``, ``predicted``."""
    described = written(statistics(docs, text_col, [id_col]), "statistics")
    model = fit(described, labels, id_col)
    return score(described, model).select(
        F.col("row")[id_col].alias(id_col),
        F.coalesce(id_crc(f"row.{id_col}") % FOLDS == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )


def keep_accepted(docs: DataFrame, learn_from: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that a model learnt from ``learn_from`` accepts, with all their columns."""
    model = fit(statistics(learn_from, text_col, [id_col]), labels, id_col)
    return score(statistics(docs, text_col), model).filter("predicted = 1").select("row.*")
