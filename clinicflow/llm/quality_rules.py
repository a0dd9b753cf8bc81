"""Quality rules, line first, in built-in functions only.

Each line of a text is judged on its own by three rules:

* punctuation: more than ``SYMBOLS_PER_100_WORDS`` marks such as ``# * $ % & | < > ! ~ ^``
  for 100 words;
* navigation: ``NAV_SEPARATORS`` or more separators (``| » › • · >``) that stand alone between words;
* boilerplate: a phrase of ``BOILERPLATE`` in a line of at most ``BOILERPLATE_WORDS`` words.

Lines that fail go; lines without a word stay as they are. A document is rejected
when its lines that went hold more than ``MAX_LOST_PER_100`` per cent of its word
characters, or when the base rules fail (too short, or too many words inside
8-word windows that the text repeats).

One pass, no shuffle, no Python. Null text counts as text without words (zero
counts, base rules fail, cleaned text empty). Repeated rows are judged
alike. All input columns come back inside the struct column ``row``, so their
names can't clash with those of the measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
LINE_MARK = r"[#*$%&|<>!~^]"
SEPARATOR = r"[ \t][|»›•·>][ \t]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PER_100 = 30
SYMBOLS_PER_100_WORDS = 30
NAV_SEPARATORS = 3
BOILERPLATE_WORDS = 30
MAX_LOST_PER_100 = 30
BOILERPLATE = (
    r"(?i)(cookie policy|we use cookies|privacy policy|terms of (use|service)|all rights reserved|"
    r"enable javascript|javascript is disabled|lorem ipsum|subscribe to our newsletter|"
    r"sign in to continue|log in to continue|skip to (main )?content|back to top)"
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _word_chars(text: Column) -> Column:
    """Code points that are not white space."""
    return F.char_length(text) - _count(text, SPACE)


def line_passes(line: Column) -> Column:
    words = _count(line, WORD)
    punctuation = _count(line, LINE_MARK) * 100 > words * SYMBOLS_PER_100_WORDS
    navigation = _count(line, SEPARATOR) >= NAV_SEPARATORS
    boilerplate = line.rlike(BOILERPLATE) & (words <= BOILERPLATE_WORDS)
    return ~line.rlike(WORD) | ~(punctuation | navigation | boilerplate)


def repeated_words(by_hash: Column) -> Column:
    """Words inside 8-word windows found twice or more.

    ``by_hash``: (hash, position) of the windows in order, null where all hashes differ. A window equal to a
    neighbour in that order is repeated; from their positions in text order the covered words are added up.
    """
    same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
    repeated = F.filter(by_hash, lambda x, i: same(x, F.get(by_hash, i - 1)) | same(x, F.get(by_hash, i + 1)))
    places = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        places,
        start,
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return F.when(by_hash.isNull(), F.lit(0).cast("long")).otherwise(covered)


def apply_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all input columns), the base measures, ``base_failed``, ``kept`` and ``cleaned_text``."""
    text = F.coalesce(F.col("t"), F.lit(""))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("t"))
    out = out.withColumn("t", text)
    out = out.withColumn("w", F.filter(F.split("t", SPACE + "+", -1), lambda x: x != ""))
    out = out.withColumn("n_words", F.size("w").cast("long"))
    out = out.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x))).drop("w")
    windows = F.transform(
        F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("wh", i, WINDOW))
    )
    out = out.withColumn("h", F.when(F.col("n_words") >= WINDOW, windows)).drop("wh")
    in_order = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("o", F.when(F.size(F.array_distinct("h")) < F.size("h"), in_order))
    out = out.withColumn("n_repeat_words", repeated_words(F.col("o"))).drop("h", "o")
    out = out.withColumn("lines", F.split("t", "\n", -1))
    out = out.withColumn("worded", F.filter("lines", lambda x: x.rlike(WORD)))
    out = out.withColumn("cleaned_text", F.array_join(F.filter("lines", line_passes), "\n"))
    out = out.select(
        "row",
        "n_words",
        _word_chars(F.col("t")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOL).cast("long").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        "cleaned_text",
    )
    short = F.col("n_words") < MIN_WORDS
    repetitive = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PER_100
    out = out.withColumn("base_failed", short | repetitive)
    lost = F.col("word_chars") - _word_chars(F.col("cleaned_text"))
    return out.withColumn("kept", ~F.col("base_failed") & (lost * 100 <= F.col("word_chars") * MAX_LOST_PER_100))


def filter_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The kept documents with their cleaned text; all columns as in ``docs``."""
    judged = apply_rules(docs, text_col)
    columns = []
    for c, kind in docs.dtypes:
        if c == text_col:
            columns.append(F.col("cleaned_text").alias(c))
        elif c == chars_col:
            columns.append(F.char_length("cleaned_text").cast(kind).alias(c))
        else:
            columns.append(F.col("row")[c].alias(c))
    # A row or none: a filter would be pushed below the measures and compute them again and again.
    return judged.select(F.inline(F.when(F.col("kept"), F.array(F.struct(*columns)))))
