"""Near-duplicate lines by a segment-partition edit join, in built-in functions only.

Two lines are linked if their edit distance (insertions, deletions, replacements
of code points) is at most ``THRESHOLD``. Distinct lines of at least ``MIN_CHARS``
code points are cut into THRESHOLD + 1 even segments; of two linked lines the
shorter one has a segment that stands unchanged in the longer one, near its own
place. So each line is put in the index by its segments (length, number,
content), and probes the index of its own length and of the THRESHOLD shorter
ones with the substrings at the places that a segment can have moved to.
Candidates are verified with a banded bit-parallel automaton: for each error
count a word of 2 * THRESHOLD + 1 bits holds the diagonals that can be reached.

Segments held by more than ``HOT`` lines would pair all of them. Lines that come
upon such a segment are linked in another way: code points are dealt into
``GROUPS`` groups, and an edit changes the sequence of code points left of at
most two groups. So two linked lines agree in GROUPS - 2 * THRESHOLD of these
sequences; lines are put into a bucket for each such set of groups, and all pairs
that agree in one are verified, in the first bucket they share. Buckets are dealt
into blocks of about ``BLOCK`` lines, so a large one is split over tasks.

Classes are the connected components of the links. The first line of a class
(smallest document id, then line number) represents it, the others are removed.
Shorter lines are only ever equal to others. Lines without a word are in no
class and never removed. Null texts have no lines. A null id comes after all
others. Rows that repeat an id repeat its line places: each place is kept or removed as
one. Only the id and the text column are read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicflow.llm.common import written
from clinicflow.llm.components import connected_components

THRESHOLD = 2
MIN_CHARS = 24
HOT = 32
GROUPS = 6
BLOCK = 64
BROADCAST_IDS = 500_000
WORDED = r"[^\x20\x09-\x0D]"
NULL_ID = 1 << 62
CROWD = -1
LINE_ROOM = 1 << 31


# ---- segments


def own_places(threshold: int) -> list[tuple[int, int, int]]:
    """(gap, number, shift) of the segments of a line itself."""
    return [(0, i, 0) for i in range(threshold + 1)]


def moved_places(threshold: int) -> list[tuple[int, int, int]]:
    """(gap, number, shift) of the places at which a segment of a line shorter by ``gap`` can stand, but for ``own_places``."""
    found = []
    for gap in range(threshold + 1):
        for i in range(threshold + 1):
            low, high = max(-i, gap - (threshold - i)), min(i, gap + (threshold - i))
            found += [(gap, i, shift) for shift in range(low, high + 1) if gap or shift]
    return found


def code_units(line: Column) -> Column:
    """Four bytes for each code point: a part of it is found without reading what stands before it."""
    return F.encode(line, "UTF-32")


def segment_keys(line: Column, length: Column, threshold: int, places: list[tuple[int, int, int]]) -> Column:
    """Keys (length, number, content) of the substrings at ``places``; null where one would leave the line.

    Segments are even, the last ones hold what doesn't divide. One small expression runs over the list of places:
    written out for each of them, the code grows too large for the JVM to compile.
    """
    parts = threshold + 1
    table = F.array(*[F.struct(F.lit(gap).alias("gap"), F.lit(i).alias("i"), F.lit(shift).alias("shift")) for gap, i, shift in places])

    def cut(p: Column) -> Column:
        other = length - p["gap"]
        base, short = F.floor(other / parts).cast("int"), parts - other % parts
        at = base * p["i"] + F.greatest(F.lit(0), p["i"] - short) + p["shift"]
        return F.struct(other.cast("int").alias("other"), p["i"].alias("i"), at.cast("int").alias("at"), (base + (p["i"] >= short).cast("int")).alias("size"))

    def key(units: Column, c: Column) -> Column:
        inside = (c["at"] >= 0) & (c["at"] + c["size"] <= length)
        return F.when(inside, F.xxhash64(c["other"], c["i"], units.substr(c["at"] * 4 + 1, c["size"] * 4)))

    # The line is encoded once, as the variable of the outer step.
    return F.get(F.transform(F.array(code_units(line)), lambda units: F.transform(F.transform(table, cut), lambda c: key(units, c))), F.lit(0))


# ---- verification


def within_distance(left: Column, right: Column, threshold: int) -> Column:
    """Whether two arrays of code points are at most ``threshold`` edits apart.

    After each code point of ``right``, bit k of word e says that, with e edits or fewer, the place k - threshold
    code points further on in ``left`` has been reached. All diagonals of the band advance in one step.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    bit = lambda c, j, k: F.when(F.get(left, j + (k - threshold)) == c, F.lit(1 << k)).otherwise(F.lit(0))
    matches = F.transform(right, lambda c, j: sum((bit(c, j, k) for k in range(1, width)), bit(c, j, 0)))
    begin = [1 << threshold]
    for _ in range(threshold):
        begin.append(begin[-1] | (begin[-1] << 1) & full)

    def step(state: Column, match: Column) -> Column:
        words = [state["w0"].bitwiseAND(match)]
        for e in range(1, threshold + 1):
            old, before = state[f"w{e}"], state[f"w{e - 1}"]
            same = old.bitwiseAND(match)
            replaced_or_inserted = before.bitwiseOR(F.shiftright(before, 1))
            deleted = F.shiftleft(words[-1], 1).bitwiseAND(F.lit(full))
            words.append(same.bitwiseOR(replaced_or_inserted).bitwiseOR(deleted))
        return F.struct(*[w.alias(f"w{e}") for e, w in enumerate(words)])

    start = F.struct(*[F.lit(w).alias(f"w{e}") for e, w in enumerate(begin)])
    reached = F.aggregate(matches, start, step, lambda s: s[f"w{threshold}"])
    gap = F.size(left) - F.size(right)
    target = F.shiftleft(F.lit(1), threshold) if threshold == 0 else F.pow(F.lit(2), gap + threshold).cast("int")
    return (F.abs(gap) <= threshold) & (reached.bitwiseAND(target) != 0)


def code_points(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


# ---- the join


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per worded line: id, ``line_no`` (from 0), ``class_id`` and ``class_line`` (the place of the class's first line), ``n_links`` (verified links of its text to different texts) and ``removed``."""
    spread = docs.select(F.col(f"`{id_col}`").alias("id"), F.posexplode(F.split(F.col(f"`{text_col}`"), "\n", -1)).alias("line_no", "line"))
    place = F.coalesce(F.col("id"), F.lit(NULL_ID)).cast("decimal(38,0)") * LINE_ROOM + F.col("line_no")
    spread = spread.filter(F.col("line").rlike(WORDED)).withColumn("place", place.cast("decimal(38,0)"))
    lines = (
        spread.groupBy("line")
        .agg(F.min("place").alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), "line", F.char_length("line").alias("n"), "first", *_names())
    )
    own = F.when(F.col("n") >= MIN_CHARS, segment_keys(F.col("line"), F.col("n"), threshold, own_places(threshold)))
    lines = written(lines.withColumn("own", own), "lines")
    links = written(_links(lines.filter(F.col("n") >= MIN_CHARS).select("node", "line", "n", "own"), threshold), "line-links")
    component = connected_components(links, "line-components")
    degree = links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node"))).groupBy("node").agg(F.count("*").alias("n_links"))
    linked = lines.select("node", "first", "h1", "h2").join(component, "node")
    names = linked.groupBy("component").agg(F.min("first").alias("class_first"))
    linked = linked.join(names, "component").join(degree, "node").select("h1", "h2", "class_first", "n_links")
    # Places meet their line by its two hashes, not by its text. The first line of a class is the least of its lines.
    known = lines.select("h1", "h2", F.col("first").alias("class_first"), F.lit(0).cast("long").alias("n_links")).unionByName(linked)
    known = known.groupBy("h1", "h2").agg(F.min("class_first").alias("class_first"), F.max("n_links").alias("n_links"))
    mine = spread.select("id", "line_no", "place", *_names()).join(known, ["h1", "h2"])
    class_id = F.expr(f"class_first div {LINE_ROOM}L")
    return mine.select(
        F.col("id").alias(id_col),
        "line_no",
        F.when(class_id != NULL_ID, class_id).alias("class_id"),
        (F.col("class_first") % LINE_ROOM).cast("int").alias("class_line"),
        F.col("n_links").cast("long").alias("n_links"),
        (F.col("place") != F.col("class_first")).alias("removed"),
    )


def _names() -> list[Column]:
    """Two independent hashes of a line."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2")]


def _links(lines: DataFrame, threshold: int) -> DataFrame:
    """Verified pairs (u, v; u > v) of different lines (node, line, n, and the keys of their segments, own)."""
    indexed = lines.select("node", F.explode("own").alias("key"))
    hot = written(indexed.groupBy("key").agg(F.count("*").alias("held")).filter(F.col("held") > HOT).select("key"), "hot-segments")
    # Lines that hold a hot segment find each other in the crowd: here they only meet the other lines.
    holders = written(indexed.join(hot, "key", "left_semi").select("node").distinct(), "hot-holders")
    marked = lines.join(holders.withColumn("crowd", F.lit(True)), "node", "left").withColumn("crowd", F.coalesce("crowd", F.lit(False)))
    indexed = marked.select("node", "crowd", F.explode("own").alias("key"))
    probes = F.concat("own", segment_keys(F.col("line"), F.col("n"), threshold, moved_places(threshold)))
    probing = marked.select(F.col("node").alias("other"), F.col("crowd").alias("other_crowd"), F.explode(probes).alias("key")).filter("key is not null")
    # Where a segment isn't hot, a probe meets at most HOT lines; a hot one is met once, as CROWD.
    # Lines probe their own segments too, so all lines that hold a hot segment meet it.
    crowd = hot.select("key", F.lit(CROWD).cast("long").alias("node"), F.lit(False).alias("crowd"))
    held = indexed.join(hot, "key", "left_anti").select("key", "node", "crowd").unionByName(crowd)
    met = held.join(probing, "key").filter((F.col("node") != F.col("other")) & ~(F.col("crowd") & F.col("other_crowd")))
    met = written(met.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).distinct(), "line-pairs")
    pairs, touched = met.filter(F.col("v") != CROWD), met.filter(F.col("v") == CROWD).select(F.col("u").alias("node"))
    ends = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    found = _verified(pairs, _lines_of(lines, ends), threshold)
    if touched.isEmpty():
        return found
    return found.unionByName(_crowd_links(_lines_of(lines, touched), threshold)).distinct()


def _crowd_links(crowded: DataFrame, threshold: int) -> DataFrame:
    """Verified pairs (u, v; u > v) of the lines that meet hot segments: every pair that shares a bucket, once."""
    keyed = written(crowded.select("node", "line", group_keys(code_points(F.col("line")), threshold).alias("keys")), "crowd")
    members = keyed.select("node", F.posexplode("keys").alias("number", "bucket"))
    blocks = F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")
    sizes = members.groupBy("number", "bucket").agg(F.count("*").alias("held")).filter("held > 1").select("number", "bucket", blocks)
    # Each block meets itself and the blocks after it.
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks").cast("long")).cast("int")
    members = members.join(sizes, ["number", "bucket"]).withColumn("own", own).join(keyed, "node")
    left = members.select("number", "bucket", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"), _end("a"))
    right = members.select("number", "bucket", F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"), _end("b"))
    both = left.join(right, ["number", "bucket", "i", "j"]).filter((F.col("i") < F.col("j")) | (F.col("a.node") > F.col("b.node")))
    both = both.filter(F.abs(F.char_length("a.line") - F.char_length("b.line")) <= threshold)
    shared = F.zip_with("a.keys", "b.keys", lambda x, y: x == y)
    both = both.filter(F.array_position(shared, True) == F.col("number") + 1)
    ends = [F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")]
    return _near(both.select(*ends, F.col("a.line").alias("a"), F.col("b.line").alias("b")), threshold)


def _end(name: str) -> Column:
    return F.struct("node", "line", "keys").alias(name)


def group_keys(points: Column, threshold: int) -> Column:
    """A key for each set of GROUPS - 2 * threshold groups: the hash of the code points of each group, in order."""
    part = lambda g: F.xxhash64(F.filter(points, lambda c: F.pmod(F.xxhash64(c, F.lit("group")), F.lit(GROUPS)) == g))
    left = [part(g) for g in range(GROUPS)]
    return F.array(*[F.xxhash64(F.lit(k), *[left[g] for g in s]) for k, s in enumerate(combinations(range(GROUPS), GROUPS - 2 * threshold))])


def _lines_of(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, line) of some lines, written. Their ids are broadcast if they are few, else joined by shuffling."""
    nodes = written(nodes, "line-ids")
    few = nodes.count() <= BROADCAST_IDS
    own = lines.select("node", "line").join(F.broadcast(nodes) if few else nodes, "node", "left_semi")
    return written(own, "candidate-lines")


def _verified(pairs: DataFrame, lines: DataFrame, threshold: int) -> DataFrame:
    both = pairs.join(lines.select(F.col("node").alias("u"), F.col("line").alias("a")), "u")
    both = both.join(lines.select(F.col("node").alias("v"), F.col("line").alias("b")), "v")
    return _near(both.filter(F.abs(F.char_length("a") - F.char_length("b")) <= threshold), threshold)


def plausible(left: Column, right: Column, threshold: int) -> Column:
    """True for every pair of lines within ``threshold`` edits, and few others.

    The shorter line is cut into 2 * threshold + 1 pieces; an edit touches one of them at most, so
    threshold + 1 pieces or more stand unchanged somewhere in the longer line.
    """
    short = F.when(F.char_length(left) <= F.char_length(right), left).otherwise(right)
    long = F.when(F.char_length(left) <= F.char_length(right), right).otherwise(left)
    n, parts = F.char_length(short), 2 * threshold + 1
    cut = [F.floor(n * i / parts).cast("int") for i in range(parts + 1)]
    found = [F.contains(long, short.substr(a + 1, b - a)).cast("int") for a, b in zip(cut, cut[1:])]
    return sum(found[1:], found[0]) > threshold


def _near(both: DataFrame, threshold: int) -> DataFrame:
    """The pairs (u, v) of (u, v, a, b) whose lines a and b are near."""
    both = both.filter(plausible(F.col("a"), F.col("b"), threshold))
    # Spark's own banded distance takes the far pairs out; the automaton reads the few that are left.
    both = both.filter(F.levenshtein("a", "b", threshold) >= 0)
    both = both.select("u", "v", code_points(F.col("a")).alias("a"), code_points(F.col("b")).alias("b"))
    # A row or none: a filter would be pushed below the code points and take them apart again at every step.
    near = within_distance(F.col("a"), F.col("b"), threshold)
    return both.select(F.inline(F.when(near, F.array(F.struct("u", "v")))))


def remove_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the removed lines taken out of the texts; documents that lose all their worded lines go.

    All columns as in ``docs``; documents without a worded line or without an id stay as they are.
    """
    classes = written(line_classes(docs, id_col, text_col), "line-classes")
    removed = classes.filter(F.col("removed") & F.col(id_col).isNotNull())
    gone = removed.groupBy(F.col(id_col).alias("_id")).agg(F.sort_array(F.collect_set("line_no")).alias("_gone"))
    joined = docs.withColumn("_id", F.col(f"`{id_col}`")).join(gone, "_id", "left")
    lines = F.split(F.col(f"`{text_col}`"), "\n", -1)
    # Removed line numbers are sorted and unique: membership by set difference of positions, not by scanning them for each line.
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    left = F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")
    cut = F.when(F.col("_gone").isNull(), F.col(f"`{text_col}`")).otherwise(left)
    joined = joined.withColumn("_left", cut).filter(F.col("_gone").isNull() | F.col("_left").rlike(WORDED))
    columns = []
    for c, kind in docs.dtypes:
        if c == text_col:
            columns.append(F.col("_left").alias(c))
        elif c == chars_col:
            columns.append(F.when(F.col("_gone").isNull(), F.col(f"`{c}`")).otherwise(F.char_length("_left")).cast(kind).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return joined.select(*columns)
