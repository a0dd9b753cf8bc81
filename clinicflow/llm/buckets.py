"""Links inside buckets of candidates, without all pairs of a large bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicflow.llm.common import written
from clinicflow.llm.components import connected_components

SMALL_BUCKET = 32
LEADERS = 8
ROUNDING = 1e-9
SELDOM = 8
OUTLINE = ["size", "spare", "inside", "outside"]


def with_leaders(members: DataFrame) -> DataFrame:
    """``members`` (bucket, node; distinct) of buckets with several nodes, with size n, score and leader.

    A node's score is the sum of its buckets' sizes; a bucket's leader is its node of highest score. The original
    of a group of near copies shares more with the rest than the copies do, so it leads its buckets.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(members.join(sizes, "bucket").select("bucket", "node", "n"), "members")
    scores = members.groupBy("node").agg(F.sum("n").alias("score"))
    members = members.join(scores, "node")
    leaders = members.groupBy("bucket").agg(F.max_by("node", F.struct("score", "node")).alias("leader"))
    return members.join(leaders, "bucket").select("bucket", "node", "leader", "n", "score")


def bucket_links(
    members: DataFrame,
    judge: Callable[[DataFrame], DataFrame],
    limit: float,
    outline: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Pairs (``u``, ``v``; u > v) of nodes in a common bucket at a distance of at most ``limit``, and their components (node, component).

    ``members``: from ``with_leaders``, written. ``judge`` gets distinct pairs (u, v; u > v) and returns them with their distance
    ``d``, which must be a metric; it may leave out pairs beyond the limit.

    Every node is compared with its bucket's leader. A node that is then in another component than the leader is
    open in this bucket. In a bucket of at most SMALL_BUCKET nodes it is compared with all others of other
    components; in a larger one, the open nodes become leaders in turn (first about LEADERS at a time, then four times
    as many in each round), until each is in the leader's component or has been compared with the whole bucket.
    Pairs whose distances to the bucket's leader differ by more than the limit are left out: by the triangle
    inequality they are further apart than it. So the components are those of all passing pairs. The links are not
    all passing pairs: those between two nodes that other links have put into one component are mostly not asked.

    ``outline`` is for distances of sets (see ``outlines``). It gets the members of the larger buckets that hold open
    nodes, and returns them with their outline and the pairs that share a seldom cell. These are asked first; after
    that, only pairs whose outlines allow a distance within the limit are, and a node that no outline of its
    bucket allows leads no round.
    """
    asked = members.filter("node <> leader").select(F.col("node").alias("u"), F.col("leader").alias("v"))
    judged = written(judge(_pairs(asked)), "judged")
    links = judged.filter(F.col("d") <= limit).select("u", "v")
    members = written(_with_distance(members, judged), "distances")
    component = connected_components(links, "bucket-components")
    marked = written(_marked(members, component), "marked")
    open_ = marked.filter("c <> leader_c")
    unclear = marked.filter(F.col("n") <= SMALL_BUCKET).join(open_.select("bucket").distinct(), "bucket", "left_semi")
    left = unclear.filter("c <> leader_c").select("bucket", F.col("node").alias("u"), F.col("c").alias("cu"), F.col("dl").alias("du"))
    right = unclear.filter("node <> leader").select("bucket", F.col("node").alias("v"), F.col("c").alias("cv"), F.col("dl").alias("dv"))
    near = F.coalesce(F.abs(F.col("du") - F.col("dv")) <= limit + ROUNDING, F.lit(True))
    few = left.join(right, "bucket").filter((F.col("cu") != F.col("cv")) & near).select("u", "v")
    more = written(_passing(judge(_pairs(few)), limit), "judged")
    marked = marked.filter(F.col("n") > SMALL_BUCKET)
    rank, hopeful, possible = F.struct("score", "node"), F.lit(True), F.lit(True)
    if outline is not None:
        crowded = written(marked.join(marked.filter("c <> leader_c").select("bucket").distinct(), "bucket", "left_semi"), "crowded")
        if crowded.isEmpty():
            return _advanced(links, component, more, marked)[:2]
        outlined, close = outline(crowded)
        marked = written(_with_hope(outlined, limit), "outlined")
        more = written(more.unionByName(_passing(judge(_pairs(close)), limit)), "judged")
        rank, hopeful, possible = F.struct((F.col("inside") + F.col("outside")) / F.col("size"), "score", "node"), F.col("hopeful"), _possible(limit)
        marked = marked.join(marked.filter("c <> leader_c").filter(hopeful).select("bucket").distinct(), "bucket", "left_semi")
    links, component, marked = _advanced(links, component, more, marked)
    used, parts = None, LEADERS
    while True:
        open_ = marked.filter("c <> leader_c").filter(hopeful)
        if used is not None:
            open_ = open_.join(used, ["bucket", "node"], "left_anti")
        part = F.pmod(F.xxhash64("node"), F.lit(parts))  # alike in all buckets, so that a pair is asked once
        leaders = open_.groupBy("bucket", part.alias("part")).agg(F.max_by("node", rank).alias("node"))
        kept = [F.col(c).alias(f"{c}_v") for c in OUTLINE if c in open_.columns]
        leaders = leaders.join(open_.select("bucket", "node", F.col("c").alias("cv"), F.col("dl").alias("dv"), *kept), ["bucket", "node"])
        leaders = written(leaders.withColumnRenamed("node", "v").drop("part"), "leaders")
        if leaders.isEmpty():
            return links, component
        near = F.coalesce(F.abs(F.col("dl") - F.col("dv")) <= limit + ROUNDING, F.lit(True))
        asked = marked.filter("node <> leader").join(leaders, "bucket").filter((F.col("c") != F.col("cv")) & near & possible)
        more = written(_passing(judge(_pairs(asked.select(F.col("node").alias("u"), "v"))), limit), "judged")
        # Buckets without an open node are done.
        marked = marked.join(leaders.select("bucket").distinct(), "bucket", "left_semi")
        links, component, marked = _advanced(links, component, more, marked)
        mine = leaders.select("bucket", F.col("v").alias("node"))
        used = mine if used is None else written(used.unionByName(mine), "used")
        parts *= 4


def _advanced(links: DataFrame, component: DataFrame, more: DataFrame, marked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links, components and marked members after ``more`` links."""
    if more.isEmpty():
        return links, component, marked
    links = written(links.unionByName(more).distinct(), "links")
    # The new links join components: nodes are replaced by what they already belong to.
    between = _moved(_moved(more, component, "u"), component, "v")
    joined = connected_components(between, "bucket-components")
    component = written(_joined(component, joined), "bucket-components")
    return links, component, written(_marked(marked.drop("c", "leader_c"), component), "marked")


# ---- outlines


def outlines(crowded: DataFrame, cells: DataFrame, limit: float) -> tuple[DataFrame, DataFrame]:
    """``crowded`` with the outline of each member, and the pairs (u, v) that share a seldom cell and may be within ``limit``.

    ``crowded``: members (bucket, node, leader, dl, c) with the Jaccard distance to the leader; ``cells``: (node, size, spare,
    leads, others): how many cells a node has, how many of them repeat another one, whether it leads a bucket, and its
    distinct cells, without those of one of the leaders unless it leads.

    A cell is seldom if no leader and at most SELDOM nodes hold it. A member's outline is its numbers of other distinct cells
    inside and outside of the bucket's leader. Two members without a common seldom cell share at most the smaller
    number inside and the smaller number outside; two with s of them share s more at most (``_possible``).
    """
    each = written(cells.select("node", "leads", F.explode("others").alias("cell")), "each-cell")
    held = each.groupBy("cell").agg(F.count("*").alias("held"), F.min("node").alias("node"), F.max("leads").alias("leads"))
    seldom = written(held.filter((F.col("held") <= SELDOM) & ~F.col("leads")).drop("leads"), "seldom-cells")
    some = seldom.filter("held > 1").select("cell")
    some = written(each.join(some, "cell").select("node", "cell"), "shared-cells")
    own = seldom.filter("held = 1").select("node").unionByName(some.select("node")).groupBy("node").agg(F.count("*").alias("seldom"))
    shape = cells.select("node", "size", "spare").join(own, "node", "left")
    shape = written(shape.withColumn("seldom", F.coalesce("seldom", F.lit(0))), "shapes")
    lead = shape.select(F.col("node").alias("leader"), F.col("size").alias("size_l"), F.col("spare").alias("spare_l"))
    outlined = crowded.join(shape, "node").join(lead, "leader")
    shared = F.round((F.col("size") + F.col("size_l")) * (1 - F.col("dl")) / (2 - F.col("dl"))) - F.col("spare") - F.col("spare_l")
    distinct = F.col("size") - F.col("spare")
    inside = F.when(F.col("node") == F.col("leader"), distinct).otherwise(shared).cast("long")
    outlined = outlined.withColumn("inside", inside).withColumn("outside", distinct - F.col("seldom") - F.col("inside"))

    ends = crowded.select("node", "c").distinct().join(shape, "node")
    ends = some.join(ends, "node").withColumn("rest", F.col("size") - F.col("spare") - F.col("seldom"))
    left = ends.select("cell", F.col("node").alias("u"), *[F.col(x).alias(f"{x}_u") for x in ("c", "size", "spare", "rest")])
    right = ends.select("cell", F.col("node").alias("v"), *[F.col(x).alias(f"{x}_v") for x in ("c", "size", "spare", "rest")])
    both = left.join(right, "cell").filter((F.col("u") > F.col("v")) & (F.col("c_u") != F.col("c_v")))
    most = F.first(F.least("rest_u", "rest_v") + F.col("spare_u") + F.col("spare_v")) + F.count("*")
    both = both.groupBy("u", "v").agg(most.alias("most"), F.first(F.col("size_u") + F.col("size_v")).alias("sizes"))
    return outlined.drop("seldom", "size_l", "spare_l"), both.filter(F.col("most") + ROUNDING >= _share(limit) * F.col("sizes")).select("u", "v")


def _share(limit: float) -> float:
    """The part of both sizes together that two sets at the distance ``limit`` share."""
    return (1 - limit) / (2 - limit)


def _possible(limit: float) -> Column:
    """Whether the outlines of a member and of a leader (with _v) allow a distance within ``limit``. True for unknown ones."""
    most = F.least("inside", "inside_v") + F.least("outside", "outside_v") + F.col("spare") + F.col("spare_v")
    return F.coalesce(most + ROUNDING >= _share(limit) * (F.col("size") + F.col("size_v")), F.lit(True))


def _with_hope(outlined: DataFrame, limit: float) -> DataFrame:
    """``outlined`` with ``hopeful``: false if the member has too few cells that aren't seldom for any set of its bucket."""
    least = outlined.groupBy("bucket").agg(F.min("size").alias("least"), F.max("spare").alias("most_spare"))
    most = F.col("inside") + F.col("outside") + F.col("spare") + F.col("most_spare")
    hopeful = F.coalesce(most + ROUNDING >= _share(limit) * (F.col("size") + F.col("least")), F.lit(True))
    return outlined.join(least, "bucket").withColumn("hopeful", hopeful).drop("least", "most_spare")


def _pairs(asked: DataFrame) -> DataFrame:
    return asked.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _passing(judged: DataFrame, limit: float) -> DataFrame:
    return judged.filter(F.col("d") <= limit).select("u", "v")


def _with_distance(members: DataFrame, judged: DataFrame) -> DataFrame:
    """``members`` with the distance to the bucket's leader (dl; null where the judge left the pair out)."""
    known = judged.select(F.col("u").alias("x"), F.col("v").alias("y"), "d")
    out = members.withColumn("x", F.greatest("node", "leader")).withColumn("y", F.least("node", "leader"))
    return out.join(known, ["x", "y"], "left").withColumnRenamed("d", "dl").drop("x", "y")


def _moved(pairs: DataFrame, component: DataFrame, end: str) -> DataFrame:
    """``pairs`` with the nodes of one end replaced by their component."""
    of = component.select(F.col("node").alias(end), F.col("component").alias("c"))
    return pairs.join(of, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")


def _joined(component: DataFrame, joined: DataFrame) -> DataFrame:
    """``component`` after its components, or nodes without one, have been joined by ``joined``."""
    to = joined.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = component.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    new = joined.join(component.select("node"), "node", "left_anti")
    return old.unionByName(new)


def _marked(members: DataFrame, component: DataFrame) -> DataFrame:
    """``members`` with the components of the node (c) and of the bucket's leader (leader_c)."""
    own = component.select("node", F.col("component").alias("c"))
    lead = component.select(F.col("node").alias("leader"), F.col("component").alias("leader_c"))
    out = members.join(own, "node", "left").join(lead, "leader", "left")
    return out.withColumn("c", F.coalesce("c", "node")).withColumn("leader_c", F.coalesce("leader_c", "leader"))
