"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicflow.llm.common import written


def connected_components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(``node``, ``component``) for every node of ``edges`` (``u`` long, ``v`` long).

    The component is its smallest node. Every step is grouping and joining on
    nodes with the minimum combined before the shuffle, and is written to the
    shared checkpoint folder; nothing is collected but two checksums a step.
    Loops and repeated edges do no harm; null ends are left out.
    """
    edges = written(
        edges.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        tag,
    )
    seen = _checksum(edges)
    while seen[0]:
        edges = written(_small_star(_large_star(edges)), tag)
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    # A star for each component: every edge leads to the smallest node.
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    hubs = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(hubs)


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours are tied to the smallest node of the neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours and the node itself are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
