"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.llm.tables import drop, stored


def _state(edges: DataFrame) -> tuple:
    # Links are distinct, so count and xor of their hashes tell one set from another.
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def handed(links: DataFrame, least: DataFrame) -> DataFrame:
    """Each neighbour ``v`` of a node ``u`` linked to the least that ``u`` knows, in ``least(u, m)``.

    ``least`` is a written table: next to a sum on ``u`` the join would take over the sum's
    layout, in which all links of a node are one partition. This one can be split.
    """
    return links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node in ``links(u, v)``; root is the least node reachable.

    Alternates large-star and small-star steps: every node hands its larger (then its
    smaller) neighbours to the least one it knows. The number of rounds is logarithmic in
    the longest chain. Each step is written out, so a lost executor costs one step, and
    dropped when the next round is. A node with many links is one key of a sum, which
    combines before its shuffle, and of a join that can be split.
    """
    edges = (
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )
    edges = stored(edges, "links")
    before, now = None, _state(edges)
    while before != now:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        least = stored(least, "least")
        large = stored(handed(both.where("v > u"), least).distinct(), "large")
        smaller = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = handed(large, smaller).union(smaller.select("u", F.col("m").alias("v")))
        old, edges = edges, stored(small.distinct(), "links")
        drop(old, least, large, smaller)
        before, now = now, _state(edges)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
