"""Connected components of an edge table, by alternating stars.

Every round joins each edge with the smallest neighbour of its end (large star, then small star) and replaces it by an
edge to that neighbour. Edges never multiply, a star of any size is finished after one round, and the number of rounds
grows with the logarithm of the longest path. Rounds are written to the shared folder, so that a lost executor costs a
task of one round; the driver sees a count and a checksum only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.sources.staging import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge to another node.

    Edges have no direction; repeated edges, loops and edges with a NULL end count for nothing. No edges, no rows.
    """
    now = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
        .distinct(),
        "components",
    )
    mark = _mark(now)
    while mark[0]:
        now = stage(_small_star(_large_star(now)), "components")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of every node to its smallest neighbour or to itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u").where("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of every node, and the node, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return linked.union(least).distinct()
