"""Connected components of an edge table, by alternating star contraction.

Each round every node points its neighbours at the smallest node it knows
(large star), then its smaller neighbours at that node too (small star). The
edge table ends as one star per component. Only aggregates and joins on a node
are used: minima are combined map-side, and a node with very many edges is split by
the adaptive skew join. No link or label ever reaches the driver, only one
checksum row per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u != v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (
        moved.unionByName(least.select("u", F.col("m").alias("v")))
        .filter("u != v")
        .distinct()
    )


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node with an edge; ``root`` is the smallest node reachable.

    ``edges`` has columns ``u`` and ``v`` (longs, in any direction, repeats and
    loops allowed; nulls are ignored). An empty table gives an empty result.
    """
    now = cut(edges.select("u", "v").filter("u != v").distinct())
    mark = None
    for _ in range(max_rounds):
        now = cut(_small_star(_large_star(now)))
        row = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if (row[0], row[1]) == mark:
            break
        mark = (row[0], row[1])
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
