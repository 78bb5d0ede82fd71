"""Connected components of a table of links, by alternating star contractions.

Every node's component is the smallest node that it can reach. Rows stay in Spark;
each round writes its links to the shared folder, so that lineage stays short and a
lost executor costs one round's work at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threshline.llm.common import materialize

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that is not its component's smallest.

    ``links``: columns a and b, in any order and repeated at will.
    """
    pair = F.struct(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = materialize(links.filter("a <> b").select(pair.alias("p")).select("p.u", "p.v").distinct(), "links")
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        now = materialize(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not converge")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(links: DataFrame) -> tuple[int, int]:
    n, total = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return n, total


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
