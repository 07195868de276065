"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import stored

MAX_ROUNDS = 100


def _arcs(edges: DataFrame) -> DataFrame:
    """Each edge in both directions."""
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return edges.select(F.explode(ends).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each neighbour above a node to the least of the node and its neighbours."""
    arcs = _arcs(edges)
    least = arcs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return arcs.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each neighbour below a node, and the node, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").dropDuplicates(["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b): the component is its least node.

    Steps end in a written table each.  When nothing changes, every edge leads from a node to the least of its component.
    A node is never gathered with its neighbours, so a star of any size takes no more memory than a pair.
    """
    now = stored(_clean(edges.select("a", "b")), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        now = stored(_clean(_small_star(_clean(_large_star(now)))), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"Components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).dropDuplicates(["node"])
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
