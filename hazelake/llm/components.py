"""Connected components of links between rows, by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import checkpointed


def _to_smallest(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Hang the neighbours of every node on the smallest of them.

    ``edges(u, v)`` has each edge once with u > v. The large step looks at all neighbours of a node and moves the larger
    ones, the small step looks at the smaller ones and moves those and the node itself. The minimum of a node is
    aggregated and joined back, so the neighbours of a hot node need not meet in one task.
    """
    if larger_only:
        seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = seen.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links(a, b)`` but the roots: the smallest node that links reach from it.

    Links may be repeated, in either direction or from a node to itself; null ends link nothing.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = checkpointed(pairs.distinct())
    state = _state(edges)
    while state[0]:
        edges = checkpointed(_to_smallest(_to_smallest(edges, True), False))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
