"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("m").alias("a"), "b")
        .filter("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("m").alias("a"), "b")
    return moved.union(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).filter(
        "a <> b"
    ).distinct()


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free digest, to see when nothing moves any more."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges(a, b)``: root is the smallest node that
    can be reached. Loops and repeated edges are allowed; nodes without an edge to
    another node are absent. Every round is a table on the shared folder; hubs meet
    a one-row side in the joins, which can be split."""
    state = None
    now = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while True:
        now = stored(_small_star(_large_star(now)), "stars")
        before, state = state, _state(now)
        if state == before or not state[0]:
            break
    return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
