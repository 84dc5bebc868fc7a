"""Connected components by alternating large and small stars, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablework.llm.common import stage


def _state(edges: DataFrame):
    row = edges.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component.

    ``edges`` has two columns a and b of one ordered type; loops and repeats are ignored, null ends as well. A hub
    is safe: its minimum is combined before the shuffle and the join back is one that Spark can split. Every round is
    written to the shared folder. The number of rounds is logarithmic in the size of a component.
    """
    now = stage(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before, state = None, _state(now)
    while state != before and state[0]:
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "edges")
        before, state = state, _state(now)
    # converged: every edge leads from a node to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
