"""Connected components of a graph that only executors hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import settled


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star algorithm on (a, b) links.

    The large star hangs the greater neighbours of each node on the smallest
    node around it, the small star the smaller ones.
    """
    if large:
        sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")).withColumnRenamed("a", "node")
    hung = sides.join(least, sides["a"] == least["node"])
    if large:
        moved = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = hung.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def _state(links: DataFrame) -> tuple:
    """Equal before and after a round only if the round changed nothing (but for a hash collision)."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root): for each node of the links (a, b), the smallest node it reaches.

    Rounds of a large and a small star, about as many as the logarithm of the
    number of nodes; each round is checkpointed. Links may repeat and may join
    a node with itself; a node with no other link is left out.
    """
    links = settled(links.where(F.col("a") != F.col("b")).distinct())
    state = _state(links)
    while state[0]:
        links = settled(_star(_star(links, True), False))
        before, state = state, _state(links)
        if before == state:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
