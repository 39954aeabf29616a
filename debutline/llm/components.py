"""Connected components of a link table by alternating star rounds; all state stays in the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutline.llm.shared import cut_lineage


def _least(rows: DataFrame) -> DataFrame:
    """Each `at` with the least of its own number and its `to`s."""
    return rows.groupBy("at").agg(F.min("to").alias("least")).select("at", F.least("at", "least").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.select(F.col("a").alias("at"), F.col("b").alias("to")).unionAll(links.select(F.col("b").alias("at"), F.col("a").alias("to")))
    moved = both.where("to > at").join(_least(both), "at").select(F.col("to").alias("a"), F.col("least").alias("b"))
    return moved.where("a > b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = links.select(F.col("a").alias("at"), F.col("b").alias("to"))
    least = _least(down)
    moved = down.join(least, "at").select(F.col("to").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(least.select(F.col("at").alias("a"), F.col("least").alias("b"))).where("a > b").distinct()


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(links.agg(F.count("*"), F.sum(mixed)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: whole numbers) that is not itself the least of its component.

    Rounds stop when the link table, which then is one star per component, no longer changes. Each round is written in the
    shared folder, so a lost executor repeats one round at most. Nulls and links of a node to itself say nothing.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = cut_lineage(links, "links")
    state = _state(links)
    while state[0]:
        links = cut_lineage(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
