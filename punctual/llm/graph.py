"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.session import materialize

# A round at least halves the depth of what is left; 60 rounds reach past any table.
MOST_ROUNDS = 60


def _mark(links: DataFrame) -> tuple:
    """Count and checksum, to see whether a round changed anything."""
    return tuple(links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first())


def _outward(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest around the node."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return (
        both.filter("b > a").join(least, "a")
        .select(F.col("least").alias("a"), "b").filter("a < b").distinct()
    )


def _inward(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    down = links.join(least, "b")
    return (
        down.select(F.col("least").alias("a"), F.col("a").alias("b"))
        .unionByName(least.select(F.col("least").alias("a"), "b"))
        .filter("a < b").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` that is not a root itself.

    ``a`` and ``b`` are integers; ``root`` is the smallest node that can be reached.
    Nulls and loops link nothing. Two kinds of rounds alternate until the links are
    stars around the roots. A round reads and writes as many rows as there are links,
    however many of them meet in one node; only counts come to the driver.
    """
    sound = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    sound = sound.filter("a is not null and b is not null and a < b").distinct()
    current = materialize(sound, "links")
    before = _mark(current)
    if not before[0]:
        return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
    for _ in range(MOST_ROUNDS):
        current = materialize(_inward(_outward(current)), "links")
        after = _mark(current)
        if after == before:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = after
    raise RuntimeError("the components did not settle")
