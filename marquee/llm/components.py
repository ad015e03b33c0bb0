"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialise


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of longs -> (node, root): the smallest node of its component.

    Nodes that are roots themselves are left out. Minima are aggregated before the shuffle and
    each round is stored in the shared folder, so neither a star with many rays nor a lost
    executor matters. The number of rounds grows with the logarithm of the longest path.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    links = materialise(links, "links")
    state = _state(links)
    while state[0]:
        links = materialise(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
