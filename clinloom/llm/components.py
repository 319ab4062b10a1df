"""Connected components by alternating large-star and small-star.

Each round is two aggregations (smallest neighbour of each node) with joins back, never a collected neighbour list, so a
node with any number of links stays splittable. Rounds are written to the shared folder; the loop ends when a round
changes no link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.shared import store


def _lowest(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def large_star(links: DataFrame) -> DataFrame:
    """Links (u > v): every larger neighbour of a node is linked to the smallest one around it."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_lowest(both), "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") > F.col("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Links (u > v): the smaller neighbours of a node, and itself, are linked to the smallest of them."""
    lowest = _lowest(links)
    moved = links.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") > F.col("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with a link; a component is named after its smallest node.

    Links with a null end and loops are left out; repeated links count once. No links give no rows.
    """
    ordered = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = store(ordered.distinct(), "links")
    state = _state(current)
    while True:
        current = store(small_star(large_star(current)), "links")
        state, before = _state(current), state
        if state == before:
            break
    named = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return named.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(links: DataFrame) -> tuple:
    """Count and checksum of a set of links: two numbers, however many links there are."""
    hashed: Column = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(links.agg(F.count("*"), F.sum(hashed)).first())
