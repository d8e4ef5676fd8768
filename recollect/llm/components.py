"""Connected components of a table of links, without gathering links anywhere.

Alternating large-star and small-star steps (Kiveris et al., 2014): every step replaces links by
links to the smallest neighbour, until each component is a star around its smallest node. Each step
is an aggregation and a join, both on tables that were written, so Spark can split a hub's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.session import materialise


def _smallest(links: DataFrame) -> DataFrame:
    """For every `u`, the smallest of `u` and its neighbours `v`."""
    return links.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialise(_smallest(both), "large-star")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = materialise(_smallest(links), "small-star")
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """`(node, component)` of every node of `links (u, v)`; a component is its smallest node.

    Rows with a null, and links of a node to itself, are ignored. Each round writes the links, which
    never become more, and compares their count and hash sum with those of the round before.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = materialise(ordered.distinct(), "links")
    before = _state(links)
    while before[0]:
        stars = materialise(_large_star(links).where("u <> v").distinct(), "stars")
        links = materialise(_small_star(stars).where("u <> v").distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    hubs = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(hubs)
