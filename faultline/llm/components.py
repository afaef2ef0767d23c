"""Connected components of a graph given by its links, as a distributed union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _state(links: DataFrame) -> tuple:
    """Changes whenever the set of links does."""
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the node's smallest neighbour."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    root = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return (
        both.join(root, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are hung on the smallest of them."""
    root = links.groupBy("u").agg(F.min("v").alias("m"))
    hung = links.join(root, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(root.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that has a link; root is the smallest node reachable.

    ``links`` holds two columns of long, one row per link, in any direction and
    any number of times; rows with a null or with equal ends say nothing. The
    two star steps alternate until nothing changes, which takes a number of
    rounds that grows with the logarithm of the longest path. Every round is
    written to the shared folder, so its lineage is short; only two sums per
    round reach the driver. An empty input gives an empty result.
    """
    a, b = (F.col(c) for c in links.columns)
    links = stage(links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = _state(links)
    while before[0]:
        links = stage(_small_star(_large_star(links)))
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
