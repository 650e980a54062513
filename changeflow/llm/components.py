"""Connected components of a graph given by its links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import stage, unstage


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links(u, v)`` that isn't itself the least node of its component.

    Each round hangs a node's greater neighbours, then its smaller ones, below the least node around it;
    rounds grow with the logarithm of a component's diameter. No node's neighbours are gathered: only their
    minimum is, with partial aggregation, so that a node with very many links is no burden. Every round
    is written to the shared scratch folder, and freed after the next. Links from a node to itself and repeated links are allowed.
    """
    now = stage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    before, state = None, _state(now)
    while state != before:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u != v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, now = now, stage(small.union(least).distinct())
        unstage(large)
        unstage(last)
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
