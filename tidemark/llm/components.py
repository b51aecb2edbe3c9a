"""Connected components of a graph of links, by alternating stars on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """``edges`` (``u, v``) with ``m``, the least of ``u`` and its neighbours. A hub's edges are combined
    before the shuffle and meet their minimum in a join, never in one group."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``: the least node that links reach.

    Large and small stars alternate until the edges no longer change; the number of rounds grows with
    the logarithm of the size of a component. Each round is stored, which also cuts the lineage; only
    two numbers per round reach the driver.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Larger neighbours are linked to the least node around; each new edge is kept as (larger, smaller).
        large = _nearest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        # Smaller neighbours and the node itself are linked to the least of them.
        small = _nearest(large)
        edges = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .filter("u > v")
            .distinct(),
            "stars",
        )
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
