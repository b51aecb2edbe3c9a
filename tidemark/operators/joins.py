"""Joins used by the plans. Every join here has an equality, so none of them compares all pairs.

No side is forced into a broadcast: Spark broadcasts below ``spark.sql.autoBroadcastJoinThreshold``,
by file statistics before the run and by measured size during it, and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def keyed_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join on keys with different names on the two sides; only the left ones stay."""
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in keys.values()})
    same = [F.col(a) == F.col(f"_right_{b}") for a, b in keys.items()]
    return left.join(renamed, same, how).drop(*[f"_right_{name}" for name in keys.values()])


def lookup(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Add the columns of a dimension; facts without an entry drop out."""
    return facts.join(dimension, [key], "inner")

