"""Unions, unpivots and row expansion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, frames)


def positional_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column position; the first frame names the columns."""
    return reduce(DataFrame.union, frames)


def both_sides(df: DataFrame, keep: Sequence[str], sides: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One row per side of each row, in a single pass over the input.

    Each side maps the same new names to its own expressions, so a match table becomes one row for
    the home team and one for the away team without a union that reads the input twice.
    """
    names = list(sides[0])
    structs = [F.struct(*[side[name].alias(name) for name in names]) for side in sides]
    return df.select(*keep, F.explode(F.array(*structs)).alias("_side")).select(
        *keep, *[F.col(f"_side.{name}").alias(name) for name in names]
    )


def explode_words(df: DataFrame, pieces: Column, name: str = "word") -> DataFrame:
    """One row per element of an array expression."""
    return df.select(F.explode(pieces).alias(name))
