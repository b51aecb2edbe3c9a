"""Joins of points and intervals of time, without comparing all pairs.

Intervals of like length share a grid: cells as wide as the next power of four, so that an interval lies
in two cells at most and fills a good part of them. A point looks into one cell of each grid that is in
use. Equal cells are an ordinary equi-join; what it finds is checked exactly.

Times are whole numbers, such as epoch milliseconds; intervals hold their start and not their end.
Intervals that are empty, reversed or without a bound, and points without a time, meet nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.reshape import union_all

#: Cells with more than this share of all rows are split, so there are at most as many of them as its inverse.
SHARE = 1 / 1000


def grid_bits(length: Column) -> Column:
    """The power of two of the cell width for intervals of this length: even, and the width no less."""
    # Digits of length - 1 as a binary number, rounded up to an even number.
    digits = F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))
    return (digits + digits % 2).cast("int")


def cell(time: Column, bits: Column) -> Column:
    return F.call_function("shiftright", time, bits)


def _valid(df: DataFrame, start: str, end: str) -> DataFrame:
    kept = df.where(F.col(start) < F.col(end))
    return kept.withColumns({start: F.col(start).cast("long"), end: F.col(end).cast("long")}).withColumn(
        "_bits", grid_bits(F.col(end) - F.col(start))
    )


def _grids(df: DataFrame) -> list[int]:
    """The grids in use: a few dozen numbers at most."""
    return sorted(row["_bits"] for row in df.select("_bits").distinct().collect())


def _in_cells(df: DataFrame, start: str, end: str) -> DataFrame:
    first, last = cell(F.col(start), F.col("_bits")), cell(F.col(end) - 1, F.col("_bits"))
    return df.withColumn("_cell", F.explode(F.sequence(first, last)))


def _met(left: DataFrame, right: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Rows of equal keys and cells; ``keys`` stay once.

    The rows of ``left`` in a hot cell are dealt out over several tasks, each of which gets all rows of
    ``right`` in the cell. Hot cells are told by their share of the rows, so their list is bounded.
    """
    on = [*keys, "_bits", "_cell"]
    sizes = left.groupBy(*on).count()
    total = left.count()
    hot = sizes.where(F.col("count") > share * total).select(*on, F.ceil(F.col("count") / F.lit(max(share * total, 1.0))).cast("int").alias("_parts"))
    hot = F.broadcast(hot)
    row = F.xxhash64(*left.columns, F.spark_partition_id())
    parts = F.coalesce("_parts", F.lit(1))
    dealt = left.join(hot, on, "left").withColumn("_part", F.pmod(row, parts).cast("int")).drop("_parts")
    copied = right.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copied, [*on, "_part"])


def contained(
    points: DataFrame,
    intervals: DataFrame,
    time: str,
    start: str,
    end: str,
    keys: Sequence[str] = (),
    share: float = SHARE,
) -> DataFrame:
    """Every point with every interval of the same ``keys`` that holds it, each pair once.

    The columns of both sides but for ``keys`` must differ in name.
    """
    held = _valid(intervals, start, end)
    grids = _grids(held)
    if not grids:
        grids = [0]
    looked = points.where(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("long"))
    looked = looked.withColumn("_bits", F.explode(F.array(*map(F.lit, grids)))).withColumn("_cell", cell(F.col(time), F.col("_bits")))
    pairs = _met(looked, _in_cells(held, start, end), keys, share)
    rest = [c for c in (*points.columns, *intervals.columns) if c not in keys]
    return pairs.where((F.col(start) <= F.col(time)) & (F.col(time) < F.col(end))).select(*keys, *rest)


def overlapping(
    left: DataFrame,
    right: DataFrame,
    left_bounds: tuple[str, str],
    right_bounds: tuple[str, str],
    keys: Sequence[str] = (),
    share: float = SHARE,
) -> DataFrame:
    """Every pair of intervals of the same ``keys`` that overlap, each pair once.

    A pair meets on the grid of the longer interval, in which the shorter one lies in two cells at most
    too, and counts in the cell where the later one starts. The columns of both sides but for ``keys``
    must differ in name.
    """
    (a, b), (c, d) = left_bounds, right_bounds
    one, two = _valid(left, a, b), _valid(right, c, d)
    grids = _grids(union_all([one.select("_bits"), two.select("_bits")])) or [0]

    def coarser(df: DataFrame, start: str, end: str, own: str) -> DataFrame:
        """A copy of each interval on its own grid and on every coarser one."""
        up = F.filter(F.array(*map(F.lit, grids)), lambda bits: bits >= F.col(own))
        copies = df.withColumnRenamed("_bits", own).withColumn("_bits", F.explode(up))
        return _in_cells(copies, start, end)

    pairs = _met(coarser(one, a, b, "_own"), coarser(two, c, d, "_other"), keys, share)
    met = (F.col("_bits") == F.greatest("_own", "_other")) & (F.col(a) < F.col(d)) & (F.col(c) < F.col(b))
    once = F.col("_cell") == cell(F.greatest(a, c), F.col("_bits"))
    rest = [name for name in (*left.columns, *right.columns) if name not in keys]
    return pairs.where(met & once).select(*keys, *rest)
