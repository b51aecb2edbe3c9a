"""Daily weather records: yearly extremes, statistics per year and country, special days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.aggregates import conditional_counts, extremes
from tidemark.operators.ranking import top_k


def with_year(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("year", F.year(date))


def yearly_extremes(
    df: DataFrame, date: str, low: str, high: str, names: Sequence[str] = ("temperature_min", "temperature_max")
) -> DataFrame:
    """Lowest and highest value of each year."""
    return extremes(with_year(df, date), ["year"], low, high, names)


def yearly_statistics(
    df: DataFrame,
    date: str,
    place: str,
    low: str,
    high: str,
    depth: str,
    names: Sequence[str] = ("temperature_min", "temperature_max", "snow_depth_avg"),
) -> DataFrame:
    """Entries, rounded extremes and rounded average depth per year and place."""
    return (
        with_year(df, date)
        .groupBy("year", place)
        .agg(
            F.count(place).alias("entries"),
            F.round(F.min(low), 1).alias(names[0]),
            F.round(F.max(high), 1).alias(names[1]),
            F.round(F.avg(depth)).cast("int").alias(names[2]),
        )
    )


def statistics_look_ups(
    statistics: DataFrame,
    place: str,
    low_of: tuple[int, str],
    high_of: tuple[int, str],
    range_of: tuple[int, str],
    depth_in: int,
    names: Sequence[str] = ("temperature_min", "temperature_max", "snow_depth_avg"),
) -> DataFrame:
    """Four values from the statistics in one row: a minimum, a maximum, a range and a mean depth."""

    def entry(year: int, where: str, column: str) -> Column:
        return F.max(F.when((F.col("year") == year) & (F.col(place) == where), F.col(column)))

    low, high, depth = names
    return statistics.agg(
        F.round(entry(*low_of, low), 2).alias("lowest"),
        F.round(entry(*high_of, high), 2).alias("highest"),
        F.round(entry(*range_of, high) - entry(*range_of, low), 2).alias("range"),
        F.round(F.avg(F.when(F.col("year") == depth_in, F.col(depth)))).cast("long").alias("mean_depth"),
    )


def cold_days(df: DataFrame, date: str, place: str, where: str, mean: str, below: float) -> DataFrame:
    """Days of each year on which the mean was below a limit in one place; years without any show 0."""
    rows = with_year(df.where(F.col(place) == where), date)
    return conditional_counts(rows, ["year"], {"count": F.col(mean) < below})


def warm_snow_days(df: DataFrame, place: str, mean: str, depth: str, above: float, deeper: float) -> DataFrame:
    """Days per place with a mean above a limit although the snow was deeper than another."""
    test = (F.col(mean) > above) & (F.col(depth) > deeper)
    return conditional_counts(df, [place], {"count": test})


def widest_days(df: DataFrame, date: str, low: str, high: str, k: int = 10, name: str = "temperature_diff") -> DataFrame:
    """Days with the largest difference between highest and lowest value."""
    spread = df.select(date, F.round(F.col(high) - F.col(low), 2).alias(name))
    return top_k(spread, [F.desc(name), F.asc(date)], k)
