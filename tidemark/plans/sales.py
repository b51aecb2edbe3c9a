"""Sales: best selling days, best publisher, latest rows with new ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.aggregates import sums_of_products
from tidemark.operators.ranking import top_k


def daily_sales(
    sales: DataFrame, day: str = "orderDate", price: str = "productPrice", count: str = "productCount"
) -> DataFrame:
    """Sales value and items per day, for tables and streams alike."""
    return sums_of_products(sales, [day], {"totalSales": [price, count]}, {"totalCount": count})


def best_days(daily: DataFrame, day: str = "orderDate", k: int = 8) -> DataFrame:
    return top_k(daily, [F.desc("totalSales"), F.asc(day)], k)


def publisher_sales(
    games: DataFrame,
    publisher: str,
    released: str,
    regional: str,
    total: str,
    first_year: int,
    last_year: int,
) -> DataFrame:
    """One row per publisher for a range of years: regional sales, titles without them, and sales by year.

    The list of years is at most as long as the range. All questions about the best publisher are
    answered from its row, so the games are read once and no name returns to the driver.
    """
    year = F.year(released)
    # As a range of dates the filter reaches the scan, which a condition on the year does not.
    in_range = (F.col(released) >= F.lit(date(first_year, 1, 1))) & (F.col(released) < F.lit(date(last_year + 1, 1, 1)))
    years = (
        games.where(in_range)
        .groupBy(F.col(publisher).alias("publisher"), year.alias("year"))
        .agg(
            F.sum(regional).alias("regional_sum"),
            F.sum(total).alias("total_sum"),
            F.count_if(F.col(regional).isNull()).alias("missing"),
        )
    )
    return years.groupBy("publisher").agg(
        F.sum("regional_sum").alias("regional_total"),
        F.sum("missing").alias("missing_titles"),
        F.collect_list(F.struct("year", "regional_sum", "total_sum")).alias("years"),
    )


def best_publisher(publishers: DataFrame) -> DataFrame:
    """The publisher with the largest regional sales, one row; the first name among equals."""
    return top_k(publishers, [F.desc_nulls_last("regional_total"), F.asc("publisher")], 1)


def sales_by_year(publishers: DataFrame) -> DataFrame:
    """Regional and total sales per year, of the best publisher say."""
    return (
        publishers.select(F.explode("years").alias("y"))
        .select(
            F.col("y.year").alias("year"),
            F.round("y.regional_sum", 2).alias("na_total"),
            F.round("y.total_sum", 2).alias("global_total"),
        )
        .orderBy("year")
    )


def latest_rows(df: DataFrame, column: str, value: str, time: str, ident: str, k: int, suffix: str) -> DataFrame:
    """The newest ``k`` rows of one value (a city, say) under new ids."""
    newest = top_k(df.where(F.col(column) == value), [F.desc(time), F.asc(ident)], k)
    return newest.withColumn(ident, F.concat(F.col(ident), F.lit(suffix)))


def drifted_rows(
    df: DataFrame,
    changed: Mapping[str, Column],
    added: Mapping[str, Column],
    renamed: Mapping[str, str],
    dropped: Sequence[str],
) -> DataFrame:
    """The same rows under another schema: columns changed in place, added, renamed and dropped.

    All new values are computed from the old row.
    """
    return df.withColumns({**changed, **added}).withColumnsRenamed(dict(renamed)).drop(*dropped)
