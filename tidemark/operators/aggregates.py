"""Grouped and global aggregations. All of them combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import as_column


def extremes(
    df: DataFrame, keys: Sequence[str], low: str, high: str, names: Sequence[str] = ("value_min", "value_max")
) -> DataFrame:
    """Lowest ``low`` and highest ``high`` per group, or of the whole table without keys."""
    return df.groupBy(*keys).agg(F.min(low).alias(names[0]), F.max(high).alias(names[1]))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def distinct_count(df: DataFrame, column: str, name: str = "distinct_values") -> DataFrame:
    """Number of different non-NULL values."""
    return df.agg(F.countDistinct(column).alias(name))


def group_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def conditional_counts(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Rows per group for which each condition is TRUE; groups without such rows keep a 0."""
    return df.groupBy(*keys).agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])


def sums_of_products(
    df: DataFrame, keys: Sequence[str], products: Mapping[str, Sequence[str]], sums: Mapping[str, str] | None = None
) -> DataFrame:
    """``sum(a * b * ...)`` per group for each entry of ``products``, and plain sums beside them."""
    aggregates = []
    for name, factors in products.items():
        product = as_column(factors[0])
        for factor in factors[1:]:
            product = product * as_column(factor)
        aggregates.append(F.sum(product).alias(name))
    aggregates += [F.sum(column).alias(name) for name, column in (sums or {}).items()]
    return df.groupBy(*keys).agg(*aggregates)


def mean_ratio_percent(df: DataFrame, keys: Sequence[str], part: str, whole: str, name: str, digits: int = 2) -> DataFrame:
    """Average of the rows' own ratios in percent, not the ratio of the sums; rows with ``whole`` 0 do not count."""
    ratio = F.try_divide(F.col(part), F.col(whole)) * 100
    return df.groupBy(*keys).agg(F.round(F.avg(ratio), digits).alias(name))


def share_of_total(counts: DataFrame, group: Sequence[str], count: str, name: str = "share", digits: int = 2) -> DataFrame:
    """Adds each row's percentage of its group's total.

    The totals are aggregated and joined back instead of taken over a window, so that a group with a
    large part of all rows is not gathered in one task.
    """
    # Fresh names, so that the two sides of the join share no column reference.
    renamed = {key: f"_total_{key}" for key in group}
    totals = counts.groupBy(*[F.col(key).alias(renamed[key]) for key in group]).agg(F.sum(count).alias("_total"))
    same = [F.col(key).eqNullSafe(F.col(renamed[key])) for key in group]
    percent = F.try_divide(F.col(count), F.col("_total")) * 100
    return counts.join(totals, same).select(*counts.columns, F.round(percent, digits).alias(name))


def polynomial(value: Column | str, coefficients: Sequence[int]) -> Column:
    """``c0 + c1 x + c2 x^2 + ...`` by Horner's rule."""
    x, result = as_column(value), F.lit(0)
    for coefficient in reversed(coefficients):
        result = result * x + coefficient
    return result


def polynomial_reduce(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    summed: Mapping[str, Sequence[int]],
    greatest: Mapping[str, Sequence[int]],
) -> DataFrame:
    """Sums and maxima of polynomials of a column, each a name with its coefficients from the constant on."""
    sums = [F.sum(polynomial(column, c)).alias(name) for name, c in summed.items()]
    maxima = [F.max(polynomial(column, c)).alias(name) for name, c in greatest.items()]
    return df.groupBy(*keys).agg(*sums, *maxima)
