"""Keyed changes to a table, as DataFrame to DataFrame operators.

The result is a new frame to be written to a new path; a path that is being read is never replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

DUPLICATE_MATCH = "more than one source row matches a target row"


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> DataFrame:
    """Update the rows of ``target`` whose key is in ``source``, insert the other rows of ``source``.

    ``update`` and ``insert`` list the columns taken from the source, by default all that both have;
    an inserted row has NULL in the others. Values take the target's types. NULL keys match nothing. Two
    source rows for the same target row raise when the result is computed.

    The source is reduced to one row per key before it meets the target, and the inserts come from an
    anti-join, so that a key with many rows on either side never meets itself row by row in one task.
    """
    types = {field.name: field.dataType for field in target.schema}
    shared = [name for name in target.columns if name in source.columns]
    unknown = [name for name in [*keys, *(update or []), *(insert or [])] if name not in shared]
    if unknown:
        raise ValueError(f"not columns of both target and source: {unknown}")
    update = [name for name in (shared if update is None else update) if name not in keys]
    insert = list(dict.fromkeys([*keys, *(shared if insert is None else insert)]))

    by_key = source.groupBy(*[F.col(key).alias(f"_key_{key}") for key in keys]).agg(
        F.count("*").alias("_matches"),
        *[F.any_value(F.col(name).cast(types[name])).alias(f"_new_{name}") for name in update],
    )
    same = [F.col(key) == F.col(f"_key_{key}") for key in keys]
    matched = F.col("_matches").isNotNull()
    checked = F.when(F.col("_matches") > 1, F.raise_error(F.lit(DUPLICATE_MATCH)).cast("boolean")).otherwise(matched)
    joined = target.join(by_key, same, "left").withColumn("_hit", checked)
    columns = []
    for name in target.columns:
        old = F.col(name)
        if name in update:
            columns.append(F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(old).alias(name))
        else:
            columns.append(old)
    # The filter always holds; it keeps the duplicate check in the plan whatever columns are read.
    kept = joined.where(F.col("_hit").isNotNull()).select(*columns)

    # Target keys collapse on the map side; Spark moves the semi-join below the distinct where the source
    # is small enough to broadcast, so a small source never shuffles the target's keys.
    hit_keys = target.select(*keys).distinct().join(source.select(*keys), list(keys), "left_semi")
    new_rows = source.join(hit_keys, list(keys), "left_anti").select(
        *[
            (F.col(name) if name in insert else F.lit(None)).cast(kind).alias(name)
            for name, kind in types.items()
        ]
    )
    return kept.unionByName(new_rows)


def update_where(df: DataFrame, changes: Mapping[str, Column], condition: Column | None = None) -> DataFrame:
    """Set columns where the condition is TRUE, everywhere without one.

    Every value is computed from the old row and takes the type of its column.
    """
    types = {field.name: field.dataType for field in df.schema}
    unknown = [name for name in changes if name not in types]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    values = {name: value.cast(types[name]) for name, value in changes.items()}
    if condition is None:
        return df.withColumns(values)
    return df.withColumns({name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove the rows for which the condition is TRUE; an unknown (NULL) one keeps its row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def evolve_append(old: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both, with the columns of the old frame and then those only the new one has.

    Missing values are NULL. A column whose type differs between the two raises.
    """
    types = {field.name.lower(): field.dataType for field in old.schema}
    clash = [field.name for field in new.schema if types.get(field.name.lower(), field.dataType) != field.dataType]
    if clash:
        raise ValueError(f"columns of another type: {clash}")
    return old.unionByName(new, allowMissingColumns=True)
