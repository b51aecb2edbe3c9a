"""Storage round trips: write, append, drift and read again. Every write goes to a path of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.tables import evolve_append
from tidemark.sources.readers import read_csv, read_json_lines, read_parquet, read_text_lines
from tidemark.sources.writers import append_csv, write_csv, write_parquet


def parquet_with_drift(spark: SparkSession, path: str, frames: Sequence[DataFrame]) -> DataFrame:
    """Write the first frame, append the others under their own schemas, read the merged columns."""
    write_parquet(frames[0], path)
    for frame in frames[1:]:
        write_parquet(frame, path, mode="append")
    return read_parquet(spark, path, merge_schema=True)


def csv_with_drift(spark: SparkSession, path: str, base: DataFrame, drifted: DataFrame, sep: str = "|") -> DataFrame:
    """CSV cannot hold two schemas: rows of another one are stored under the union of the columns."""
    both = evolve_append(base, drifted)
    write_csv(both, path, sep=sep, faithful=True)
    return read_csv(spark, path, schema=both.schema, sep=sep, faithful=True)


def csv_round_trip(spark: SparkSession, path: str, rows: DataFrame, sep: str = "|") -> DataFrame:
    """Write and read again, with texts of any content, NULLs and microseconds intact."""
    write_csv(rows, path, sep=sep, faithful=True)
    return read_csv(spark, path, schema=rows.schema, sep=sep, faithful=True)


def csv_append(spark: SparkSession, path: str, base: DataFrame, more: DataFrame, sep: str = "|") -> DataFrame:
    """Write, append rows of the same columns in any order, and read both again."""
    write_csv(base, path, sep=sep, faithful=True)
    append_csv(more, path, base.schema, sep=sep, faithful=True)
    return read_csv(spark, path, schema=base.schema, sep=sep, faithful=True)


def json_lines_round_trip(spark: SparkSession, path: str, objects: DataFrame, column: str) -> DataFrame:
    """A column of JSON objects as a JSON-lines folder, scanned with an inferred schema."""
    objects.select(column).write.mode("overwrite").text(path)
    return read_json_lines(spark, path)


def text_round_trip(spark: SparkSession, path: str, texts: DataFrame, column: str) -> DataFrame:
    """A column of texts as a folder of text files, scanned line by line through a glob."""
    texts.select(column).write.mode("overwrite").text(path)
    return read_text_lines(spark, f"{path}/*.txt")
