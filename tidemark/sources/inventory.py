"""Files below a path and their sizes, as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, folders searched recursively. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        "path",
        F.col("length").alias("bytes"),
        F.round(F.col("length") / (1024 * 1024), 2).alias("megabytes"),
    )


def file_name(path: str) -> Column:
    """The last two parts of a path; a scan and a listing of one folder may spell the rest in different ways."""
    return F.concat_ws("/", F.slice(F.split(F.col(path), "/"), -2, 2))


def rows_per_file(scan: DataFrame) -> DataFrame:
    """``file, rows`` of a scan of files, from the rows that were read."""
    return scan.groupBy(file_name("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


def storage_size(files: DataFrame) -> DataFrame:
    """Total size of an inventory: files, bytes, kB and MB."""
    total = F.coalesce(F.sum("bytes"), F.lit(0))
    return files.agg(
        F.count("*").alias("files"),
        total.alias("bytes"),
        F.round(total / 1024, 2).alias("kilobytes"),
        F.round(total / (1024 * 1024), 2).alias("megabytes"),
    )
