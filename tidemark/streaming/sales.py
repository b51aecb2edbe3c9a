"""Best selling days over a growing folder of CSV files.

The aggregation is the batch one; its state is one row per day. Complete mode hands the whole result
to the sink at every trigger, which writes it to a folder of that batch. A repeated batch writes the same
folder again, and readers take the last complete one, so they never meet a half-written table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.plans.sales import best_days, daily_sales
from tidemark.sources.readers import read_parquet
from tidemark.sources.writers import write_parquet


def sorted_daily_sales(sales: DataFrame, date: str = "orderDate") -> DataFrame:
    """Daily sales, best day first. On a stream such a sort needs complete mode."""
    daily = daily_sales(sales, date)
    return daily.orderBy(daily["totalSales"].desc(), daily[date].asc())


def console_query(result: DataFrame, rows: int = 8) -> StreamingQuery:
    """Print the first rows of every batch; the caller waits and stops."""
    writer = result.writeStream.format("console").outputMode("complete")
    return writer.option("truncate", False).option("numRows", rows).start()


def versioned_table(path: str, shape: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch handler that shapes the result and writes it beside those of earlier batches.

    A line in the log comes last: it tells that the batch is complete.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        write_parquet(shape(batch), f"{path}/batch={number}")
        write_parquet(spark.createDataFrame([(number,)], "batch long").coalesce(1), f"{path}-log", mode="append")

    return write


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """The table as the last complete batch wrote it."""
    number = read_parquet(spark, f"{path}-log").agg(F.max("batch")).first()[0]
    return read_parquet(spark, f"{path}/batch={number}")


def start_table_query(
    result: DataFrame,
    path: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    once: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Write ``shape`` of the result at every batch; ``once`` ends after the files now there, ``interval``
    (such as ``10 seconds``) starts a batch that often, otherwise batches follow each other."""
    writer = result.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(versioned_table(path, shape))
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def daily_sales_table(stream: DataFrame, path: str, checkpoint: str, date: str = "orderDate") -> DataFrame:
    """Daily sales after all files now in the folder."""
    start_table_query(daily_sales(stream, date), path, checkpoint, once=True).awaitTermination()
    return latest_version(stream.sparkSession, path)


def best_days_table(stream: DataFrame, path: str, checkpoint: str, date: str = "orderDate", k: int = 8) -> DataFrame:
    """The ``k`` best days, written by every batch, after all files now in the folder."""
    query = start_table_query(
        daily_sales(stream, date), path, checkpoint, lambda batch: best_days(batch, date, k), once=True
    )
    query.awaitTermination()
    return latest_version(stream.sparkSession, path)


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Let a query run for at most so long, then stop it; True if it had ended by itself."""
    try:
        return bool(query.awaitTermination(int(seconds)))
    finally:
        query.stop()
