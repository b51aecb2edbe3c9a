import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.plans.sales import best_days, daily_sales
from tidemark.sources.readers import read_csv, stream_csv
from tidemark.streaming import sales as S

FIELDS = "orderDate date, productPrice double, productCount int"


@pytest.fixture
def sales_folder(spark, folder):
    path = folder + "/in"
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") * 7 % 20).cast("int"))
    data = spark.range(500, numPartitions=6).select(
        day.alias("orderDate"), (F.col("id") % 13 * 0.25).alias("productPrice"), (F.col("id") % 5).cast("int").alias("n")
    )
    data.write.option("sep", ";").csv(path)
    return path


def stream(spark, path, per_batch=1):
    return stream_csv(spark, path, FIELDS, files_per_batch=per_batch)


def test_final_state_equals_the_batch_result(spark, sales_folder, folder):
    batch = daily_sales(read_csv(spark, sales_folder, FIELDS, ";", header=False))
    result = S.daily_sales_table(stream(spark, sales_folder), folder + "/out", folder + "/state")
    assert rows(result) == rows(batch) and result.count() == 20


def test_each_batch_writes_its_top_days(spark, sales_folder, folder):
    batch = best_days(daily_sales(read_csv(spark, sales_folder, FIELDS, ";", header=False)))
    result = S.best_days_table(stream(spark, sales_folder), folder + "/out", folder + "/state")
    assert rows(result) == rows(batch) and result.count() == 8


def test_new_files_continue_the_state(spark, sales_folder, folder):
    first = S.daily_sales_table(stream(spark, sales_folder), folder + "/out", folder + "/state")
    before = first.agg(F.sum("totalCount")).first()[0]
    extra = spark.createDataFrame([(dt.date(2020, 1, 1), 1000.0, 7)], FIELDS)
    extra.write.mode("append").option("sep", ";").csv(sales_folder)
    again = S.daily_sales_table(stream(spark, sales_folder), folder + "/out", folder + "/state")
    assert again.agg(F.sum("totalCount")).first()[0] == before + 7
    assert best_days(again, k=1).first()["orderDate"] == dt.date(2020, 1, 1)


def test_sorted_stream_needs_complete_mode(spark, sales_folder, folder):
    result = S.sorted_daily_sales(stream(spark, sales_folder))
    assert result.isStreaming
    with pytest.raises(Exception, match="(?i)sort"):
        result.writeStream.outputMode("update").format("console").start()
    query = result.writeStream.outputMode("complete").format("memory").queryName("sorted_days")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    totals = [r["totalSales"] for r in spark.table("sorted_days").collect()]
    assert totals == sorted(totals, reverse=True) and len(totals) == 20


def test_console_query_starts_and_stops(spark, sales_folder):
    query = S.console_query(S.sorted_daily_sales(stream(spark, sales_folder, 10)))
    assert S.run_for(query, 1) is False
    assert not query.isActive


def test_stream_needs_a_schema(spark, sales_folder):
    with pytest.raises(Exception):
        spark.readStream.csv(sales_folder)
