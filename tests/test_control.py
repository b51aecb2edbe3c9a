import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import rows
from tidemark.plans.sales import daily_sales
from tidemark.sources.readers import read_csv, stream_csv
from tidemark.streaming import control
from tidemark.streaming import sales as S

FIELDS = "orderDate date, productPrice double, productCount int"


def add_files(spark, path, numbers, files):
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") * 7 % 20).cast("int"))
    data = spark.range(*numbers, numPartitions=files).select(day.alias("orderDate"), F.lit(1.0).alias("productPrice"), F.lit(1).alias("n"))
    data.write.mode("append").option("sep", ";").csv(path)


def total(df):
    return df.agg(F.sum("totalCount")).first()[0]


@pytest.fixture
def start(spark, folder):
    def begin(shape=lambda batch: batch, per_batch=2, **trigger):
        result = daily_sales(stream_csv(spark, f"{folder}/in", FIELDS, files_per_batch=per_batch))
        return S.start_table_query(result, f"{folder}/out", f"{folder}/state", shape, **trigger)

    return begin


def batch_result(spark, folder):
    return daily_sales(read_csv(spark, f"{folder}/in", FIELDS, ";", header=False))


def test_a_stream_stopped_in_the_middle_goes_on(spark, folder, start):
    add_files(spark, f"{folder}/in", (0, 600), 6)
    query = start(interval="1 hour")
    assert control.run_batches(query, 1, 120) == 1 and not query.isActive
    # Two files of six have been counted; the next interval was far away.
    assert total(S.latest_version(spark, f"{folder}/out")) == 200
    add_files(spark, f"{folder}/in", (600, 900), 3)
    assert control.run_to_end(lambda: start(once=True), 300) == 1
    assert rows(S.latest_version(spark, f"{folder}/out")) == rows(batch_result(spark, folder))
    # Every version counts two more files, so no batch was counted twice and none left out.
    log = sorted(r["batch"] for r in spark.read.parquet(f"{folder}/out-log").collect())
    versions = [total(spark.read.parquet(f"{folder}/out/batch={n}")) for n in log]
    assert log == list(range(5)) and versions == [200, 400, 600, 800, 900]


def test_nothing_new_changes_nothing(spark, folder, start):
    add_files(spark, f"{folder}/in", (0, 100), 2)
    control.run_to_end(lambda: start(once=True), 300)
    before = rows(S.latest_version(spark, f"{folder}/out"))
    control.run_to_end(lambda: start(once=True), 300)
    assert rows(S.latest_version(spark, f"{folder}/out")) == before


def test_a_failed_batch_is_repeated_and_counted_once(spark, folder, start):
    add_files(spark, f"{folder}/in", (0, 600), 6)
    marker = f"{folder}/failed"

    def shape(batch):
        # The second batch fails once, with part of its table written.
        if batch.agg(F.sum("totalCount")).first()[0] == 400 and not os.path.exists(marker):
            open(marker, "w").close()
            batch.limit(3).write.parquet(f"{folder}/out/batch=1")
            raise RuntimeError("lost")
        return batch

    assert control.run_to_end(lambda: start(shape, once=True), 300) == 2
    assert rows(S.latest_version(spark, f"{folder}/out")) == rows(batch_result(spark, folder))
    log = [r["batch"] for r in spark.read.parquet(f"{folder}/out-log").collect()]
    assert sorted(log) == [0, 1, 2]


def test_a_query_that_always_fails_raises(spark, folder, start):
    add_files(spark, f"{folder}/in", (0, 100), 2)
    starts = []

    def shape(batch):
        raise RuntimeError("broken sink")

    def begin():
        starts.append(1)
        return start(shape, once=True)

    with pytest.raises(StreamingQueryException, match="broken sink"):
        control.run_to_end(begin, 300, attempts=2)
    assert len(starts) == 2
    with pytest.raises(ValueError):
        control.run_to_end(begin, 300, attempts=0)


def test_waits_are_bounded(spark, folder, start):
    add_files(spark, f"{folder}/in", (0, 100), 1)
    query = start(interval="1 hour")
    assert control.run_batches(query, 5, 8) <= 1 and not query.isActive
    with pytest.raises(TimeoutError):
        control.run_to_end(lambda: start(interval="1 hour"), 1)
    assert not spark.streams.active
