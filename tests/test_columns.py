import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows, values
from tidemark.functions import columns as C


def test_signed_text(spark):
    df = spark.createDataFrame([(3,), (0,), (-4,), (None,)], "n int")
    assert values(df.select(C.signed_text("n").alias("t")), "t") == ["+3", "0", "-4", None]


def test_sum_of_is_null_with_a_null(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3)], "a int, b int, c int")
    assert values(df.select(C.sum_of("a", "b", "c").alias("s")), "s") == [6, None]


def test_celsius(spark):
    df = spark.createDataFrame([(49.0,), (58.0,)], "f double")
    assert values(df.select(F.round(C.celsius("f"), 4).alias("c")), "c") == [9.4444, 14.4444]


def test_fifth_roots(spark):
    numbers = [(32.0, 2), (3125.0, 5), (1e10, 100), (1e-10, 0.01), (-243.0, -3), (0.0, 0)]
    df = spark.createDataFrame([(n,) for n, _ in numbers], "n double")
    got = values(df.select(C.newton_root("n").alias("r")), "r")
    assert got == pytest.approx([root for _, root in numbers], abs=1e-6)


def test_root_without_result_is_null(spark):
    df = spark.createDataFrame([(-4.0,), (None,)], "n double")
    assert values(df.select(C.newton_root("n").alias("r")), "r") == [None, None]


def test_first_hour_at_fixed_offset(spark):
    df = spark.createDataFrame([(1716152400000,)], "t long")
    hours = df.select(C.local_hour("t", "+03:00").alias("a"), C.local_hour("t", "Europe/Helsinki").alias("b"))
    assert rows(hours) == [(dt.datetime(2024, 5, 20), dt.datetime(2024, 5, 20))]


def test_zone_follows_winter_time_and_odd_offsets(spark):
    df = spark.createDataFrame([(1704067200000 + 61_500,)], "t long")
    got = df.select(
        C.local_hour("t", "Europe/Helsinki").alias("a"),
        C.local_hour("t", "Asia/Kolkata").alias("b"),
        C.local_time("t", "UTC").alias("c"),
    )
    assert rows(got) == [
        (dt.datetime(2024, 1, 1, 2), dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 0, 1, 1, 500000))
    ]


def test_epoch_ms_ignores_the_session_zone(spark):
    moment = dt.datetime(2024, 3, 31, 2, 30, 15, 250000)
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    expected = int(moment.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    for zone in ("UTC", "America/New_York", "Europe/Helsinki"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert values(df.select(C.epoch_ms("t").alias("ms")), "ms") == [expected]
            again = df.select(C.utc_time(C.epoch_ms("t")).alias("t"))
            assert values(again, "t") == [moment]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_before_1970(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59, 1000),)], "t timestamp_ntz")
    assert values(df.select(C.epoch_ms("t").alias("ms")), "ms") == [-999]


def test_words_and_digits(spark):
    df = spark.createDataFrame([("  one\ttwo2 three\x0b3 \n four",)], "t string")
    pieces = df.select(F.explode(C.words("t")).alias("w"))
    assert values(pieces.where(C.is_word("w")), "w") == ["one", "three", "four"]


def test_random_values_repeat_with_their_seed(spark):
    df = spark.range(200).select(C.random_value(1).alias("a"), C.random_value(1).alias("b"), C.random_value(2).alias("c"))
    got = df.collect()
    assert all(r["a"] == r["b"] and 0 <= r["a"] <= 100 for r in got) and any(r["a"] != r["c"] for r in got)


def test_file_code(spark):
    df = spark.createDataFrame([("dbfs:/x/1F1EB-1F1EE.png",), ("dbfs:/x/readme.txt",)], "p string")
    assert values(df.select(C.file_code("p").alias("c")), "c") == ["1F1EB-1F1EE", ""]


@pytest.mark.parametrize("a, b, expected", [(1, 12, 1), (12, 2, 2), (5, 7, 2), (4, 4, 0), (1, 7, 6)])
def test_cyclic_distance_of_months(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a int, b int")
    assert values(df.select(C.cyclic_distance("a", "b", 12).alias("d")), "d") == [expected]
