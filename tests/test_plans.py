import datetime as dt

import pytest

from pyspark.sql import functions as F

from helpers import plan, rows, values
from tidemark.functions.columns import celsius
from tidemark.plans import corpus, energy, sales, storage, weather
from tidemark.session import shared_path

DAY = dt.date


@pytest.fixture(scope="module")
def days(spark):
    data = [
        ("FI", DAY(2015, 1, 1), -12.0, -15.0, -8.0, 200.0),
        ("FI", DAY(2015, 7, 1), 15.0, 9.0, 22.5, 0.0),
        ("FI", DAY(2016, 4, 1), 6.0, 1.0, 8.0, 150.0),
        ("SE", DAY(2015, 1, 1), -3.0, -6.0, 0.0, 301.0),
        ("SE", DAY(2016, 1, 1), None, None, 1.0, None),
    ]
    return spark.createDataFrame(
        data,
        "country string, date date, temperature_avg double, temperature_min double, temperature_max double, snow_depth double",
    )


def test_yearly_extremes(days):
    got = weather.yearly_extremes(days, "date", "temperature_min", "temperature_max")
    assert got.columns == ["year", "temperature_min", "temperature_max"]
    assert [tuple(r) for r in got.orderBy(F.desc("year"), got.columns[1]).collect()] == [(2016, 1.0, 8.0), (2015, -15.0, 22.5)]


def statistics(days):
    return weather.yearly_statistics(days, "date", "country", "temperature_min", "temperature_max", "snow_depth")


def test_yearly_statistics(days):
    assert [tuple(r) for r in statistics(days).orderBy(F.desc("year"), "country").collect()] == [
        (2016, "FI", 1, 1.0, 8.0, 150),
        (2016, "SE", 1, None, 1.0, None),
        (2015, "FI", 2, -15.0, 22.5, 100),
        (2015, "SE", 1, -6.0, 0.0, 301),
    ]


def test_look_ups(days):
    got = weather.statistics_look_ups(statistics(days), "country", (2016, "FI"), (2015, "SE"), (2015, "FI"), 2015)
    assert rows(got) == [(1.0, 0.0, 37.5, 201)]


def test_special_days(days):
    assert rows(weather.cold_days(days, "date", "country", "FI", "temperature_avg", -10)) == [(2015, 1), (2016, 0)]
    assert rows(weather.warm_snow_days(days, "country", "temperature_avg", "snow_depth", 5, 100)) == [("FI", 1), ("SE", 0)]
    widest = weather.widest_days(days, "date", "temperature_min", "temperature_max", 2)
    assert [tuple(r) for r in widest.collect()] == [(DAY(2015, 7, 1), 13.5), (DAY(2015, 1, 1), 7.0)]


@pytest.fixture(scope="module")
def readings(spark):
    start = 1716152400000  # midnight at +3 h
    sparse = [
        (start, None, None, None, None, None, 10.0),
        (start + 1, None, None, None, None, 14.0, None),
        (start + 2, None, None, None, 24000.0, None, None),
        (start + 3, None, 4000.0, None, None, None, None),
        (start + 4, None, None, 50.0, None, None, None),
        (start + 5, 1000.0, None, None, None, None, None),
        (start + 1000, 3000.0, None, None, None, 16.0, None),
        (start + 3_600_000, 500.0, 1.0, None, 1.0, None, 5.0),
    ]
    return spark.createDataFrame(
        sparse,
        "Time long, SolarPower double, WaterCooling01Power double, WaterCooling02Power double, "
        "VentilationPower double, Temperature double, ElectricityPrice double",
    )


def test_hourly_averages_skip_nulls(readings):
    got = [tuple(r) for r in energy.hourly_averages(readings).orderBy("Time").collect()]
    assert got == [
        (dt.datetime(2024, 5, 20, 0), 15.0, 2.0, 28.05, 10.0),
        (dt.datetime(2024, 5, 20, 1), None, 0.5, None, 5.0),  # a consumer without a reading
    ]


def test_daily_totals_and_cost(readings):
    daily = energy.daily_totals(energy.hourly_averages(readings))
    assert [tuple(r) for r in daily.collect()] == [(DAY(2024, 5, 20), 15.0, 2.5, 28.05, 0.26)]
    assert rows(energy.total_cost(daily)) == [(0.26,)]


def test_total_is_of_the_rounded_days(spark):
    costs = [9.11, 16.84, 10.63, 5.5, 35.53, 10.8, 3.36]
    daily = spark.createDataFrame([(c,) for c in costs], "DailyCost double")
    assert rows(energy.total_cost(daily)) == [(91.77,)]


def test_corpus(spark):
    texts = spark.createDataFrame([("a bb bb\r\n\n  c3 bb",), ("",), (None,), ("señor sunsets",)], "text string")
    lines = corpus.lines_of(texts, "text")
    assert rows(corpus.line_total(lines)) == [(3,)]
    words = corpus.words_of(lines)
    assert rows(corpus.word_counts(words)) == [("a", 1), ("bb", 3), ("señor", 1), ("sunsets", 1)]
    assert rows(corpus.word_total(words)) == [(6,)] and rows(corpus.word_distinct(words)) == [(4,)]
    assert values(corpus.rarest_first(corpus.word_counts(words)), "word") == ["a", "señor", "sunsets", "bb"]
    assert rows(corpus.most_common_word(words, 7, "s")) == [("sunsets", 1)]
    assert values(corpus.line_starts(lines, n=2, width=3), "start") == ["  c", "a b"]


def test_typed_counts(spark):
    counts = spark.createDataFrame([("a", 3_000_000_000)], "word string, count long")
    typed = corpus.typed_word_counts(counts)
    assert typed.dtypes == [("word", "string"), ("count", "bigint")] and rows(typed) == [("a", 3_000_000_000)]


def test_word_count_of_a_line(spark):
    texts = spark.createDataFrame([("sheena is a punk rocker she is a punk punk",)], "value string")
    counts = dict(map(tuple, corpus.word_counts(corpus.words_of(texts)).collect()))
    assert counts == {"sheena": 1, "is": 2, "a": 2, "punk": 3, "rocker": 1, "she": 1}


def test_texts_stored_as_files_give_the_same_lines(spark):
    texts = spark.createDataFrame([("one\n\ntwo\r\nthree",), ("",), ("four",)], "text string")
    stored = storage.text_round_trip(spark, shared_path(spark, "t"), texts, "text")
    assert rows(stored) == rows(corpus.lines_of(texts, "text"))


def test_best_days_break_ties_by_date(spark):
    data = [(DAY(2020, 1, 3), 2.0, 3), (DAY(2020, 1, 1), 3.0, 2), (DAY(2020, 1, 2), 1.0, 1), (DAY(2020, 1, 2), 1.0, 1)]
    df = spark.createDataFrame(data, "orderDate date, productPrice double, productCount int")
    got = sales.best_days(sales.daily_sales(df), k=2)
    assert [tuple(r) for r in got.collect()] == [(DAY(2020, 1, 1), 6.0, 2), (DAY(2020, 1, 3), 6.0, 3)]


def test_best_publisher(spark):
    data = [
        ("P", DAY(2006, 1, 1), 5.0, 9.0),
        ("P", DAY(2007, 1, 1), None, 1.0),
        ("P", DAY(2007, 2, 1), 1.25, 2.0),
        ("Q", DAY(2006, 1, 1), 6.0, 90.0),
        ("Q", DAY(2005, 12, 31), 60.0, 90.0),
        ("R", DAY(2006, 1, 1), None, 90.0),
    ]
    df = spark.createDataFrame(data, "Publisher string, release_date date, NA_Sales double, total_sales double")
    publishers = sales.publisher_sales(df, "publisher", "release_date", "na_sales", "total_sales", 2006, 2015)
    best = sales.best_publisher(publishers)
    assert rows(best.select("publisher", "regional_total", "missing_titles")) == [("P", 6.25, 1)]
    by_year = sales.sales_by_year(best)
    assert [tuple(r) for r in by_year.collect()] == [(2006, 5.0, 9.0), (2007, 1.25, 3.0)]
    assert "Join" not in plan(by_year)


def test_latest_rows_and_drift(spark):
    data = [("A-1", 10, "LA", "d", 49.0), ("A-2", 30, "LA", "d", 58.0), ("A-3", 20, "LA", "d", None), ("A-4", 99, "SF", "d", 1.0)]
    df = spark.createDataFrame(data, "ID string, t int, City string, Description string, Temperature_F double")
    latest = sales.latest_rows(df, "City", "LA", "t", "ID", 2, "_Z1")
    assert values(latest, "ID") == ["A-2_Z1", "A-3_Z1"]
    drifted = sales.drifted_rows(
        latest,
        {"ID": F.concat(F.regexp_replace("ID", "_Z1$", ""), F.lit("_Z2")), "Temperature_F": celsius("Temperature_F")},
        {"AddedColumn1": F.concat(F.lit("prefix-"), "City"), "AddedColumn2": F.lit("New column")},
        {"Temperature_F": "Temperature_C"},
        ["Description"],
    )
    assert drifted.columns == ["ID", "t", "City", "Temperature_C", "AddedColumn1", "AddedColumn2"]
    assert drifted.first()["Temperature_C"] == pytest.approx(14.4444, abs=1e-4)
    merged = storage.parquet_with_drift(spark, shared_path(spark, "drift"), [df, latest, drifted])
    assert merged.count() == 8 and len(merged.columns) == 8
    text = storage.csv_with_drift(spark, shared_path(spark, "drift-csv"), df, drifted)
    assert text.columns == merged.select(*text.columns).columns and text.count() == 6


@pytest.mark.parametrize(
    "first_utc,labels",
    [
        # The clock is set back at 01:00 UTC: the hour from three to four comes twice.
        (dt.datetime(2024, 10, 26, 23), [2, 3, 3, 4]),
        # It is set forward at 01:00 UTC: that hour is left out.
        (dt.datetime(2024, 3, 30, 23), [1, 2, 4, 5]),
    ],
)
def test_hours_around_a_change_of_the_clock(spark, first_utc, labels):
    start = int(first_utc.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    names = ["SolarPower", "WaterCooling01Power", "WaterCooling02Power", "VentilationPower", "Temperature", "ElectricityPrice"]
    data = [(start + k * 3_600_000 + m, 1000.0 * (k + 1), 1.0, 1.0, 1.0, 5.0, 1.0) for k in range(4) for m in (0, 1_800_000)]
    readings = spark.createDataFrame(data, "Time long, " + ", ".join(f"{n} double" for n in names))
    hourly = energy.hourly_averages(readings)
    got = sorted((r["Time"].hour, r["ProducedEnergy"]) for r in hourly.collect())
    assert got == list(zip(labels, [1.0, 2.0, 3.0, 4.0]))
    assert energy.daily_totals(hourly).agg(F.sum("ProducedEnergy")).first()[0] == 10.0


def test_rollups_sort_nothing(spark, readings):
    daily = energy.daily_totals(energy.hourly_averages(readings))
    for df in (daily, energy.total_cost(daily)):
        assert "rangepartitioning" not in plan(df)
