import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows, values
from tidemark.session import PARTITIONS_KEY, shared_path, spread
from tidemark.sources import inventory, readers, writers

FIELDS = "id int, name string, day date, x double"
DATA = [(1, "a", dt.date(2020, 1, 1), 1.5), (2, None, dt.date(2020, 1, 2), None)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(DATA, FIELDS)


@pytest.mark.parametrize("sep", [",", ";", "|"])
def test_csv_round_trip(spark, frame, folder, sep):
    writers.write_csv(frame, folder + "/t", sep=sep)
    assert rows(readers.read_csv(spark, folder + "/t", FIELDS, sep)) == rows(frame)
    inferred = readers.read_csv(spark, folder + "/t", sep=sep, infer=True)
    assert [t for _, t in inferred.dtypes] == ["int", "string", "date", "double"]
    assert rows(inferred) == rows(frame)


def test_csv_needs_a_schema_or_inference(spark, folder):
    with pytest.raises(ValueError):
        readers.read_csv(spark, folder)


def test_csv_appends_by_name_not_position(spark, frame, folder):
    writers.write_csv(frame, folder + "/t")
    writers.append_csv(frame.select("x", "day", "name", "id"), folder + "/t", frame.schema)
    assert rows(readers.read_csv(spark, folder + "/t", FIELDS, "|")) == sorted(rows(frame) * 2)


def test_csv_append_rejects_or_fills_other_columns(spark, frame, folder):
    writers.write_csv(frame, folder + "/t")
    with pytest.raises(writers.SchemaMismatch):
        writers.append_csv(frame.withColumn("new", F.lit(1)), folder + "/t", frame.schema)
    with pytest.raises(writers.SchemaMismatch):
        writers.append_csv(frame.drop("name"), folder + "/t", frame.schema)
    with pytest.raises(writers.SchemaMismatch):
        writers.append_csv(frame.withColumn("id", F.col("id").cast("string")), folder + "/t", frame.schema)
    writers.append_csv(frame.drop("name"), folder + "/t", frame.schema, fill_missing=True)
    assert readers.read_csv(spark, folder + "/t", FIELDS, "|").where("name is null").count() == 3


def test_unsafe_csv_append_shifts_the_values(spark, frame, folder):
    writers.write_csv(frame, folder + "/t")
    writers.write_csv(frame.select("name", "id"), folder + "/t", mode="append")
    broken = readers.read_csv(spark, folder + "/t", FIELDS.replace("id int", "id string"), "|")
    assert "a" in values(broken, "id")


def test_parquet_append_and_merged_schema(spark, frame, folder):
    path = folder + "/t"
    writers.write_parquet(frame, path)
    writers.write_parquet(frame, path, mode="append")
    assert readers.read_parquet(spark, path).count() == 4
    writers.write_parquet(frame.drop("name").withColumn("extra", F.lit("e")), path, mode="append")
    merged = readers.read_parquet(spark, path, merge_schema=True)
    assert set(merged.columns) == {"id", "name", "day", "x", "extra"}
    assert merged.count() == 6 and merged.where("extra is null").count() == 4
    assert len(readers.read_parquet(spark, path).columns) == 4


def test_formats_by_name(spark, frame, folder):
    writers.write_format(frame, folder + "/o", "orc")
    assert rows(readers.read_format(spark, folder + "/o", "orc")) == rows(frame)
    with pytest.raises(Exception, match="(?i)delta|DATA_SOURCE_NOT_FOUND"):
        readers.read_format(spark, folder + "/o", "delta").count()


def test_single_file(spark, folder):
    writers.write_single_file(spark.range(100, numPartitions=5), folder + "/t")
    files = inventory.file_inventory(spark, folder + "/t").where(F.col("path").endswith(".parquet"))
    assert files.count() == 1


def test_json_lines(spark, folder):
    lines = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2}',)], "v string")
    lines.write.text(folder + "/t")
    assert rows(readers.read_json_lines(spark, folder + "/t")) == [(1, "x"), (2, None)]
    assert rows(readers.read_json_lines(spark, folder + "/t", "a int")) == [(1,), (2,)]


def test_text_lines_skip_empty_ones(spark, folder):
    with open(folder + "/a.txt", "w") as file:
        file.write("one\n\ntwo\r\n")
    with open(folder + "/b.txt", "w") as file:
        file.write("three")
    with open(folder + "/c.log", "w") as file:
        file.write("no")
    assert rows(readers.read_text_lines(spark, folder + "/*.txt")) == [("one",), ("three",), ("two",)]


def test_rows_and_views(spark):
    df = readers.frame_of(spark, [("Alice", 30), ("Bob", 25)], ["Name", "Age"])
    assert df.dtypes == [("Name", "string"), ("Age", "bigint")]
    assert rows(readers.view_of(df, "people_view")) == [("Alice", 30), ("Bob", 25)]
    assert rows(readers.frame_of(spark, [(-2.8,), (3.14,)], "X double")) == [(-2.8,), (3.14,)]


def test_inventory(spark, folder):
    import os

    os.makedirs(folder + "/sub")
    for name, size in (("a.bin", 1024 * 1024), ("sub/b.bin", 512)):
        with open(f"{folder}/{name}", "wb") as file:
            file.write(b"x" * size)
    files = inventory.file_inventory(spark, folder)
    assert values(files.orderBy("bytes"), "bytes") == [512, 1024 * 1024]
    assert rows(inventory.storage_size(files)) == [(2, 1024 * 1024 + 512, 1024.5, 1.0)]


def test_shared_paths_are_fresh(spark):
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_spread_deals_out_only_when_asked(spark):
    narrow = spark.range(100, numPartitions=1)
    assert spread(narrow, "id") is narrow
    assert spread(narrow, "id", partitions=5).rdd.getNumPartitions() == 5
    spark.conf.set(PARTITIONS_KEY, 3)
    try:
        assert spread(narrow, "id").rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(PARTITIONS_KEY)


TEXTS = ["a\nb", "c\r\nd", "  lead ", "", None, 'q "x" \\', "%0A %N |,", "end\\"]


def test_faithful_csv_keeps_every_text_and_time(spark, folder):
    rows_in = [(k, t, dt.datetime(2024, 1, 1, 0, 0, 0, 123456)) for k, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows_in, "id int, text string, moment timestamp_ntz")
    writers.write_csv(frame, folder + "/t", faithful=True)
    assert sorted(map(tuple, readers.read_csv(spark, folder + "/t", frame.schema, "|", faithful=True).collect())) == rows_in


def test_plain_csv_keeps_edges_quotes_and_microseconds(spark, folder):
    rows_in = [(1, "  lead ", dt.datetime(2024, 1, 1, 0, 0, 0, 123456)), (2, 'q "x" \\', None), (3, "end\\", None)]
    frame = spark.createDataFrame(rows_in, "id int, text string, moment timestamp_ntz")
    writers.write_csv(frame, folder + "/t")
    assert sorted(map(tuple, readers.read_csv(spark, folder + "/t", frame.schema, "|").collect())) == rows_in


def test_append_looks_at_the_header_of_the_folder(spark, folder):
    frame = spark.createDataFrame([(1, "x")], "id int, name string")
    writers.write_csv(frame, folder + "/t")
    other = frame.select("name", "id")
    with pytest.raises(writers.SchemaMismatch, match="folder"):
        writers.append_csv(other, folder + "/t", other.schema)
