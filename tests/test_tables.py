import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import plan, rows, values
from tidemark.operators import tables as M

FORMAT = "id string, city string, f double, c double"


@pytest.fixture(scope="module")
def target(spark):
    data = [(f"Z{i}", "LA", 40.0 + i, None) for i in range(3)] + [(f"A{i}", "WH", 31.0, None) for i in range(3)]
    return spark.createDataFrame(data, FORMAT)


def test_upsert_updates_inserts_and_keeps(spark, target):
    news = [("Z0", "LA", 63.6), ("Z1", "LA", 59.9), ("Z2", "LA", 13.5), ("Z8", "LA", 7.7), ("Z9", "LA", 85.4)]
    source = spark.createDataFrame(news, "id string, city string, f double")
    merged = M.merge_upsert(target, source, ["id"])
    assert merged.columns == target.columns
    assert rows(merged) == [
        ("A0", "WH", 31.0, None),
        ("A1", "WH", 31.0, None),
        ("A2", "WH", 31.0, None),
        ("Z0", "LA", 63.6, None),
        ("Z1", "LA", 59.9, None),
        ("Z2", "LA", 13.5, None),
        ("Z8", "LA", 7.7, None),
        ("Z9", "LA", 85.4, None),
    ]
    filled = M.update_where(merged, {"c": F.round((F.col("f") - 32) * 5 / 9, 1)})
    kept = M.delete_where(filled, F.col("c") < -12)
    assert sorted(values(kept, "c")) == [-10.3, -0.6, -0.6, -0.6, 15.5, 17.6, 29.7]


def test_upsert_limits_the_columns(spark, target):
    source = spark.createDataFrame([("Z0", "SF", 1.0, 2.0), ("N", "SF", 3.0, 4.0)], FORMAT)
    merged = M.merge_upsert(target, source, ["id"], update=["f"], insert=["city"])
    assert ("Z0", "LA", 1.0, None) in rows(merged) and ("N", "SF", None, None) in rows(merged)


def test_upsert_rejects_two_source_rows_for_one_target_row(spark, target):
    double = spark.createDataFrame([("Z0", "a", 1.0), ("Z0", "b", 2.0)], "id string, city string, f double")
    merged = M.merge_upsert(target, double, ["id"])
    for read in (merged.collect, merged.count, merged.select("c").distinct().collect):
        with pytest.raises(Exception, match=M.DUPLICATE_MATCH):
            read()


def test_upsert_inserts_all_unmatched_duplicates_and_null_keys(spark, target):
    extra = [("N", "a", 1.0), ("N", "b", 2.0), (None, "c", 3.0), (None, "d", 4.0)]
    source = spark.createDataFrame(extra, "id string, city string, f double")
    with_null = target.unionByName(spark.createDataFrame([(None, "old", 0.0, None)], FORMAT))
    merged = M.merge_upsert(with_null, source, ["id"])
    assert merged.count() == 7 + 4
    assert [row for row in rows(merged) if row[1] in "abcd"] == [
        (None, "c", 3.0, None),
        (None, "d", 4.0, None),
        ("N", "a", 1.0, None),
        ("N", "b", 2.0, None),
    ]


def test_upsert_keeps_the_target_types_and_rejects_unknown_columns(spark, target):
    source = spark.createDataFrame([("Z0", 7), ("N", 8)], "id string, f int")
    merged = M.merge_upsert(target, source, ["id"])
    assert merged.dtypes == target.dtypes
    assert ("N", None, 8.0, None) in rows(merged) and ("Z0", "LA", 7.0, None) in rows(merged)
    for wrong in ({"keys": ["x"]}, {"keys": ["id"], "update": ["city"]}, {"keys": ["id"], "insert": ["x"]}):
        with pytest.raises(ValueError, match="not columns"):
            M.merge_upsert(target, source, **wrong)


def test_update_keeps_the_column_type_and_rejects_unknown_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert M.update_where(df, {"a": F.lit(9.0)}, F.col("b") == 2).dtypes == df.dtypes
    with pytest.raises(ValueError, match="no such columns"):
        M.update_where(df, {"z": F.lit(1)})


def test_upsert_has_no_full_outer_join(spark, target):
    text = plan(M.merge_upsert(target, target, ["id"]))
    assert "FullOuter" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9)), max_size=8)


@settings(max_examples=25, deadline=None)
@given(old=keyed, new=st.lists(st.tuples(st.integers(0, 7), st.integers(10, 19)), max_size=6, unique_by=lambda r: r[0]))
def test_upsert_matches_a_model(spark, old, new):
    fields = "k int, v int"
    merged = M.merge_upsert(spark.createDataFrame(old, fields), spark.createDataFrame(new, fields), ["k"])
    changes = dict(new)
    expected = [(k, changes.get(k, v)) for k, v in old]
    expected += [(k, v) for k, v in new if k not in {k for k, _ in old}]
    assert sorted(rows(merged), key=str) == sorted(expected, key=str)


@settings(max_examples=25, deadline=None)
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.integers(0, 3)), max_size=8))
def test_update_and_delete_match_a_model(spark, data):
    df = spark.createDataFrame(data, "a int, b int")
    swapped = M.update_where(df, {"a": F.col("b"), "b": F.col("a")}, F.col("a") > 0)
    assert sorted(rows(swapped), key=str) == sorted(((b, a) if a is not None and a > 0 else (a, b) for a, b in data), key=str)
    left = M.delete_where(df, F.col("a") > 0)
    assert sorted(rows(left), key=str) == sorted(((a, b) for a, b in data if a is None or a <= 0), key=str)


def test_always_true_condition(spark, target):
    assert set(values(M.update_where(target, {"c": F.lit(1.0)}, F.expr("true")), "c")) == {1.0}


def test_evolve_append_unites_the_columns(spark):
    old = spark.createDataFrame([("a", 1.0)], "id string, f double")
    new = spark.createDataFrame([("x", "b", 2.0)], "added string, id string, c double")
    both = M.evolve_append(old, new)
    assert both.columns == ["id", "f", "added", "c"]
    assert rows(both) == [("a", 1.0, None, None), ("b", None, "x", 2.0)]


def test_evolve_append_rejects_another_type(spark):
    old, new = spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([("1",)], "id string")
    with pytest.raises(ValueError, match="id"):
        M.evolve_append(old, new)
