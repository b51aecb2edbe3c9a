import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import types as T

from helpers import rows
from tidemark.operators import widening as W

WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
NUMBERS = [*WHOLE, T.FloatType(), T.DoubleType(), T.DecimalType(5, 2), T.DecimalType(20, 0), T.DecimalType(38, 10)]


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "long", "long"),
        ("tinyint", "smallint", "smallint"),
        ("long", "decimal(12,2)", "decimal(21,2)"),
        ("int", "decimal(5,4)", "decimal(14,4)"),
        ("decimal(10,2)", "decimal(8,5)", "decimal(13,5)"),
        ("int", "double", "double"),
        ("float", "double", "double"),
        ("smallint", "float", "float"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("void", "string", "string"),
        ("array<int>", "array<long>", "array<long>"),
        ("map<string,int>", "map<string,decimal(3,1)>", "map<string,decimal(11,1)>"),
    ],
)
def test_types_meet(a, b, want):
    assert W.merged_type(kind(a), kind(b)) == kind(want) == W.merged_type(kind(b), kind(a))


@pytest.mark.parametrize(
    "a, b",
    [("string", "int"), ("long", "double"), ("int", "float"), ("decimal(38,10)", "decimal(38,0)"), ("double", "decimal(5,2)"), ("array<int>", "int"), ("struct<x:int>", "struct<x:string>"), ("boolean", "int")],
)
def test_clashes_raise(a, b):
    for one, other in ((a, b), (b, a)):
        with pytest.raises(W.TypeClash):
            W.merged_type(kind(one), kind(other))


def merged(*kinds):
    try:
        out = kinds[0]
        for k in kinds[1:]:
            out = W.merged_type(out, k)
        return out
    except W.TypeClash:
        return None


@given(st.sampled_from(NUMBERS), st.sampled_from(NUMBERS))
def test_merging_has_no_direction(a, b):
    assert merged(a, b) == merged(b, a) and merged(a, a) == a
    both = merged(a, b)
    assert both is None or merged(both, a) == both


def test_the_clash_names_its_place():
    with pytest.raises(W.TypeClash, match="state.code"):
        W.merged_schema(kind("struct<state:struct<code:int>>"), kind("struct<State:struct<CODE:string>>"))


def test_nested_rows_are_widened(spark):
    old = spark.createDataFrame(
        [(1, 5, (2, "a"), [(1,), None], {"p": 1}), (2, None, None, None, None)],
        "id int, n long, s struct<x:int,y:string>, items array<struct<q:int>>, m map<string,int>",
    )
    new = spark.createDataFrame(
        [(1 << 40, Decimal("1.25"), ("b", 1 << 50, dt.date(2024, 1, 1)), [(1 << 40, True)], {"p": 1 << 40}, "extra")],
        "ID long, n decimal(5,2), s struct<Y:string,x:long,z:date>, items array<struct<q:long,r:boolean>>, m map<string,long>, e string",
    )
    got = W.widening_append(old, new)
    assert got.schema.simpleString() == (
        "struct<id:bigint,n:decimal(21,2),s:struct<x:bigint,y:string,z:date>,items:array<struct<q:bigint,r:boolean>>,m:map<string,bigint>,e:string>"
    )
    first, second, third = sorted(got.collect(), key=lambda r: r["id"])
    assert first["n"] == 5 and tuple(first["s"]) == (2, "a", None) and first["items"] == [(1, None), None] and first["m"] == {"p": 1}
    assert second["s"] is None and second["items"] is None and second["n"] is None and second["e"] is None
    assert tuple(third["s"]) == (1 << 50, "b", dt.date(2024, 1, 1)) and third["items"] == [(1 << 40, True)] and third["e"] == "extra"


def test_generations_in_any_number(spark):
    frames = [spark.createDataFrame([(k,)], f"v {t}") for k, t in enumerate(("tinyint", "int", "long"))]
    out = frames[0]
    for frame in frames[1:]:
        out = W.widening_append(out, frame)
    assert out.dtypes == [("v", "bigint")] and rows(out) == [(0,), (1,), (2,)]
    with pytest.raises(W.TypeClash):
        W.widening_append(out, spark.createDataFrame([("x",)], "v string"))
