"""Every registered query against its SQL, and the shape of the plans."""

import os
import re

import pytest

import __spark_entry__ as registered
from compare import connect, oracle_result, spark_result, type_differences
from helpers import plan
from tidemark.catalog.oracles import ORACLES as CATALOG_SQL
from tidemark.catalog.queries import REGISTRY

# The queries of the library itself; those of the corpus operators have tests of their own.
QUERIES, ORACLES = REGISTRY, CATALOG_SQL
PYTHON_STEP = {name for name in QUERIES if name.startswith("image_") and name != "image_pixels_by_columns"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLES])
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns, got = spark_result(df)
    expected_columns, expected = oracle_result(duck, ORACLES[name])
    assert columns == expected_columns
    assert got == expected
    assert type_differences(df, duck, ORACLES[name]) == []
    # No comparison of all pairs, no Python per row; only image decoding hands batches to Python.
    text = plan(df)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", text)
    assert ("MapInArrow" in text) == (name in PYTHON_STEP)


def test_entry_returns_the_league_table(spark):
    got = registered.entry(spark)
    assert got.columns[:2] == ["Pos", "Team"] and got.count() == 10


def test_no_data_is_kept_in_the_repository():
    root = os.path.dirname(os.path.abspath(registered.__file__))
    kept = [f for _, _, files in os.walk(root) for f in files if f.endswith((".parquet", ".csv", ".png"))]
    assert kept == []
