from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import plan, rows, values
from tidemark.operators import aggregates as A, joins, ranking as R, reshape


@pytest.fixture(scope="module")
def sales(spark):
    data = [("a", 1, 10.0), ("a", 2, None), ("b", 3, 5.0), ("b", 4, 7.0), (None, 5, 1.0)]
    return spark.createDataFrame(data, "k string, n int, v double")


def test_extremes_skip_nulls(sales):
    assert rows(A.extremes(sales, ["k"], "v", "v")) == [(None, 1.0, 1.0), ("a", 10.0, 10.0), ("b", 5.0, 7.0)]
    assert rows(A.extremes(sales, [], "n", "v", ("lo", "hi"))) == [(1, 10.0)]


def test_counts(sales):
    assert rows(A.row_count(sales)) == [(5,)]
    assert rows(A.distinct_count(sales, "k")) == [(2,)]
    assert rows(A.group_counts(sales, ["k"])) == [(None, 1), ("a", 2), ("b", 2)]
    assert rows(A.row_count(sales.where("false"))) == [(0,)]


def test_conditional_counts_keep_groups_without_hits(sales):
    got = A.conditional_counts(sales, ["k"], {"big": F.col("v") > 6, "tiny": F.col("v") < 0})
    assert rows(got) == [(None, 0, 0), ("a", 1, 0), ("b", 1, 0)]


def test_sums_of_products(sales):
    got = A.sums_of_products(sales, ["k"], {"total": ["n", "v"]}, {"count": "n"})
    assert rows(got) == [(None, 5.0, 5), ("a", 10.0, 3), ("b", 43.0, 7)]


def test_mean_of_ratios_is_not_ratio_of_sums(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 3), ("a", 0, 0)], "k string, p long, w long")
    assert rows(A.mean_ratio_percent(df, ["k"], "p", "w", "r")) == [("a", 66.67)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), (None, "x", 2), ("z", "x", 0)], "g string, k string, n long")
    got = A.share_of_total(df, ["g"], "n")
    assert rows(got) == [(None, "x", 2, 100.0), ("a", "x", 1, 25.0), ("a", "y", 3, 75.0), ("z", "x", 0, None)]
    assert "Window" not in plan(got)


def test_polynomials(spark):
    df = spark.createDataFrame([(n,) for n in (2, 3, 5, 7, 11, 13, 17, 19)], "x long")
    assert rows(A.polynomial_reduce(df, [], "x", {"cubes": (0, 0, 0, 1)}, {"top": (1, 9, -1)})) == [(15803, 21)]


def test_top_k_and_ends(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "i int, m int")
    top = R.top_k(df, [F.desc("m"), F.asc("i")], 3)
    assert values(top, "i") == [2, 5, 8]
    assert "TakeOrderedAndProject" in plan(top)
    assert values(R.first_rows(df, "i", 2), "i") == [0, 1]
    assert values(R.last_rows(df, "i", 2), "i") == [9, 8]


def test_top_k_per_group_with_and_without_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 2), ("a", 2), ("b", 1)], "g string, v int")
    tied = R.top_k_per_group(df, ["g"], [F.desc("v")], 3, position="p")
    assert rows(tied) == [("a", 2, 3), ("a", 2, 3), ("a", 3, 1), ("a", 3, 1), ("b", 1, 1)]
    cut = R.top_k_per_group(df, ["g"], [F.desc("v")], 3, ties=False)
    assert rows(cut) == [("a", 2), ("a", 3), ("a", 3), ("b", 1)]
    assert "WindowGroupLimit" in plan(tied) and "WindowGroupLimit" in plan(cut)


def test_lowest_per_group_ignores_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), ("a", 2), ("b", 5), ("b", 9)], "g string, v int")
    assert rows(R.lowest_per_group(df, ["g"], "v")) == [("a", 2), ("a", 2), ("b", 5)]
    nameless = spark.createDataFrame([(None, 4), (None, 3), ("c", None)], "g string, v int")
    assert rows(R.lowest_per_group(nameless, ["g"], "v")) == [(None, 3)]
    assert "Window" not in plan(R.lowest_per_group(df, ["g"], "v"))


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 10, "old"), (1, 20, "new"), (2, 5, "only")], "k int, t int, v string")
    assert rows(R.latest_per_key(df, ["k"], [F.desc("t")])) == [(1, 20, "new"), (2, 5, "only")]


def test_positions(spark):
    df = spark.createDataFrame([("a", 5), ("a", 9), ("b", 1)], "g string, v int")
    assert rows(R.position_in_group(df, ["g"], [F.desc("v")])) == [("a", 5, 2), ("a", 9, 1), ("b", 1, 1)]


@pytest.mark.parametrize("count", [0, 1, 5000])
def test_ordered_index_has_no_gaps(spark, count):
    df = spark.range(count, numPartitions=7).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("v"), "id")
    got = R.ordered_index(df, [F.desc("v"), F.asc("id")]).collect()
    expected = sorted(((row["v"], row["id"]) for row in got), key=lambda p: (-p[0], p[1]))
    assert [(r["v"], r["id"]) for r in sorted(got, key=lambda r: r["Pos"])] == expected
    assert sorted(r["Pos"] for r in got) == list(range(1, count + 1))


def test_ordered_index_per_group_with_a_hot_group(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("g"), F.col("id") % 40))
    df = spark.range(3000, numPartitions=5).select(hot.alias("g"), "id")
    got = R.ordered_index(df, [F.asc("id")], ["g"]).collect()
    groups = {}
    for row in got:
        groups.setdefault(row["g"], []).append((row["id"], row["Pos"]))
    assert len(got) == 3000 and None in groups
    for members in groups.values():
        assert [pos for _, pos in sorted(members)] == list(range(1, len(members) + 1))


def test_sample_by_suffix(spark):
    ids = ["A-1", "A-2", "A-3", "A-1_Z1", "A-2_Z1", "A-9_Z2", "A-7_Z9"]
    df = spark.createDataFrame([(i,) for i in ids], "ID string")
    got = R.sample_by_suffix(df, "ID", ["Z1", "Z2", "9_Z2"], 2)
    assert values(got.orderBy("ID"), "ID") == ["A-1", "A-1_Z1", "A-2", "A-2_Z1", "A-9_Z2", "A-9_Z2"]


def test_unions(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([("y", 2)], "s string, i int")
    assert rows(reshape.union_all([a, b, a])) == [(1, "x"), (1, "x"), (2, "y")]
    c = spark.createDataFrame([(3, "z")], "other int, name string")
    assert rows(reshape.positional_union([a, c])) == [(1, "x"), (3, "z")]


def test_both_sides_reads_the_input_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    sides = [{"side": F.lit("a"), "v": F.col("o_custkey")}, {"side": F.lit("b"), "v": -F.col("o_custkey")}]
    got = reshape.both_sides(orders, ["o_orderkey"], sides)
    assert got.count() == 2 * orders.count() and got.agg(F.sum("v")).first()[0] == 0
    assert plan(got).count("Scan parquet") == 2  # once in the tree and once in its details


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.sampled_from("XYZ"), st.integers(0, 3), st.integers(0, 3)), max_size=9))
def test_both_sides_equals_a_union(spark, games):
    df = spark.createDataFrame(games, "home string, away string, hg int, ag int")
    sides = [
        {"team": F.col("home"), "f": F.col("hg"), "a": F.col("ag")},
        {"team": F.col("away"), "f": F.col("ag"), "a": F.col("hg")},
    ]
    got = Counter(tuple(r) for r in reshape.both_sides(df, [], sides).collect())
    assert got == Counter([(h, x, y) for h, _, x, y in games] + [(a, y, x) for _, a, x, y in games])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 4)), max_size=12), st.integers(1, 4))
def test_top_k_per_group_equals_a_model(spark, data, k):
    df = spark.createDataFrame(data, "g string, v int")
    tied, cut = Counter(), Counter()
    for group in "ab":
        ordered = sorted((v for g, v in data if g == group), reverse=True)
        tied.update((group, v) for v in ordered if sum(o > v for o in ordered) < k)
        cut.update((group, v) for v in ordered[:k])
    for ties, expected in ((True, tied), (False, cut)):
        got = ranking_rows(R.top_k_per_group(df, ["g"], [F.desc("v")], k, ties))
        assert got == expected


def ranking_rows(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())


def test_keyed_join_keeps_the_left_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "id int, v string")
    b = spark.createDataFrame([(1, "p"), (1, "q"), (None, "r")], "ref int, w string")
    assert rows(joins.keyed_join(a, b, {"id": "ref"})) == [(1, "x", "p"), (1, "x", "q")]
    c = spark.createDataFrame([(1, "x", 5), (1, "y", 6)], "id int, v string, n int")
    assert rows(joins.keyed_join(c, c, {"id": "id", "v": "v"}).select("id", "v")) == [(1, "x"), (1, "y")]
    assert rows(joins.lookup(a, b.withColumnRenamed("ref", "id"), "id")) == [(1, "x", "p"), (1, "x", "q")]


def test_numbering_in_groups_shuffles_no_rows_by_group(spark):
    df = spark.range(0, 2_000, numPartitions=4).select("id", (F.col("id") % 3).alias("g"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(R.ordered_index(df, [F.asc("id")], ["g"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(g#" not in text and "hashpartitioning(_part#" in text


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_numbering_in_groups_across_parts(spark, parts):
    # One group over several parts, groups within a part, and groups that end at a border.
    sizes = {0: 500, 1: 3, 2: 900, None: 40, 4: 1, 5: 250}
    data = [(g, k) for g, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(data, "g int, v int").repartition(parts)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = R.ordered_index(df, [F.desc("v")], ["g"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted((str(r["g"]), r["v"], r["Pos"]) for r in got) == sorted((str(g), v, sizes[g] - v) for g, v in data)
