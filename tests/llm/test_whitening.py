"""Whitening against a plain eigenvalue solver and exact sums."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import queries, whitening


def symmetric(rng, values):
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("seed", range(6))
def test_polar_factor(seed):
    rng = np.random.default_rng(seed)
    a = symmetric(rng, rng.standard_normal(17) * 10.0 ** rng.integers(-6, 6, 17))
    u = whitening.polar_factor(a)
    assert np.abs(u @ u.T - np.eye(17)).max() < 1e-13
    h = u.T @ a
    assert np.abs(h - h.T).max() < 1e-13 * np.abs(a).max() and np.linalg.eigvalsh((h + h.T) / 2).min() > -1e-12 * np.abs(a).max()


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [5.0, 5.0, 5.0],
        [0.0, 0.0, 0.0, 0.0],
        [9.0, 0.0, 0.0, 0.0, 0.0],
        [1.0, 1.0, 2.0, 2.0, 2.0, 7.0, 7.0],
        [1e6, 1.0, 1e-6, 1e-9],
        list(np.linspace(1, 2, 40)),
        [1 + 1e-13 * k for k in range(12)],
        [4.0, -4.0, 1.0, -1.0, 0.0],
        [2.0**-k for k in range(50)],
    ],
)
def test_components_of_any_spectrum(values):
    for seed in range(3):
        a = symmetric(np.random.default_rng(seed), np.array(values))
        got, q = whitening.principal_components(a)
        size = max(np.abs(values).max(), 1e-300)
        assert np.abs(q.T @ q - np.eye(len(values))).max() < 1e-13
        assert np.abs(q.T @ a @ q - np.diag(got)).max() < 1e-13 * size
        assert np.abs(np.sort(got) - np.sort(values)).max() < 1e-13 * size and (np.diff(got) <= 0).all()


def rows_of(rng, n, d):
    scale = 0.3 / (1 + np.arange(d))
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    return (rng.standard_normal((n, d)) * scale) @ turn.T + rng.standard_normal(d)


def expected(rows, k):
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in r] for r in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(v) for v in ((n * x - s) ** 2).sum(axis=1)]
    centred = ((n * x - s) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return deviation, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_query_equals_brute_force(spark, folder):
    rng = np.random.default_rng(2)
    vectors = rows_of(rng, 700, 12).astype(np.float32)
    rows = [(i, [float(c) for c in v], 1.0) for i, v in enumerate(vectors)]
    bad = [(900, None, 0.0), (901, [float("nan")] * 12, 0.0), (902, [None] + [0.1] * 11, 0.0), (903, [float("inf")] + [0.0] * 11, 0.0), (904, [], 0.0), (905, [0.5] * 3, 0.0)]
    spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, n double").repartition(5).write.parquet(f"{folder}/embeddings.parquet")
    got = {(r["vec_id"], r["component"]): r for r in queries.op12_embedding_whitening(spark, folder).collect()}
    assert set(got) == {(i, c) for i in range(700) for c in range(1, 9)}
    deviation, whitened, explained = expected(vectors, 8)
    for c in range(8):
        mine = np.array([got[i, c + 1]["whitened"] for i in range(700)])
        sign = np.sign(mine @ whitened[:, c])
        assert np.abs(mine - sign * whitened[:, c]).max() < 1e-9
        assert abs(got[0, c + 1]["explained"] / explained[c] - 1) < 1e-9
    assert all(got[i, c]["deviation"] == deviation[i] and got[i, c]["n"] == 700 for i, c in got)
    assert len({r["identity_error"] for r in got.values()}) == 1 and got[0, 1]["identity_error"] < 1e-9


def test_partitioning_changes_nothing_but_the_last_digits(spark):
    vectors = rows_of(np.random.default_rng(5), 300, 6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    one, seven = (sorted(map(tuple, whitening.whiten(df.repartition(k)).collect())) for k in (1, 7))
    # The fit is exact sums, so only the measured error of the identity may differ.
    assert [r[:6] for r in one] == [r[:6] for r in seven]


def test_rows_that_do_not_vary(spark):
    schema = "vec_id long, embedding array<double>"
    same = whitening.whiten(spark.createDataFrame([(1, [0.25, 0.5])] * 3 + [(None, [0.25, 0.5])], schema)).collect()
    assert len(same) == 8 and all((r["whitened"], r["explained"], r["deviation"], r["identity_error"]) == (0.0, 0.0, 0, 0.0) for r in same)
    line = whitening.whiten(spark.createDataFrame([(k, [0.5 * k, -0.5 * k, 1.0]) for k in range(5)], schema)).collect()
    second = [r for r in line if r["component"] > 1]
    assert all(r["whitened"] == 0.0 and abs(r["explained"]) < 1e-12 for r in second) and line[0]["identity_error"] < 1e-12
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, []), (3, [float("nan")])], schema)).count() == 0


def test_huge_entries(spark):
    rng = random.Random(1)
    rows = [[rng.uniform(-1e9, 1e9), rng.uniform(-1, 1), 1e12] for _ in range(50)]
    df = spark.createDataFrame([*enumerate(rows), (99, [1e300, 0.0, 0.0])], "vec_id long, embedding array<double>")
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(df).collect()}
    deviation, whitened, _ = expected(rows, 1)
    assert {i for i, _ in got} == set(range(50))
    assert all(got[i, 1]["deviation"] == (v if v < 1 << 63 else None) for i, v in enumerate(deviation))
    mine = np.array([got[i, 1]["whitened"] for i in range(50)])
    assert np.abs(np.abs(mine) - np.abs(whitened[:, 0])).max() < 1e-9


def test_clashing_columns_and_key_types(spark):
    df = spark.createDataFrame([("a", [0.1 * k, 0.2], k, k, "x") for k in range(9)], "name string, v array<double>, component long, n int, s string")
    got = whitening.whiten(df, "name", "v", 1).collect()
    assert len(got) == 9 and got[0]["vec_id"] == "a" and {r["component"] for r in got} == {1}
