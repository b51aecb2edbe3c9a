"""Periodic runs against their definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from odd_rows import ODD
from tidemark.llm import queries, runs


def plain_runs(words, least=6):
    """Every stretch with its smallest period, by looking at all periods of all places."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - s >= max(least, 4 * p):
                found.setdefault((s, i + p), p)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def plain_result(doc_id, text):
    words = (text or "").translate({k: " " for k in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + length for s, length, q in found)]
    best = None
    for s, length, q in sorted(found, key=lambda r: (r[0], r[2])):
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    ordered = sorted(found, key=lambda r: (r[0], r[2]))
    return (
        doc_id,
        len(found),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in ordered).encode()).hexdigest(),
        hashlib.sha256(" ".join(kept).encode()).hexdigest(),
    )


def sequence(rng, n, letters):
    """Noise, repeats of short words, repeats of repeats."""
    out = []
    while len(out) < n:
        part = [rng.randrange(letters) for _ in range(rng.randrange(1, 6))]
        if rng.random() < 0.4:
            part = part * rng.randrange(2, 7)
        if rng.random() < 0.2:
            part = (part + [rng.randrange(letters)]) * rng.randrange(2, 6)
        out += part
    return out[:n]


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_their_definition(seed):
    rng = random.Random(seed)
    texts = [sequence(rng, rng.randrange(0, 260), rng.choice([1, 2, 3, 9])) for _ in range(25)]
    got = runs.runs_of([np.array(t, dtype=np.int64) for t in texts], 6)
    assert [sorted(map(tuple, g.tolist())) for g in got] == [plain_runs(t) for t in texts]
    some = runs.may_repeat([np.array(t, dtype=np.int64) for t in texts], 6)
    assert all(s or not len(g) for s, g in zip(some, got))


@pytest.mark.parametrize("seed", range(4))
def test_extensions_equal_their_definition(seed):
    rng = random.Random(seed)
    texts = [sequence(rng, 120, 2) for _ in range(3)]
    flat = [x for k, t in enumerate(texts) for x in (-2 - k, *t)] + [-1]
    levels = runs.recompressed(np.array(flat, dtype=np.int64))
    assert len(levels[-1].symbols) == 7 and len(levels) < 60
    pairs = [(k * 121 + 1 + i, k * 121 + 1 + j) for k in range(3) for i in range(120) for j in range(i + 1, 120)]
    a, b = np.array(pairs).T
    for step in (1, -1):
        want = []
        for i, j in pairs:
            n = 0
            while flat[i + step * n] == flat[j + step * n]:
                n += 1
            want.append(n)
        assert runs.extended(levels, a, b, step).tolist() == want


def test_candidates_come_in_chunks(monkeypatch):
    rng = random.Random(3)
    texts = [np.array(sequence(rng, 300, 2), dtype=np.int64) for _ in range(8)]
    whole = [r.tolist() for r in runs.runs_of(texts, 6)]
    monkeypatch.setattr(runs, "CHUNK", 7)
    assert [r.tolist() for r in runs.runs_of(texts, 6)] == whole


def test_query_equals_brute_force(spark, folder):
    rng = random.Random(5)
    rows = []
    for d in range(300):
        words = [f"w{x}" for x in sequence(rng, rng.randrange(0, 150), 4)]
        rows.append((d, rng.choice([" ", "\n", " \t\x0b"]).join(words), "x"))
    rows += [(1000 + d, " ".join(f"u{rng.randrange(10_000)}" for _ in range(200)), "x") for d in range(100)]
    rows += [(2000, "Größe " * 9, "x"), (2001, None, "x"), (2001, "a b " * 6 + "a\x85b", "x"), (None, "é é é é é é", "x"), (2002, " \n", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{folder}/documents.parquet")
    got = queries.op13_periodic_runs(spark, folder).collect()
    want = [plain_result(d, t) for d, t, _ in rows]
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in want if r[0] and r[0] >= 1000)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_collapsed_texts(spark):
    docs = spark.createDataFrame([(1, "x  say it again say it again say it again say it again y")], "doc_id long, text string")
    row = runs.periodic_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 12, 3)] and row["collapsed"] == "x say it again y" and row["n_words"] == 14


def test_odd_rows_of_runs(odd, nothing):
    got = {}
    for r in runs.run_digests(odd).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(ODD) and len(got[4]) == 2
    empty = hashlib.sha256(b"").hexdigest()
    for d in (1, 2, 3):
        assert got[d][0]["n_runs"] == 0 and got[d][0]["start"] is None and got[d][0]["collapsed_sha256"] == empty
    long = got[5][0]
    assert (long["n_runs"], long["start"], long["length"], long["period"]) == (1, 0, 120_000, 2)
    assert long["collapsed_sha256"] == hashlib.sha256(b"long word").hexdigest()
    assert runs.run_digests(nothing).count() == 0
    assert runs.with_planted_tails(odd).columns == odd.columns and runs.with_planted_tails(nothing).count() == 0
