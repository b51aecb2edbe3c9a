"""Line dedup against its definition, and stores that change against stores made anew."""

import hashlib
import random

import pytest

from odd_rows import ODD
from tidemark.llm import lines, queries
from tidemark.llm.cuckoo import CuckooFilter, Layers, halves

BLANK = " \t\n\x0b\x0c\r"


def plain_key(line):
    key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))
    return key if len(key) >= 10 else None


def plain_rows(rows):
    holders = {}
    for d, t in rows:
        if d is not None:
            for line in (t or "").split("\n"):
                holders.setdefault(plain_key(line), set()).add(d)
    out = []
    for d, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if d is None or plain_key(x) is None or min(holders[plain_key(x)]) == d]
        out.append((d, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def keys_of(values):
    return halves([hashlib.md5(str(v).encode()).digest() for v in values])


@pytest.mark.parametrize("seed", range(5))
def test_filter_holds_what_it_was_given(seed):
    rng = random.Random(seed)
    f, held = CuckooFilter(256), set()
    for _ in range(30):
        new = rng.sample(range(10_000), rng.randrange(60))
        new = [v for v in new if v not in held]
        refused = set(f.insert(keys_of(new)).tolist()) if new else set()
        held |= {v for k, v in enumerate(new) if k not in refused}
        out = rng.sample(sorted(held), min(len(held), rng.randrange(50)))
        if out:
            assert not len(f.delete(keys_of(out)))
            held -= set(out)
        assert f.items == len(held)
        if held:
            assert f.contains(keys_of(sorted(held))).all()
            again = CuckooFilter(256, f.table.tobytes())
            assert again.contains(keys_of(sorted(held))).all()


def test_a_refused_key_changes_nothing():
    f = CuckooFilter(4)
    assert len(f.insert(keys_of(range(400)))) >= 400 - 16
    before = f.table.copy()
    assert not f._kick(12345, 1) and (f.table == before).all()


@pytest.mark.parametrize("seed", range(4))
def test_layers_lose_no_key(seed):
    rng = random.Random(seed)
    layers, held = Layers([], 16), set()
    for _ in range(40):
        new = [v for v in rng.sample(range(100_000), 200) if v not in held]
        layers.insert(keys_of(new))
        held |= set(new)
        out = rng.sample(sorted(held), min(len(held), rng.randrange(250)))
        assert not out or not len(layers.delete(keys_of(out)))
        held -= set(out)
        assert not held or layers.contains(keys_of(sorted(held))).all()
        layers = Layers(layers.tables(), 16)
    assert len(layers.filters) > 1 and sum(f.items for f in layers.filters) == len(held)


def test_false_alarms_are_few():
    f = CuckooFilter.for_keys(20_000)
    assert not len(f.insert(keys_of(range(20_000))))
    assert f.contains(keys_of(range(50_000, 150_000))).mean() < 0.001


def corpus(rng, ids):
    common = [f"{w} line that many hold" for w in "ABCDEFGH"]
    out = []
    for d in ids:
        own = [rng.choice([rng.choice(common), rng.choice(common).lower(), f" {rng.choice(common)}\t", f"only here {rng.random()}", "short", "", "é" * rng.choice([9, 10])]) for _ in range(rng.randrange(0, 9))]
        out.append((d, "\n".join(own)))
    return out


def test_query_equals_brute_force(spark, folder):
    rng = random.Random(3)
    rows = corpus(rng, rng.sample(range(10_000), 200))
    rows += [(rows[0][0], rows[1][1]), rows[2], rows[2], (20_000, None), (20_001, ""), (None, rows[3][1]), (-5, rows[4][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(5)
    docs.write.parquet(f"{folder}/documents.parquet")
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain_rows(rows)]
    assert sorted(map(tuple, queries.op11_line_dedup(spark, folder).collect()), key=str) == sorted(want, key=str)


def state(store):
    return sorted(tuple(r) for r in store.counts.select("key", "shard", "texts", "first", "last").collect())


def missing(store):
    """Counted lines that their filters do not know, and fingerprints beyond one for each line."""
    tables, keys = {}, {}
    for r in store.filters.orderBy("shard", "layer").collect():
        tables.setdefault(r["shard"], []).append(bytes(r["table"]))
    for r in store.counts.collect():
        keys.setdefault(r["shard"], []).append(bytes(r["key"]))
    items = sum(f.items for t in tables.values() for f in Layers(t, 1).filters)
    lost = sum((~Layers(tables[s], 1).contains(halves(k))).sum() for s, k in keys.items())
    return lost, items - sum(map(len, keys.values()))


def test_insertions_and_deletions_can_be_taken_back(spark, folder, monkeypatch):
    monkeypatch.setattr(lines, "SHARD", 16)
    rng = random.Random(8)
    schema = "doc_id long, text string"
    first, second = corpus(rng, range(0, 120, 2)), corpus(rng, range(1, 120, 2))
    df = lambda rows: spark.createDataFrame(rows, schema)
    store = lines.new_store(df(first))
    assert store.shards > 1
    both = lines.insert(store, df(second))
    whole = lines.new_store(df(first + second))
    assert [r[:1] + r[2:] for r in state(both)] == [r[:1] + r[2:] for r in state(whole)] and missing(both) == (0, 0)
    assert sorted(map(tuple, lines.kept_lines(both, df(first + second)).collect()), key=str) == plain_rows(first + second)
    # What was inserted once is not counted again.
    assert state(lines.insert(both, df(second[:20]))) == state(both)
    # The second batch out again, and a name that nobody has.
    lines.write_store(both, f"{folder}/store")
    back = lines.delete(lines.read_store(spark, f"{folder}/store"), df([(d, "") for d, _ in second] + [(7777, "")]))
    assert state(back) == state(store) and missing(back) == (0, 0)
    # The least holders out: the lines stay in the next documents.
    rest = [r for r in first + second if r[0] >= 15]
    less = lines.delete(both, df([(d, "") for d in range(15)]))
    assert sorted(map(tuple, lines.kept_lines(less, df(rest)).collect()), key=str) == plain_rows(rest) and missing(less) == (0, 0)
    none = lines.delete(less, df(rest))
    assert none.counts.count() == 0 and missing(none) == (0, 0) and none.postings.count() == 0


def test_false_alarms_of_the_filter_are_looked_up(spark):
    # Filters that know every line beside counts that know none: each answer is a false alarm.
    df = spark.createDataFrame(corpus(random.Random(1), range(40)), "doc_id long, text string")
    whole, none = lines.new_store(df), lines.new_store(df.limit(0))
    got = lines.insert(lines.LineStore(none.postings, none.counts, whole.filters, whole.shards), df)
    assert state(got) == state(whole) and missing(got) == (0, whole.counts.count())


def test_odd_rows_of_lines(odd, nothing):
    got = {}
    for r in lines.line_dedup(odd).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(ODD)
    assert [(r["n_lines"], r["n_dropped"]) for d in (1, 2, 3) for r in got[d]] == [(1, 0), (1, 0), (2, 0)]
    assert all(r["n_dropped"] == 0 for d in (4, 5, 6, 7, None) for r in got[d])
    assert lines.line_dedup(nothing).count() == 0
