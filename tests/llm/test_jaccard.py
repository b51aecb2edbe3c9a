"""The Jaccard join against all pairs."""

import random
import tracemalloc

import pyarrow as pa
import pytest

from odd_rows import ODD
from tidemark.llm import jaccard
from tidemark.llm.components import components
from tidemark.llm.texts import parts


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(5)]))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain(rows):
    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {d: (len(sets[d]), root) for d, root in roots(ids, links).items()}


def varied(rng, words, share):
    return [rng.choice("pqrstuvw") * rng.randrange(3, 9) if rng.random() < share else w for w in words]


def corpus(seed):
    """Groups of copies and near copies around the threshold, common passages, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts, passage = [], [word() for _ in range(40)]
    for _ in range(25):
        texts.append([word() for _ in range(rng.randrange(1, 90))] + passage * rng.randrange(2))
    base = [word() for _ in range(120)]
    for k in range(45):  # a large group with members on both sides of the threshold
        texts.append(varied(rng, base, rng.choice([0.0, 0.005, 0.01, 0.02, 0.03])))
    chain = [word() for _ in range(200)]
    for k in range(12):  # each is linked with its neighbours only
        texts.append(chain[5 * k : 5 * k + 100])
    texts += [["Aa", "b"], ["aA", "B"], ["b", "aa"], [], base, base]
    rows = [(d, " ".join(t)) for d, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,hubs", [(0, 8), (1, 1), (2, 2)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, seed, hubs):
    monkeypatch.setattr(jaccard, "HUBS", hubs)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs).collect()}
    assert got == plain(rows)
    kept = {r["doc_id"] for r in jaccard.one_per_component(docs).collect()}
    assert kept == {root for _, root in plain(rows).values()}


@pytest.mark.parametrize("n", range(1, 400))
def test_prefixes_share_what_the_first_filter_asks_for(n):
    # A partner has at least this many shingles, and shares what it looks for itself.
    least = jaccard.least_common(n)
    assert 5 * least >= 4 * n and jaccard.wanted(least) <= jaccard.wanted(n) <= least


def test_odd_rows(odd, nothing):
    rows = {r["doc_id"]: r for r in jaccard.jaccard_components(odd).collect()}
    assert set(rows) == {r[0] for r in ODD}
    assert rows[1]["n_shingles"] == rows[2]["n_shingles"] == rows[3]["n_shingles"] == 0
    assert rows[4]["component_id"] == 4 and rows[None]["component_id"] is None and rows[5]["n_shingles"] == 2
    assert jaccard.jaccard_components(nothing).count() == 0
    assert jaccard.one_per_component(odd).columns == odd.columns


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 150)] + [(150, 120)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == roots({n for pair in links for n in pair}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_short_copy_beside_a_long_text_of_its_key_is_linked(spark):
    rng = random.Random(21)
    some = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    short, near, long = some(14), some(44), some(1_000)
    rows = [(1, short), (2, near), (3, some(30)), (5, short), (5, long), (6, near + " end"), (6, some(900))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 5: 1, 6: 2}


def plain_keys(rows):
    """Components of keys with several texts: a key is linked through any of them."""
    texts = [(k, d, shingles(t)) for k, (d, t) in enumerate(rows)]
    links = [
        (a, b)
        for i, (_, a, s) in enumerate(texts)
        for _, b, t in texts[i + 1 :]
        if s and a != b and 100 * len(s & t) >= 80 * len(s | t)
    ]
    return roots({d for d, _ in rows}, links)


def test_texts_of_one_key_link_each_other(spark):
    rng = random.Random(4)
    some = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    a, b, c = some(200), some(150), some(120)
    near = [(1, a), (1, b), (2, a + " word"), (3, b + " word"), (4, c)]
    copies = [(15, a), (15, b), (12, a), (13, b), (14, c)]
    for rows, want in ((near, {1: 1, 2: 1, 3: 1, 4: 4}), (copies, {15: 12, 12: 12, 13: 12, 14: 14})):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
        assert got == want == plain_keys(rows)


def test_repeated_keys_equal_all_pairs(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(0, 70), t) for _, t in corpus(3)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, gone string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
    assert got == plain_keys(rows)
    left = jaccard.one_per_component(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == set(got.values())


@pytest.mark.parametrize("bits", [15, 17, 27])
def test_marks_lose_no_key(spark, monkeypatch, bits):
    monkeypatch.setattr(jaccard, "MARK_BITS", bits)
    rows = spark.range(40_000).selectExpr("id * 7919 - 100000000 AS doc_id", "'x' AS text")
    keys = rows.where("doc_id % 11 = 0").select("doc_id")
    got = {r["doc_id"] for r in jaccard._likely(rows, keys, "doc_id").collect()}
    want = {r["doc_id"] for r in keys.collect()}
    assert want <= got and (bits < 27 or len(got) < 1.01 * len(want))
    assert jaccard._likely(rows, keys.limit(0), "doc_id").count() == 0


def test_memory_of_a_task_follows_a_part_not_its_batch(spark, monkeypatch):
    rng = random.Random(9)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(20_000)]
    texts = [" ".join(rng.choices(pool, k=2_000)) for _ in range(1_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1_000)), pa.array([*texts[:-2], None, ""])], ["doc_id", "text"])
    docs, taken = spark.createDataFrame([], "doc_id long, text string"), []
    for step in (jaccard._sampled, jaccard.shingle_classes):
        with monkeypatch.context() as patch:
            patch.setattr(type(docs), "mapInArrow", lambda self, run, schema: taken.append(run) or self.withColumn("n", self["doc_id"]))
            step(docs, "doc_id", "text")
    for run in taken:
        tracemalloc.start()
        found = sum(b.num_rows - b.column("doc_id").null_count for b in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found >= 1_000 and peak < 4 * batch.nbytes


def test_parts_hold_every_text_once():
    texts = [None, "a" * 70, "", "bé" * 20, "c" * 500, "d", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]).slice(0, 7)
    for size in (1, 60, 120, 10_000):
        got = list(parts(batch, 0, size))
        assert [t for _, group in got for t in group] == [(t or "").encode() for t in texts]
        assert [start for start, _ in got] == [sum(len(g) for _, g in got[:k]) for k in range(len(got))]
        assert all(len(group) == 1 or sum(map(len, group)) <= size for _, group in got)
    assert list(parts(batch.slice(0, 0), 0, 9)) == []
