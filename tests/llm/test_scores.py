"""Language-model and toxicity scores."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from odd_rows import ODD
from tidemark.llm import suffix_tree, toxicity


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def language(rng, n):
    """Two languages with words of their own, so that the word before tells something."""
    rows = []
    for d in range(n):
        head = "xy"[d % 2]
        rows.append((d, " ".join(head + str(int(rng.random() ** 3 * 100)) for _ in range(rng.randrange(1, 80)))))
    return rows


def test_base_score_and_a_better_model(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "LEAST_COUNT", 20)
    rows = language(random.Random(0), 600)
    got = {r["doc_id"]: r for r in suffix_tree.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    counts = Counter(w for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for d, text in rows:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(text))
        r = got[d]
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 1) and r["train_tokens"] == n
        assert r["n_tokens"] == len(tokens(text)) and r["n_known"] == sum(counts[w] > 0 for w in tokens(text))
        assert abs(r["base_score"] - base) < 1e-6
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.05 * sum(r["n_tokens"] for r in held)


def test_distributions_sum_to_one():
    rng = random.Random(1)
    rows = [(0, 0, s, rng.randrange(1, 90)) for s in range(20)]
    rows += [(1, 5, s, rng.randrange(1, 9)) for s in range(6)] + [(2, (7 << suffix_tree.BITS) | 5, s, 3) for s in (1, 19)]
    # Some of what follows a longer context has been left out.
    sizes = {d: sum(r[3] for r in rows if r[0] == d) + 9 * (d > 0) for d in range(3)}
    rows = [(*r, sizes[r[0]]) for r in rows]
    tree = suffix_tree.SuffixTree(rows, 25)
    for node in tree.nodes:
        assert abs(sum(10 ** tree.log10(node, s) for s in range(25)) - 1) < 1e-9
    assert tree.longest(2, (7 << suffix_tree.BITS) | 5)[0] == 2 and tree.longest(2, (8 << suffix_tree.BITS) | 5) == (1, 5)
    assert tree.longest(2, 9) == (0, 0)


def plain_chances(rows, alphabet):
    """The smoothed chances of a tree as they are defined, for any context and symbol."""
    sizes, counts = {(0, 0): 0}, {(0, 0): {}}
    for depth, context, symbol, c, n in rows:
        sizes[depth, context] = n
        counts.setdefault((depth, context), {})[symbol] = c

    def chance(depth, context, symbol):
        node = next((d, context & ((1 << (suffix_tree.BITS * d)) - 1)) for d in range(depth, -1, -1) if (d, context & ((1 << (suffix_tree.BITS * d)) - 1)) in counts)
        own, n = counts[node], sizes[node]
        if not node[0]:
            return (own.get(symbol, 0) + 0.5) / (n + 0.5 * alphabet)
        left = (n - sum(own.values()) + suffix_tree.DISCOUNT * len(own)) / n
        kept = (own[symbol] - suffix_tree.DISCOUNT) / n if symbol in own else 0
        return kept + left * chance(node[0] - 1, node[1], symbol)

    return chance


@pytest.mark.parametrize("seed", range(4))
def test_tree_equals_its_definition(seed):
    rng, alphabet = random.Random(seed), 12
    contexts = [(0, 0)] + [(1, a) for a in range(3, 8)] + [(2, a << suffix_tree.BITS | b) for a in range(3, 12) for b in range(3, 12) if rng.random() < 0.3]
    rows = []
    for depth, context in contexts:
        own = {s: rng.randrange(1, 30) for s in rng.sample(range(alphabet), rng.randrange(1, alphabet))}
        n = sum(own.values()) + rng.randrange(5) * (depth > 0)
        rows += [(depth, context, s, c, n) for s, c in own.items()]
    rng.shuffle(rows)
    tree, want = suffix_tree.SuffixTree(rows, alphabet), plain_chances(rows, alphabet)
    for _ in range(400):
        depth = rng.randrange(3)
        context = sum(rng.randrange(3, 12) << (suffix_tree.BITS * k) for k in range(depth))
        symbol = rng.randrange(alphabet)
        assert abs(tree.log10(tree.longest(depth, context), symbol) - math.log10(want(depth, context, symbol))) < 1e-9
    assert abs(suffix_tree.SuffixTree([], 5).log10((0, 0), 3) - math.log10(0.2)) < 1e-12


@pytest.mark.parametrize("last_context", [3, 5, 9])
def test_word_keys_hold_the_longest_allowed_contexts(last_context):
    rng = np.random.default_rng(2)
    texts = [np.append(rng.integers(3, 10, rng.integers(0, 6)), suffix_tree.STOP) for _ in range(20)]
    keys = list(suffix_tree.word_keys(texts, last_context))
    at = 0
    for t in texts:
        whole = [suffix_tree.STOP, suffix_tree.STOP, *[int(x) for x in t]]
        for k in range(2, len(whole)):
            for d in range(3):
                context = whole[k - d : k]
                if any(c > last_context for c in context):
                    assert keys[d][at] == -1
                    continue
                packed = 0
                for s in [*context, whole[k]]:
                    packed = packed << suffix_tree.BITS | s
                assert keys[d][at] == packed | d << 56
            at += 1
    assert all(len(k) == at for k in keys)


def test_odd_rows_of_scores(odd, nothing):
    rows = suffix_tree.lm_scores(odd).collect()
    assert len(rows) == len(ODD) and sorted(r["n_tokens"] for r in rows)[:3] == [1, 1, 1]
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)
    assert suffix_tree.lm_scores(nothing).count() == 0


def toxic_corpus():
    rng = random.Random(3)
    parts = ["tion", "ing", "er", "the", "an", "re", "in", "ed", "or", "es"]
    bad = ["vequ", "lowei", "scumbag", "grotty"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for d in range(1500):
        text = [word() for _ in range(rng.randrange(30, 200))]
        toxic = d % 5 == 0
        for _ in range(rng.randrange(3, 7) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(bad) + rng.choice(["", "tion", "er"])
        rows.append((d, " ".join(text)))
        labels.append((d, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = toxic_corpus()
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, marks).collect()}
    truth = dict(labels)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    held = [(truth[d], r["predicted"], r["score"]) for d, r in got.items() if r["held_out"]]
    found = [p for t, p, _ in held if t]
    assert sum(found) / len(found) > 0.9 and sum(p for t, p, _ in held if not t) / len(held) < 0.02
    assert all(0 <= s <= 1 and p == (s >= 0.7) for _, p, s in held)
    # Labels of held-out rows teach nothing.
    turned = spark.createDataFrame([(d, 1 - t if zlib.crc32(str(d).encode()) % 3 == 1 else t) for d, t in labels], "doc_id long, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, turned).collect()}
    assert again == {d: r["score"] for d, r in got.items()}


def test_toxic_words_of_ordinary_stems(spark):
    """Only whole words tell here, and half of the evidence stands behind 20,000 bytes."""
    rng = random.Random(4)
    stems = ["acht", "lich", "keit", "ver", "ung", "heit", "schaft", "ein"]
    word = lambda n: "".join(rng.choice(stems) for _ in range(n))
    bad = [word(6) for _ in range(12)]  # ordinary words have four stems at most
    rows, labels = [], []
    for d in range(1200):
        n = 6_000 if d % 40 == 0 else rng.randrange(30, 150)
        text, toxic = [word(rng.randrange(1, 5)) for _ in range(n)], d % 5 == 0
        for _ in range(rng.randrange(4, 8) if toxic else 0):
            text[rng.randrange(len(text) * 9 // 10, len(text)) if d % 40 == 0 else rng.randrange(len(text))] = rng.choice(bad)
        rows.append((d, " ".join(text)))
        labels.append((d, int(toxic)))
    assert len(rows[0][1]) > 20_000
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    held = [(labels[r["doc_id"]][1], r["predicted"]) for r in toxicity.toxicity(docs, marks).collect() if r["held_out"]]
    found, false = [p for t, p in held if t], [p for t, p in held if not t]
    assert sum(found) >= 0.85 * len(found) and sum(false) <= 0.03 * len(false)


def test_counted_strings_equal_those_of_each_text(spark):
    rows = [("a", 0, "Abc abcde\txyz abc"), ("b", 1, "abcdefg ABC"), ("c", 1, "xyz")]
    lessons = spark.createDataFrame(rows, "key string, toxic int, text string").repartition(2)
    want = {}
    for _, toxic, text in rows:
        padded = f" {' '.join(text.lower().split())} ".encode()
        for s in {int.from_bytes(padded[i : i + 5]) for i in range(len(padded) - 4)} | set(toxicity.codes(text.encode()).tolist()):
            want.setdefault(s, [0, 0])[toxic] += 1
    got = toxicity.string_counts(lessons).collect()
    assert {r["s"] % (1 << 64): [r["ordinary"], r["toxic"]] for r in got} == want
    assert {r["s"] % (1 << 64) for r in got if r["is_code"]} == {h for t in rows for h in toxicity.codes(t[2].encode()).tolist()}


def test_odd_rows_of_toxicity(spark, odd, nothing):
    marks = spark.createDataFrame([(4, 1), (7, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd, marks).collect()
    assert len(rows) == len(ODD) and {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    assert {r["score"] for r in toxicity.toxicity(odd, marks.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(nothing, marks).count() == 0


def test_windows_cover_the_whole_text():
    text = ("Ab c\n" * 41).encode()
    assert b"".join(toxicity.windows(text)).split() == text.lower().split()
    assert list(toxicity.windows(b" ")) == [b"  "]


def plain_model(texts):
    """The chance of a word behind two others, by the definition: contexts of classes, then those of words."""
    counts = Counter(w for t in texts for w in t)
    total, discount = sum(counts.values()), suffix_tree.DISCOUNT
    least, share = max(suffix_tree.LEAST_COUNT, suffix_tree.FREQUENT * total), suffix_tree.LEAST_SHARE * total
    frequent = {w for w, c in counts.items() if w and c >= least}
    rare = [c for w, c in counts.items() if w and w not in frequent]
    lost = rare.count(1) / (rare.count(1) + 2 * rare.count(2)) if rare.count(1) else discount
    plain = {w for w in frequent if counts[w] >= share} | {"<s>"}
    kind = lambda w: w if w in frequent or w in (None, "<s>") else "RARE"
    classes, words = {(): Counter()}, {}

    def history(a, b):
        if kind(b) not in plain | {"RARE"}:
            return ()
        return (kind(a), kind(b)) if kind(a) in plain | {"RARE"} and kind(b) != "RARE" else (kind(b),)

    for t in texts:
        for a, b, s in zip(["<s>", "<s>", *t], ["<s>", *t], t):
            whole = history(a, b)
            for k in range(len(whole) + 1):
                classes.setdefault(whole[k:], Counter())[kind(s)] += 1
            for key in ((b,), (a, b)):
                words.setdefault(key, Counter())[s] += 1

    def divergent(follow, up):
        n, kinds = sum(follow.values()), len(follow)
        left = {s: max(c - 1 - discount, 0) / max(n - 1, 1) + discount * kinds / n * up(s) for s, c in follow.items()}
        return sum(c / n * math.log(left[s] / up(s)) for s, c in follow.items()) >= suffix_tree.LEAST_DIVERGENCE

    def mixed(follow, s, lower, chance=0.0):
        n = sum(follow.values())
        own = {w: c for w, c in follow.items() if c >= max(suffix_tree.LEAST_TIMES, chance * n)}
        return (own[s] - discount if s in own else 0) / n + (n - sum(own.values()) + discount * len(own)) / n * lower

    kept = {()} | {
        k for k, f in classes.items()
        if k and sum(f.values()) >= max(1, share) and divergent(f, lambda s: classes[k[1:]][s] / sum(classes[k[1:]].values()))
    }

    def tree(key, s):
        while key not in kept:
            key = key[1:]
        if not key:
            return (classes[key][s] + 0.5) / (total + 0.5 * (suffix_tree.FIRST + len(frequent)))
        return mixed(classes[key], s, tree(key[1:], s), suffix_tree.LEAST_CHANCE)

    known = {}

    def chance(a, b, s, longest=2):
        value = tree(history(a, b), kind(s))
        if kind(s) == "RARE":
            value *= (counts[s] - lost if counts[s] else lost * len(rare) + 1) / (sum(rare) + 1)
        for k, key in enumerate(((b,), (a, b))[:longest]):
            follow = words.get(key, {})
            if not follow or key == ("<s>", "<s>") or (set(key) <= plain and (k == 0 or sum(follow.values()) >= share)):
                continue
            if key not in known:
                known[key] = divergent(follow, lambda w: chance(a, b, w, k))
            if known[key]:
                value = mixed(follow, s, value)
        return value

    return chance, known


@pytest.mark.parametrize("seed,share,count", [(1, 0.01, 20), (2, 1e-4, 5), (3, 0.3, 3)])
def test_scores_are_those_of_all_contexts(spark, monkeypatch, seed, share, count):
    monkeypatch.setattr(suffix_tree, "LEAST_SHARE", share)
    monkeypatch.setattr(suffix_tree, "LEAST_COUNT", count)
    rng = random.Random(seed)
    texts = [t for _, t in language(rng, 150)]
    texts += [" ".join(rng.choice("abcdefgh") + str(rng.randrange(200)) for _ in range(30)) for _ in range(20)]
    rows = list(enumerate([*texts, *texts[140:], "", None, "a b", "A b"]))
    chance, known = plain_model([tokens(t) for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["score"] for r in suffix_tree.lm_scores(docs).collect()}
    for d, text in rows:
        t = tokens(text)
        want = sum(math.log10(chance(a, b, s)) for a, b, s in zip(["<s>", "<s>", *t], ["<s>", *t], t))
        assert abs(got[d] - want) < 1e-6 * len(t)
    kept = [k for k, yes in known.items() if yes]
    assert len(kept) > 100 and {len(k) for k in kept} == {1, 2}
    a, b = texts[3].split()[:2] if len(texts[3].split()) > 1 else ("x1", "x2")
    every = {w for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1 for w in tokens(t)}
    assert abs(sum(chance(a, b, s) for s in every) + chance(a, b, "never seen") - 1) < 0.01


def test_scores_do_not_depend_on_parts(spark, monkeypatch):
    rows = [*language(random.Random(4), 120), (None, "x1 x2 x1"), (None, "x1 x2 x1"), (7, None), (7, "x1 never x1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    order = lambda r: (r["doc_id"] is None, r["doc_id"], r["n_tokens"])
    got = []
    for rounds, size in ((1, 1 << 19), (4, 50)):
        monkeypatch.setattr(suffix_tree, "ROUNDS", rounds)
        monkeypatch.setattr(suffix_tree, "GATHERED", size)
        got.append(sorted(suffix_tree.lm_scores(docs).collect(), key=order))
    assert len(got[0]) == len(got[1]) == len(rows)
    for a, b in zip(*got):
        assert a[:5] == b[:5] and abs(a["base_score"] - b["base_score"]) < 1e-9 and abs(a["score"] - b["score"]) < 1e-9


def test_equal_keys_of_several_pieces_are_one_row(monkeypatch):
    rng = np.random.default_rng(5)
    pieces = [(rng.integers(0, 9, 200), rng.integers(0, 9, 200)) for _ in range(6)]
    whole = Counter(zip(*(np.concatenate(c).tolist() for c in zip(*pieces))))
    (batch,) = suffix_tree.counted(iter(pieces), ["b", "s"])
    assert {(r["b"], r["s"]): r["c"] for r in batch.to_pylist()} == whole and batch.num_rows == len(whole)
    (sums,) = suffix_tree.summed((np.unique(b, return_counts=True) for b, _ in pieces), 100, "h")
    assert {r["h"]: r["c"] for r in sums.to_pylist()} == Counter(np.concatenate([b for b, _ in pieces]).tolist())
    monkeypatch.setattr(suffix_tree, "GATHERED", 300)
    several = list(suffix_tree.counted(iter(pieces), ["b", "s"]))
    assert len(several) > 1 and sum(c for b in several for c in b.column(2).to_pylist()) == 1200
    asked = [suffix_tree.once_a_text(b, s) for b, s in pieces]
    key, owner, times = (np.concatenate([a[k] for a in asked]) for k in range(3))
    rows = suffix_tree.grouped(np.zeros(len(key), dtype=bool), key, owner + 70, times, suffix_tree.pa.int64()).to_pylist()
    met = Counter()
    for r in rows:
        for t in r["texts"]:
            met[r["h"], r["row"] + (t >> 32) - 70] += t & 0xFFFFFFFF
    assert met == whole and len(rows) == len(set(key.tolist()))


def test_marks_hold_every_key(spark, monkeypatch):
    for bits in (16, 26):
        monkeypatch.setattr(suffix_tree, "MARK_BITS", bits)
        keys = np.array([0, 1, -1, 32768, 32769, 1 << 26, *np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 2_000)], dtype=np.int64)
        marks = suffix_tree.Marks(spark.createDataFrame([(int(k),) for k in keys], "key long"))
        assert marks(keys).all() and marks(np.random.default_rng(2).integers(-(1 << 63), (1 << 63) - 1, 20_000)).mean() < 0.01
    assert not suffix_tree.Marks(spark.createDataFrame([], "key long"))(keys).any()


def test_tasks_pass_on_a_row_for_each_range_of_keys(spark):
    """Not one for each key: those rows took most of the time and of the disk."""
    texts = [" ".join(f"w{d}x{k % 700}" for k in range(1_400)) for d in range(20)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    words, none = suffix_tree.Words([]), suffix_tree.Marks(spark.range(0).toDF("key"))
    none.bits[:] = 255
    df = suffix_tree.repeated_pairs(docs, words, none)
    want = Counter(p for t in texts for p in zip(["", *t.split()], [*t.split(), None]))
    assert sorted(r["c"] for r in df.collect()) == sorted(c for c in want.values() if c > 1)
    table = spark.range(30_000).selectExpr("xxhash64(id) AS key", "id * 0.5D AS value", f"cast(id % 2 AS int) * {suffix_tree.PAIR} AS kind").repartition(2)
    rows = suffix_tree.ranged(table)
    assert rows.count() <= 2 * 2 * (1 << suffix_tree.RANGE_BITS)
    back = suffix_tree.unranged(rows.filter(f"kind = {suffix_tree.PAIR}"))
    assert {tuple(r) for r in back.collect()} == {(r[0], r[1]) for r in table.collect() if r[2]}


@pytest.mark.parametrize("size", [1, 40, 1 << 19])
def test_ranges_and_contexts_stay_whole(monkeypatch, size):
    monkeypatch.setattr(suffix_tree, "GATHERED", size)
    rng = np.random.default_rng(size)
    span = np.sort(rng.integers(0, 30, 100)).astype(np.int32)
    values = [rng.integers(0, 9, rng.integers(1, 8)) for _ in span]
    cut = np.append(0, np.cumsum([len(v) for v in values]))
    batch = suffix_tree.pa.RecordBatch.from_arrays([suffix_tree.pa.array(span), *suffix_tree.packed(cut, np.concatenate(values))], ["span", "c"])
    pieces = [batch.slice(k, 7) for k in range(0, 100, 7)]
    got = list(suffix_tree.whole_ranges(iter(pieces)))
    spans = [{x for b in rows for x in b.column("span").to_pylist()} for rows in got]
    assert sum(len(s) for s in spans) == len(set(span.tolist())) and len(spans) == (len(set(span.tolist())) if size == 1 else len(spans))
    assert np.concatenate([suffix_tree.flat(b, "c", np.int64) for rows in got for b in rows]).tolist() == np.concatenate(values).tolist()


def test_a_rarer_word_seen_once_has_a_chance_where_none_is_seen_twice(spark):
    rows = [(d, f"only{d}") for d in range(20) if zlib.crc32(str(d).encode()) % 5 != 1][:3]
    got = suffix_tree.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # Three tokens are rarer words: the chance of that class is 1 at most, and so is that of the end.
    assert all(r["score"] <= math.log10((1 - suffix_tree.DISCOUNT) / (3 + 1)) + 1e-9 for r in got)
