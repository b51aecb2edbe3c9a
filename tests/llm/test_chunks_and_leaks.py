"""Content-defined chunks, and benchmark items against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from odd_rows import ODD
from tidemark.llm import chunks, decontam
from tidemark.llm.texts import PIECE


def words(rng, n, letters="abcdefghijklm"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(n))


def plain_cuts(text):
    """The gear hash as it is defined, byte after byte."""
    out = []
    for i in range(len(text)):
        h = 0
        for k in range(min(i + 1, chunks.REACH)):
            h += int(chunks._GEAR[text[i - k]]) << k
        if h & int(chunks.ZEROS) == 0:
            out.append(i + 1)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_cuts_and_sizes(seed):
    text = words(random.Random(seed), 300).encode()
    assert chunks.possible_cuts(text).tolist() == plain_cuts(text)
    ends = chunks.chunk_ends(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes.max() <= chunks.MOST and sizes[:-1].min() >= chunks.LEAST
    assert chunks.chunk_ends(b"") == [] and chunks.chunk_ends(b"x") == [1]


def test_pieces_do_not_change_cuts(monkeypatch):
    text = words(random.Random(9), 3_000).encode()
    whole = chunks.possible_cuts(text).tolist()
    monkeypatch.setattr(chunks, "PIECE", 777)
    assert chunks.possible_cuts(text).tolist() == whole


def test_an_insertion_changes_few_chunks():
    text = words(random.Random(3), 2_000).encode()
    parts = lambda t: {t[a:b] for a, b in zip([0, *chunks.chunk_ends(t)], chunks.chunk_ends(t))}
    moved = text[:500] + b"inserted here " + text[500:]
    assert len(parts(text) - parts(moved)) <= 6


def test_repeated_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(4)
    passage, line = words(rng, 52), "All rights reserved."
    texts = {d: f"{line}\n{words(rng, 80)}" for d in range(40)}
    for d in (7, 11, 30):
        texts[d] += f" {passage} " + words(rng, 40)
    texts[50] = f"{passage} {words(rng, 30)} {passage}"
    texts[60] = texts[5]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in chunks.substring_dedup(docs).collect()}
    assert set(got) == {7, 11, 30, 50, 5, 60}
    assert got[7]["cut"] == "" and got[5]["cut"] == "" and got[60]["cut_bytes"] == len(texts[60].encode())
    for d in (11, 30, 50):
        start = texts[d].index(passage)
        a, b = map(int, got[d]["cut"].split(",")[0].split(":"))
        assert start - chunks.MOST <= a and b <= start + len(passage) + chunks.MOST and b - a > len(passage) // 2
    left = {r["doc_id"]: r["text"] for r in chunks.without_repeats(docs).collect()}
    assert left[7] == texts[7] and left[60] == "" and len(left[50]) < len(texts[50]) - len(passage)
    # Counted again, nothing is left to cut but what is too short.
    again = chunks.substring_dedup(spark.createDataFrame(list(left.items()), "doc_id long, text string"))
    assert again.filter("cut != ''").count() == 0


def test_no_passage_just_above_fifty_words_is_lost(spark):
    rng = random.Random(12)
    rows, pairs = [], 900
    for k in range(pairs):
        passage = words(rng, (51, 55, 60)[k % 3])
        rows += [(2 * k + side, f"{words(rng, 30)} {passage} {words(rng, 30)}") for side in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["cut_bytes"] for r in chunks.substring_dedup(docs).collect()}
    lost = [k for k in range(pairs) if not {2 * k, 2 * k + 1} <= set(got)]
    assert not lost and all(got[2 * k + 1] >= chunks.PASSAGE for k in range(pairs))


def test_odd_rows_of_chunks(odd, nothing):
    got = {r["doc_id"]: r for r in chunks.substring_dedup(odd).collect()}
    assert {1, 2, 3, 4, 7}.isdisjoint(got) and {5, 6} <= set(got)
    assert chunks.substring_dedup(nothing).count() == 0
    assert chunks.without_repeats(odd).columns == odd.columns and chunks.without_repeats(nothing).count() == 0


def index_of(items):
    count, lengths = Counter(), []
    for _, t in items:
        w = decontam.words_of(t)
        if w:
            count.update(set(w))
            lengths.append(len(w))
    return decontam.Index(items, len(lengths), sum(lengths) / len(lengths), dict(count))


@pytest.mark.parametrize("seed", range(6))
def test_wand_finds_every_item_above_the_threshold(seed):
    rng = random.Random(seed)
    items = [(k, words(rng, rng.randrange(1, 14), "abc").encode()) for k in range(60)]
    index = index_of(items)
    for _ in range(60):
        terms = sorted(rng.sample(range(len(index.lists)), rng.randrange(1, len(index.lists))))
        scores = defaultdict(float)
        for t in terms:
            for at, weight in index.lists[t]:
                scores[at] += weight
        for threshold in (0.2, 0.5, 0.9):
            want = {at for at, s in scores.items() if s >= threshold - 1e-9}
            assert {at for at, _ in index.search(terms, threshold)} == want
            pairs = np.zeros(len(terms), dtype=np.int64), np.array(terms)
            assert index.hopeful(*pairs, 1, threshold)[0] or not want


def test_items_in_documents(spark):
    rng = random.Random(7)
    items = [(k, words(rng, rng.choice([2, 9, 20, 40])) + ". " + words(rng, rng.choice([1, 3, 12])) + ".") for k in range(50)]
    bank = spark.createDataFrame([*items, (90, None), (91, "  "), (92, "!!")], "item_id long, text string")
    texts = {d: words(rng, 500) for d in range(60)}
    want = set()
    for d in range(0, 60, 3):
        k = rng.randrange(50)
        at = rng.randrange(len(texts[d]))
        at = texts[d].find(" ", at) if " " in texts[d][at:] else 0
        texts[d] = f"{texts[d][:at]} {items[k][1].upper()} {texts[d][at:]}"
        want.add((d, k))
    texts[100] = items[3][1].split(". ")[0]  # the question alone is no leak if the answer is missing
    long_text = words(rng, 200) + " " + "z " * PIECE + items[4][1] + " " + words(rng, 50)
    texts[101] = long_text
    want.add((101, 4))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bank).collect()}
    assert want <= got and not {d for d, _ in got - want} - {100}
    left = {r["doc_id"] for r in decontam.without_leaks(docs, bank).collect()}
    assert left == set(texts) - {d for d, _ in got}


def test_rounds_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [(k, words(rng, 15)) for k in range(30)]
    bank = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(d, words(rng, 60) + " " + items[d][1]) for d in range(30)], "doc_id long, text string")
    one = sorted(map(tuple, decontam.contaminated(docs, bank).collect()))
    monkeypatch.setattr(decontam, "ROUND", 7)
    assert sorted(map(tuple, decontam.contaminated(docs, bank).collect())) == one
    assert {r[:2] for r in one} == {(d, d) for d in range(30)}


def test_items_of_any_length(spark):
    rng = random.Random(11)
    sizes = [20, 256, 257, 1_000, 3_000]
    items = [(k, words(rng, n)) for k, n in enumerate(sizes)]
    bank = spark.createDataFrame(items, "item_id smallint, text string")
    texts = {d: words(rng, 700) for d in range(20)}
    want = set()
    for d, (k, item) in enumerate(items * 2):
        texts[d] = f"{words(rng, rng.randrange(1, 400))} {item} {words(rng, 300)}"
        want.add((d, k))
    texts[15] += " " + " ".join(items[3][1].split()[:300])  # a third of an item is none of it
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bank).collect()} == want
    assert decontam.without_leaks(docs, bank).count() == 10
    assert [decontam.length_class(n) for n in (0, 1, 256, 257, 512, 513, 1_024, 1_025)] == [0, 0, 0, 1, 1, 2, 2, 3]


def test_keys_of_text(spark):
    bank = spark.createDataFrame([("", "alpha beta gamma delta epsilon zeta"), (None, "eta theta iota kappa lambda mu")], "item_id string, text string")
    docs = spark.createDataFrame([("a", "x alpha beta gamma delta epsilon zeta y"), ("b", "eta theta iota kappa lambda mu")], "doc_id string, text string")
    assert {tuple(r)[:2] for r in decontam.contaminated(docs, bank).collect()} == {("a", ""), ("b", None)}


def test_odd_rows_of_leaks(spark, odd, nothing):
    bank = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (None, "one two three")], "item_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["item_id"])) for r in decontam.contaminated(odd, bank).collect())
    assert got == [("4", "None"), ("4", "None"), ("None", "1")]
    assert decontam.without_leaks(odd, bank).count() == len(ODD) - 3
    assert decontam.contaminated(odd, bank.limit(0)).count() == 0 and decontam.contaminated(nothing, bank).count() == 0
