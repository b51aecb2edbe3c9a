"""Byte-pair encoding and the coded files against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from odd_rows import ODD
from tidemark.llm import bpe, huffman
from tidemark.llm.texts import PIECE, folded, pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), bpe.WordBpe(PATH)


def library_row(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdehilnorstuéßñ", min_size=1, max_size=24))
def test_words_are_merged_as_by_the_library(word):
    mapped = OWN.words_of(word.encode())
    assert [i for w in OWN.encode_words(mapped) for i in w] == LIBRARY.encode(word, add_special_tokens=False).ids
    assert [i for w in mapped for i in OWN.merge(w)] == LIBRARY.encode(word, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_any_texts(texts):
    cache = bpe.cache_for(PATH)
    for text, row in zip(texts, bpe.encoded_texts([t.encode("utf-8", "replace") for t in texts], cache)):
        assert row[:3] == library_row(text.encode("utf-8", "replace").decode())


def test_a_failing_pair_is_noticed():
    words = ["thedingthat", "whereinthe", "aaaaaaa", "tionssion", "bananas"]
    proposals = [OWN.propose(w) for w in words]
    exact = [OWN.merge(w) for w in words]
    assert any(p != e for p, e in zip(proposals, exact))
    assert OWN.encode_words(words) == exact


def test_pieces_cut_at_blanks_only():
    text = (b"abc " * 400_000) + b"x" * (2 * PIECE) + b" end"
    parts = list(pieces(text))
    assert b"".join(parts) == text and [w for p in parts for w in p.split()] == text.split()
    assert folded(b"AB<|x") == b"AB<|x" and folded(b"AB") == b"ab"


def test_documents(spark, odd, nothing):
    rows = bpe.encode_and_decode(odd, PATH, with_ids=True).collect()
    assert len(rows) == len(ODD)
    expected = sorted((str(r[0]), *library_row(r[1])) for r in ODD)
    assert sorted((str(r[0]), *r[1:4]) for r in rows) == expected
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    assert bpe.encode_and_decode(nothing, PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_code_lengths_are_complete_and_no_longer_than_allowed(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(1 << 16, dtype=np.int64)
    used = rng.choice(1 << 16, 3_000, replace=False)
    counts[used] = np.maximum(1, (1e9 / np.arange(1, 3_001) ** 2.5).astype(np.int64))
    lengths = huffman.code_lengths(counts).astype(float)
    assert lengths.max() <= huffman.LIMIT and (lengths[used] > 0).all() and (lengths > 0).sum() == 3_000
    assert np.sum(2.0 ** -lengths[used]) == 1.0


def test_lengths_are_optimal_for_small_alphabets():
    import heapq

    rng = np.random.default_rng(1)
    for _ in range(30):
        counts = rng.integers(1, 100, rng.integers(2, 12))
        heap = [(int(c), i, 0) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        cost, k = 0, len(counts)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            cost, k = cost + a[0] + b[0], k + 1
            heapq.heappush(heap, (a[0] + b[0], k, 0))
        assert int((huffman.code_lengths(counts) * counts).sum()) == cost


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=700))
def test_bits_round_trip(values):
    ids = np.array(values)
    code = huffman.Codebook(huffman.code_lengths(np.bincount(ids, minlength=1 << 16)))
    bits, offsets = code.write(ids)
    assert code.read(bits, offsets, len(ids)).tolist() == values


def test_files_hold_all_ids_in_order(spark, odd, nothing, folder):
    rows = huffman.pack_ids(odd, PATH, f"{folder}/ids").orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted([r[0] for r in ODD], key=lambda k: (k is not None, k or 0))
    start, texts = 0, {r[0]: r[1] for r in ODD}
    for r in rows:
        ids = np.array([*LIBRARY.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    with_ids = huffman.read_ids(spark, f"{folder}/ids", with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in with_ids)
    assert huffman.pack_ids(nothing, PATH).count() == 0
