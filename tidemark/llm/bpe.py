"""Byte-pair encoding by speculation: longest matches are proposed, checked pair by pair, rarely merged.

A sequence of tokens is what merging gives if each token is what merging makes of its own text and each
two neighbours stay apart when their joined text is merged. Both hold or fail by the tables alone, so
the proposals of all new words of a batch are checked together as arrays; only words with a failing pair
are merged rule by rule.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.llm.chunkcache import ChunkCache
from tidemark.llm.texts import folded, frugal, groups, pieces, utf8

END = "</w>"
NEVER = 1 << 62
#: Words that a task remembers.
WORD_MEMORY = 200_000
SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [chr(other.get(b, b)) for b in range(256)]


def well_known(text: str) -> bool:
    """Whether all characters are of old scripts (Latin, Greek, Cyrillic ...), whose classes and cases are the
    same in every version of Unicode. For others libraries differ, and the tokenizer's own tables decide."""
    return text.isascii() or max(text) < "\u0530"


class WordBpe:
    """The vocabulary and merges of a word-end BPE file, as tables."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)  # for its tables of characters only
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.text_of = {i: t for t, i in (self.vocab | self.special).items()}
        self.longest = max(len(t.removesuffix(END)) for t in self.vocab)
        self.characters = byte_characters()
        size = max(self.text_of) + 1
        self.first, self.second = np.arange(size), np.arange(size)
        self.size = size
        keys, made = [], []
        self.rank: dict[tuple[int, int], int] = {}
        for merge in spec["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, both = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.first[both], self.second[both] = left, right
            self.rank[left, right] = both
            keys.append(left * size + right)
            made.append(both)
        # Merges must be numbered in the order in which they apply; then an id is also a rank.
        if made != sorted(made):
            raise ValueError("the ids of merged tokens must follow the order of the merges")
        order = np.argsort(keys)
        self.keys, self.made = np.array(keys)[order], np.array(made)[order]
        ids = np.arange(size)
        parts = self.first != ids
        sound = np.ones(size, dtype=bool)
        sound[parts] = self.apart(self.first[parts], self.second[parts], ids[parts])
        for _ in range(self.longest):  # a token is as sound as its parts
            sound[parts] &= sound[self.first[parts]] & sound[self.second[parts]]
        self.sound = sound
        self.words: dict[str, list[int]] = {}

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair merges to; ``NEVER`` without a rule."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], NEVER)

    def apart(self, left: np.ndarray, right: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge earlier than ``before`` reaches over the border of each pair.

        Takes the pair apart again, the later of the two facing parts first, and asks at each step for a
        rule for the two parts that face each other, earlier than the merge that ended that meeting.
        """
        good = np.ones(len(left), dtype=bool)
        live = np.arange(len(left))
        a, b = left.copy(), right.copy()
        limit = np.full(len(left), NEVER) if before is None else before.astype(np.int64)
        while live.size:
            crossing = self.joined(a, b) < limit
            good[live[crossing]] = False
            live, a, b = live[~crossing], a[~crossing], b[~crossing]
            inner_a, inner_b = self.second[a], self.first[b]
            whole_a, whole_b = inner_a == a, inner_b == b
            undo_a = np.where(a > b, ~whole_a, whole_b & ~whole_a)
            undo_b = ~undo_a & ~whole_b
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, inner_a, a), np.where(undo_b, inner_b, b)
            more = undo_a | undo_b
            live, a, b, limit = live[more], a[more], b[more], limit[more]
        return good

    def propose(self, word: str) -> list[int]:
        """Longest matches from the left; ``word`` is in byte characters."""
        vocab, n, at, out = self.vocab, len(word), 0, []
        while at < n:
            end = min(n, at + self.longest)
            while True:
                token = vocab.get(word[at:] + END if end == n else word[at:end])
                if token is not None:
                    break
                end -= 1
            out.append(token)
            at = end
        return out

    def merge(self, word: str) -> list[int]:
        """Rule by rule: the earliest merge first, leftmost among equals; n log n in the length."""
        rank, last = self.rank, len(word)
        ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + END]]
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        queue = [(rank[p], k, p) for k, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(queue)
        while queue:
            made, at, pair = heapq.heappop(queue)
            right = after[at]
            if right >= last or ids[at] != pair[0] or ids[right] != pair[1]:
                continue  # one of the two has been merged meanwhile
            ids[at], ids[right] = made, -1
            after[at] = nearest = after[right]
            if nearest < last:
                before[nearest] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < last and (p := (ids[left], ids[after[left]])) in rank:
                    heapq.heappush(queue, (rank[p], left, p))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word by speculation, exact merging only where a check fails."""
        if not words:
            return []
        out = [self.propose(w) for w in words]
        sizes = np.array([len(x) for x in out])
        flat = np.fromiter((i for x in out for i in x), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        failed = np.zeros(len(words), dtype=bool)
        failed[owner[~self.sound[flat]]] = True
        inside = owner[1:] == owner[:-1]
        left, right = flat[:-1][inside], flat[1:][inside]
        pairs, back = np.unique(left * self.size + right, return_inverse=True)
        good = self.apart(pairs // self.size, pairs % self.size)
        failed[owner[1:][inside][~good[back]]] = True
        for k in np.flatnonzero(failed):
            out[k] = self.merge(words[k])
        return out

    def known_words(self, words: list[str]) -> dict[str, list[int]]:
        """A table that has all of ``words``. Chunks differ more than words do, by case and punctuation, so
        words have a memory of their own; it starts anew when it is full."""
        if len(self.words) > WORD_MEMORY:
            self.words = {}
        new = [w for w in words if w not in self.words]
        self.words.update(zip(new, self.encode_words(new), strict=True))
        return self.words

    def words_of(self, chunk: bytes) -> list[str | int]:
        """The words of a chunk in byte characters; special tokens as ids."""
        text, out = chunk.decode("utf-8", "replace"), []
        for part in self.cut.split(text) if "<|" in text else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            if not well_known(part):
                normal = self.library.normalizer.normalize_str(part)
                out += [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
                # Character by character where lower case would depend on the place in the word.
                part = "".join(map(str.lower, part)) if "Σ" in part else part
            for word in self.pattern.findall(part.lower()):
                if not (word.isascii() and word.isprintable()):
                    word = "".join([self.characters[b] for b in word.encode()])
                out.append(word)
        return out

    def encode_chunks(self, chunks: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """For each chunk its ids as little-endian 32-bit integers and its decoded text."""
        cut = [self.words_of(c) for c in chunks]
        words = sorted({w for c in cut for w in c if isinstance(w, str)})
        ids = self.known_words(words)
        for c in cut:
            tokens = [i for w in c for i in ([w] if isinstance(w, int) else ids[w])]
            yield pack(f"<{len(tokens)}I", *tokens), self.decode(tokens)

    def decode(self, tokens: list[int]) -> bytes:
        """Each token's text and a blank. The file has no decoder, so texts of tokens stand side by side."""
        return "".join([self.text_of[i] + " " for i in tokens]).encode()


@functools.lru_cache(maxsize=2)
def tables_for(path: str) -> WordBpe:
    """The tables of a file, made once per Python worker."""
    return WordBpe(path)


def cache_for(path: str) -> ChunkCache:
    """A memory of chunks for one task, and an empty one of words."""
    tables = tables_for(path)
    tables.words = {}
    return ChunkCache(tables.encode_chunks, 150_000)


def encode_and_decode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: number of ids, digests of the ids and of the text decoded from them.

    ``tokenizer`` is the path of the vocabulary file on every executor. ``with_ids`` adds ``ids`` (binary,
    little-endian unsigned 32-bit). Nulls and empty texts have no ids; repeated rows and rows with a
    null key are answered like any other; other columns are ignored. Narrow: no shuffle. A long text
    is encoded in pieces cut at blanks.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cache_for(tokenizer)
        for batch in batches:
            rows = encoded_texts(utf8(batch, 1), cache, with_ids)
            counts, ids, decoded, raw = zip(*rows) if rows else ((), (), (), ())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)
        cache.clear()
        tables_for(tokenizer).words = {}

    return docs.select(doc_id, text).mapInArrow(frugal(run), f"doc_id {kind}, {SCHEMA}" + ", ids binary" * with_ids)


def encoded_texts(texts: list[bytes], cache: ChunkCache, with_ids: bool = False) -> list[tuple]:
    """Number of ids, both digests and, if asked for, the ids of each text."""
    out = []
    for group in groups(texts):
        if len(group) == 1:
            out.append(encoded(pieces(folded(group[0])), cache, with_ids))
            continue
        for found in cache.of([folded(t).split() for t in group]):
            ids, text = b"".join([f[0] for f in found]), b"".join([f[1] for f in found])[:-1]
            out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest(), ids if with_ids else None))
    return out


def encoded(parts: Iterable[bytes], cache: ChunkCache, with_ids: bool = False) -> tuple[int, str, str, bytes | None]:
    """The same for one long text that comes in parts."""
    ids, decoded, size, held, raw = hashlib.sha256(), hashlib.sha256(), 0, b"", []
    for piece in parts:
        found = cache.of([piece.split()])[0]
        part, out = b"".join([f[0] for f in found]), held + b"".join([f[1] for f in found])
        ids.update(part)
        decoded.update(out[:-1])
        size, held = size + len(part), out[-1:]
        if with_ids:
            raw.append(part)
    # The blank behind the last token is not part of the text.
    return size // 4, ids.hexdigest(), decoded.hexdigest(), b"".join(raw) if with_ids else None
