"""Test items that training documents contain: BM25 over an index of the items, verified word by word.

Every passage of every document (half-overlapping windows of words) is a query. An item's score is the
BM25 weight of its words in the passage as a share of the weight of all its words, so one threshold
suits items of any length. Postings are grouped in blocks of items with the largest weight of each word
in each block. Passages whose sum of block maxima stays below the threshold in every block are set
aside together, as arrays; block-max WAND retrieves the items above the threshold for the others; and
an item is reported if the runs of words of its question and of its answer stand in the document.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import PIECE, frugal, pieces, utf8

K1, B = 1.2, 0.75
#: Share of an item's weight that a passage must have.
THRESHOLD = 0.65
#: Items per block of postings.
BLOCK = 4
#: Items that are indexed together. A larger set is searched in several rounds of this size.
ROUND = 20_000
#: Items of up to so many words share their rounds, then those of up to twice as many, and so on, so that
#: a long item makes passages long in its own rounds only.
SHORT = 256
#: Runs of so many words are compared, and so large a share of them must be found.
RUN, OVERLAP = 3, 0.6

PUNCTUATION = bytes(32 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case without ASCII punctuation."""
    return text.lower().translate(PUNCTUATION).split()


def runs(words: list[bytes], size: int = RUN) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``size`` words."""
    return set(zip(*[words[k:] for k in range(size)]))


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """An item's last sentence is its answer, unless it or the rest is shorter than a run; then the last
    third of the words is."""
    sentences = [w for s in text.replace(b"\n", b". ").split(b". ") if (w := words_of(s))]
    words = [w for s in sentences for w in s]
    cut = len(words) - len(sentences[-1]) if sentences else 0
    if min(cut, len(words) - cut) < RUN:
        cut = len(words) - max(1, len(words) // 3)
    return words[:cut], words[cut:]


class Part:
    """A question or answer as runs of words; shorter runs where it has fewer words."""

    def __init__(self, words: list[bytes]):
        self.size = min(RUN, len(words))
        self.runs = runs(words, self.size) if words else set()

    def share(self, passage: list[bytes]) -> float:
        """The share of the runs that ``passage`` has; an empty part is always there."""
        return len(self.runs & runs(passage, self.size)) / len(self.runs) if self.runs else 1.0


class Index:
    """The items of one round with block-max postings; ``stats`` are those of all items."""

    def __init__(self, items: list[tuple], n_items: int, mean_length: float, frequency: dict[bytes, int]):
        parsed = [(key, text, Counter(words_of(text))) for key, text in items]
        parsed = [p for p in parsed if p[2]]
        idf = {w: math.log(1 + (n_items - n + 0.5) / (n + 0.5)) for w, n in frequency.items()}

        def weights(count: Counter) -> dict[bytes, float]:
            norm = K1 * (1 - B + B * sum(count.values()) / mean_length)
            raw = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in count.items()}
            whole = sum(raw.values())
            return {w: x / whole for w, x in raw.items()}

        # Items that share their most frequent word stand together, so that block maxima are close to the items.
        parsed.sort(key=lambda p: (max(p[2], key=lambda w: (frequency[w], w)), len(p[2])))
        self.keys = [p[0] for p in parsed]
        self.parts = [tuple(Part(w) for w in question_and_answer(p[1])) for p in parsed]
        self.vocab: dict[bytes, int] = {}
        self.lists: list[list[tuple[int, float]]] = []
        for at, (_, _, count) in enumerate(parsed):
            for word, weight in sorted(weights(count).items()):
                term = self.vocab.setdefault(word, len(self.vocab))
                if term == len(self.lists):
                    self.lists.append([])
                self.lists[term].append((at, weight))
        self.n_blocks = max(1, -(-len(parsed) // BLOCK))
        self.places = [[at for at, _ in p] for p in self.lists]
        self.block_max: list[dict[int, float]] = []
        for p in self.lists:
            best: dict[int, float] = defaultdict(float)
            for at, weight in p:
                best[at // BLOCK] = max(best[at // BLOCK], weight)
            self.block_max.append(dict(best))
        # The same block maxima as sparse rows: (block, weight) pairs of each term, one after the other.
        self.row_start = np.cumsum([0, *[len(b) for b in self.block_max]])
        self.row_block = np.array([b for m in self.block_max for b in m], dtype=np.int64)
        self.row_weight = np.array([w for m in self.block_max for w in m.values()])

    def hopeful(self, window: np.ndarray, term: np.ndarray, n: int, threshold: float) -> np.ndarray:
        """Windows (of ``n``) with a block whose maxima of the window's terms reach ``threshold``.

        ``window, term`` are distinct pairs in order. A few windows at a time, so that memory is bounded.
        """
        good = np.zeros(n, dtype=bool)
        length = np.diff(self.row_start)[term]
        step = max(1, 2_000_000 // self.n_blocks)
        for low in range(0, n, step):
            a, b = np.searchsorted(window, [low, low + step])
            if a == b:
                continue
            size = length[a:b]
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(self.row_start[term[a:b]], size)
            cell = (np.repeat(window[a:b], size) - low) * self.n_blocks + self.row_block[at]
            sums = np.bincount(cell, weights=self.row_weight[at], minlength=step * self.n_blocks)
            good[low : low + step] = (sums.reshape(step, self.n_blocks).max(1) >= threshold - 1e-9)[: n - low]
        return good

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items of weight ``threshold`` or more for a query of distinct terms, by block-max WAND."""
        lists = [(self.lists[t], self.places[t], self.block_max[t], max(self.block_max[t].values())) for t in terms]
        cursor = [0] * len(lists)
        found, slack = [], threshold - 1e-9
        while True:
            live = sorted((p[1][c], k) for k, (p, c) in enumerate(zip(lists, cursor)) if c < len(p[1]))
            bound, pivot = 0.0, None
            for at, k in live:
                bound += lists[k][3]
                if bound >= slack:
                    pivot = at
                    break
            if pivot is None:
                return found
            here = [k for at, k in live if at <= pivot]
            block = pivot // BLOCK
            if sum(lists[k][2].get(block, 0.0) for k in here) < slack:
                # No item of this block: on to its end, or to the next list that comes in before.
                later = [at for at, _ in live if at > pivot]
                target = min([(block + 1) * BLOCK, *later])
                for k in here:
                    cursor[k] = bisect_left(lists[k][1], target, cursor[k])
                continue
            if live[0][0] == pivot:
                score = sum(lists[k][0][cursor[k]][1] for k in here)
                if score >= slack:
                    found.append((pivot, score))
                for k in here:
                    cursor[k] += 1
            else:
                for k in here:
                    cursor[k] = bisect_left(lists[k][1], pivot, cursor[k])


def length_class(n_words: int) -> int:
    """0 for up to ``SHORT`` words, 1 for up to twice as many, 2 for up to four times ..."""
    return (max(0, n_words - 1) // SHORT).bit_length()


def item_statistics(items: DataFrame) -> tuple[int, float, dict[int, tuple[int, int]], dict[bytes, int]]:
    """Number of items, their mean length, per length class their number and greatest length, and in how many
    items each word is.

    The words of all test items are collected, once for all rounds: a few bytes per word of the benchmark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency: Counter[bytes] = Counter()
        classes: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
        for batch in batches:
            for t in utf8(batch, 1):
                words = words_of(t)
                if words:
                    frequency.update(set(words))
                    of = classes[length_class(len(words))]
                    of[:] = of[0] + 1, of[1] + len(words), max(of[2], len(words))
        rows = [(None, k, *c) for k, c in classes.items()] + [(w, None, n, 0, 0) for w, n in frequency.items()]
        types = [pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) if rows else [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["word", "class", "n", "length", "longest"])

    rows = items.mapInArrow(frugal(run), "word binary, class int, n long, length long, longest long").groupBy("word", "class").agg(
        F.sum("n").alias("n"), F.sum("length").alias("length"), F.max("longest").alias("longest")
    ).collect()
    classes = {r["class"]: (r["n"], r["longest"]) for r in rows if r["word"] is None}
    n = sum(c for c, _ in classes.values())
    mean = sum(r["length"] for r in rows) / n if n else 1.0
    return n, mean, classes, {bytes(r["word"]): r["n"] for r in rows if r["word"] is not None}


class Searcher:
    """Finds the items of one index in texts."""

    def __init__(self, index: Index, half: int, threshold: float, overlap: float):
        self.index, self.half, self.threshold, self.overlap = index, half, threshold, overlap

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, list[tuple]]]:
        """For each text with matches its number and ``(item, score, passages, question, answer)`` rows."""
        small: list[tuple[int, list[bytes]]] = []
        held = 0
        for number, text in enumerate(texts):
            if len(text) <= PIECE:
                small.append((number, words_of(text)))
                held += len(text)
                if held > 2 * PIECE:
                    yield from self._search(small)
                    small, held = [], 0
                continue
            # A long text in pieces that overlap by one passage.
            parts, tail = [], []
            for piece in pieces(text):
                words = tail + words_of(piece)
                parts += [rows for _, rows in self._search([(number, words)])]
                tail = words[-2 * self.half :]
            if merged := self._merged([r for rows in parts for r in rows]):
                yield number, merged
        yield from self._search(small)

    @staticmethod
    def _merged(rows: list[tuple]) -> list[tuple]:
        best: dict[int, tuple] = {}
        for item, score, n, question, answer in rows:
            old = best.get(item, (item, 0.0, 0, 0.0, 0.0))
            best[item] = (item, max(old[1], score), old[2] + n, max(old[3], question), max(old[4], answer))
        return [best[k] for k in sorted(best)]

    def _search(self, docs: list[tuple[int, list[bytes]]]) -> Iterator[tuple[int, list[tuple]]]:
        index, half, get = self.index, self.half, self.index.vocab.get
        # Half-windows of all texts in a row; passage k is the half-windows k and k + 1 of one text.
        halves, terms, owner = [], [], []
        base = 0
        for at, (_, words) in enumerate(docs):
            ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
            place = np.flatnonzero(ids >= 0)
            n = max(1, -(-len(words) // half))
            halves.append(place // half + base)
            terms.append(ids[place])
            owner.append(np.full(n + 1, at))
            base += n + 1  # one empty half-window between texts
        if not docs:
            return
        half_of, term, owner = np.concatenate(halves), np.concatenate(terms), np.concatenate(owner)
        size = max(1, len(index.lists))
        key = np.unique(np.concatenate([half_of * size + term, (half_of - 1) * size + term]))
        key = key[key >= 0]
        window, term = key // size, key % size
        hits: dict[int, list[tuple]] = defaultdict(list)
        for w in np.flatnonzero(index.hopeful(window, term, base, self.threshold)):
            a, b = np.searchsorted(window, [w, w + 1])
            at = int(owner[w])
            first = int(np.searchsorted(owner, at))
            low = max(0, int(w) - first) * half
            for item, score in index.search(term[a:b].tolist(), self.threshold):
                around = docs[at][1][max(0, low - half) : low + 3 * half]
                shares = [part.share(around) for part in index.parts[item]]
                if min(shares) >= self.overlap:
                    hits[at].append((item, score, 1, *shares))
        for at in sorted(hits):
            yield docs[at][0], self._merged(hits[at])


def searchers(items: DataFrame, item_id: str, text: str, threshold: float, overlap: float) -> list[Searcher]:
    """One searcher per round of at most about ``ROUND`` items of like length; any two half passages hold the longest."""
    slim = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    n, mean, classes, frequency = item_statistics(slim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("class", pa.array([length_class(len(words_of(t))) for t in utf8(batch, 1)], pa.int32()))

    classed = slim.mapInArrow(frugal(run), f"item_id {items.schema[item_id].dataType.simpleString()}, text string, class int")
    out = []
    for k, (members, longest) in sorted(classes.items()):
        rounds = -(-members // ROUND)
        for turn in range(rounds):
            part = classed.filter((F.col("class") == k) & (F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn))
            found = [(r["item_id"], (r["text"] or "").encode()) for r in part.collect()]
            rows = sorted(found, key=lambda r: (r[0] is not None, 0 if r[0] is None else r[0], r[1]))
            words = {w for _, t in rows for w in words_of(t)}
            out.append(Searcher(Index(rows, n, mean, {w: frequency[w] for w in words}), longest, threshold, overlap))
    return out


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
) -> DataFrame:
    """One row per document and item that it contains: ``doc_id, item_id, score, n_passages,
    question_overlap, answer_overlap``.

    Null and empty texts and items have no words and match nothing; repeated rows are answered each;
    null keys are reported as null; keys may be of any type; other columns are ignored. The index of a round
    is bounded (``ROUND`` items) and sent to the tasks; documents are read once per round and never shuffled.
    Items of any length are found: those of more than ``SHORT`` words have rounds with longer passages.
    """
    key_type = items.select(item_id).limit(0).toArrow().schema.field(0).type
    kind, item_kind = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, score double, n_passages long, question_overlap double, answer_overlap double"

    def search(searcher: Searcher) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, rows = [], []
                for number, found in searcher.matches(utf8(batch, 1)):
                    at += [number] * len(found)
                    rows += [(searcher.index.keys[r[0]], *r[1:]) for r in found]
                columns = list(zip(*rows)) if rows else [()] * 5
                types = [key_type, pa.float64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types)]],
                    ["doc_id", "item_id", "score", "n_passages", "question_overlap", "answer_overlap"],
                )

        return docs.select(doc_id, text).mapInArrow(frugal(run), schema)

    found = [search(s) for s in searchers(items, item_id, item_text, threshold, overlap)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns. Narrow, one pass per round."""
    out = docs
    for searcher in searchers(items, item_id, item_text, THRESHOLD, OVERLAP):

        def run(batches: Iterator[pa.RecordBatch], searcher: Searcher = searcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[number for number, _ in searcher.matches(utf8(batch, text))]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(frugal(run), docs.schema)
    return out
