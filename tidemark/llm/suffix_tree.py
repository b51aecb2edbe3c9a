"""Language-model scores by a probabilistic suffix tree, beside smoothed word frequencies.

The tree predicts a symbol from the longest of its contexts that ends what stands before. Contexts are kept
if a given share of all symbols follows them and what follows them diverges from what follows their own
suffix, each occurrence judged by all others; a kept context's distribution is smoothed with that of its longest kept suffix.

The symbols are the frequent words, the end of the text, and one that says that a rarer word comes. Which
of them comes is told by the rarer words' own counts, less a discount that is left for all words that the
training texts lack. These count as one unknown word, as they do in the base score, so both scores are
distributions over the same tokens.

Counts come from all training texts. Contexts that a given share of all symbols follows are few whatever the
size of the corpus, so their part of the tree is collected and sent along. All others that occur twice or more,
of any words, are the rest of the tree: a stored table that grows with the corpus. The share only says where a
context is looked up. What the table adds to the logarithm of a chance is one number for a context and one for
each of its symbols, so it meets the texts in one join, as the counts of rarer words do.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored
from tidemark.llm.texts import MULTIPLIER, PIECE, frugal, mixed, parts, word_spans

#: Longest context in words, and bits of a symbol: a context and its symbol fit into an integer.
DEPTH, BITS = 2, 18
MASK = (1 << BITS) - 1
#: Share of all symbols that must follow a context of the collected part: at most 1 / LEAST_SHARE of one length.
#: Rarer contexts are kept in the table.
LEAST_SHARE = 1e-4
#: Times, and share of what follows a context, from which a symbol has a chance of its own there; others
#: keep that of the shorter context. So a context has at most 1 / LEAST_CHANCE symbols of its own.
LEAST_TIMES, LEAST_CHANCE = 2, 2e-4
#: Least divergence (in nats) of a context's distribution from that of its suffix.
LEAST_DIVERGENCE = 0.02
#: What smoothing takes from each count.
DISCOUNT = 0.5
#: Words that are symbols of their own: those with this share of all symbols, which are 1 / FREQUENT at most,
#: and seen so often at least. Symbols 0, 1 and 2 are a word that no context may hold, the end, and any
#: rarer word.
FREQUENT, LEAST_COUNT = 1e-5, 5
NONE, STOP, RARE, FIRST = 0, 1, 2, 3
#: A task counts a few times so many distinct words or transitions before it passes them on.
MEMORY = 300_000
#: Rows that a task gathers from several pieces of text before it counts or groups those of one key.
GATHERED = 1 << 19
#: Parts in which the texts meet the tables, one after another: the shuffle files of one part are on disk at a time.
ROUNDS = 4
#: Bits of a range of keys. For each range that it has keys of, a task passes on one row, not one for each key.
RANGE_BITS = 11

#: Kinds of rows that meet by ranges of keys, in this order: of the table (``TREE``) and of the rarer words (``WORD``), both
#: with keys and values; what the texts that a task takes together ask for (``ASK``): keys, how many texts have each and, for
#: all of these, how far behind the first text they come and how often they have the key; and the texts' own values
#: (``OWN``). What only longer contexts ask for (``PAIR``) does not meet the texts.
TREE, WORD, ASK, OWN, PAIR = range(5)
SENT = ["kind", "span", "first", "keys", "is_tree", "counts", "texts", "times", "own"]

#: Stand for the end and for the start of a text among the hashes of words.
END, START = 0, 1
#: Bits in which keys of a table are marked, two for each: 8 MB. A table that fills them lets more rows
#: pass to the join, which decides.
MARK_BITS = 26


def held_out(doc_id: str) -> Column:
    """Rows that nothing is learnt from; a null key is learnt from."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "utf-8")) % 5 == 1, F.lit(False))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of several texts, A-Z as a-z, and how many each text has."""
    hashes, start, _ = word_spans(b"\n".join(texts))
    ends = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
    return hashes.view(np.int64), np.diff(ends, prepend=0)


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``h, c`` of the words of all texts of ``docs`` by their hash; ``END`` is the end of a text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for _, group in parts(batch, 0, PIECE):
                keys, times = np.unique(hashed_words(group)[0], return_counts=True)
                yield np.append(keys, END), np.append(times, len(group))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return summed(found(batches), 4 * MEMORY, "h")

    return docs.select(text).mapInArrow(frugal(run), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def ranges(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of sorted keys, and where each begins, with the end of the last."""
    span = keys >> keys.dtype.type(64 - RANGE_BITS)
    new = np.ones(len(span), dtype=bool)
    new[1:] = span[1:] != span[:-1]
    at = np.flatnonzero(new)
    return span[at].astype(np.int32), np.append(at, len(span))


def packed(cut: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """The values from each place of ``cut`` to the next as one value. Arrays of numbers would be copied one by one
    whenever they pass between Spark and a task."""
    out = []
    for c in columns:
        offsets = np.ascontiguousarray(cut * c.itemsize, dtype=np.int32)
        out.append(pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(c))]))
    return out


def flat(batch: pa.RecordBatch, column: str | int, kind: type) -> np.ndarray:
    """All values of a column, ``packed`` or not."""
    values = batch.column(column)
    if not pa.types.is_binary(values.type):
        return values.to_numpy()
    _, offsets, data = values.buffers()
    if not len(values) or data is None:
        return np.zeros(0, dtype=kind)
    offsets = np.frombuffer(offsets, dtype=np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]].view(kind)


def lengths(batch: pa.RecordBatch, column: str, kind: type) -> np.ndarray:
    """How many values each row of a ``packed`` column has."""
    return pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal keys stand together, and where each key begins in it."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return order, np.flatnonzero(new)


def packed_counts(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order, at = runs(keys)
    return keys[order[at]], np.add.reduceat(times[order], at) if len(at) else times


def summed(rows: Iterator[tuple[np.ndarray, np.ndarray]], most: int, name: str) -> Iterator[pa.RecordBatch]:
    """``name, c``: the sums of ``keys, times`` of many pieces, passed on whenever there are more than ``most`` keys."""
    kept, size, merged = [], 0, 0
    for piece in rows:
        kept.append(piece)
        size += len(piece[0])
        if size < merged + GATHERED:
            continue
        keys, times = packed_counts(*(np.concatenate(c) for c in zip(*kept)))
        if len(keys) > most:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], [name, "c"])
            keys, times = keys[:0], times[:0]
        kept, size, merged = [(keys, times)], len(keys), len(keys)
    if kept:
        keys, times = packed_counts(*(np.concatenate(c) for c in zip(*kept)))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], [name, "c"])


def unpacked(rows: DataFrame) -> DataFrame:
    """``depth, context, symbol, c`` from ``key, c`` rows."""
    return rows.select(
        F.shiftright("key", 56).cast("int").alias("depth"),
        F.shiftright(F.col("key").bitwiseAND((1 << 56) - 1), BITS).alias("context"),
        F.col("key").bitwiseAND(MASK).cast("int").alias("symbol"),
        "c",
    )


class Words:
    """The frequent words by their hash, with their symbols."""

    def __init__(self, hashes: list[int]):
        """``hashes`` in the order of the symbols, the first of which is ``FIRST``."""
        hashes = np.array(hashes, dtype=np.int64).view(np.uint64)
        order = np.argsort(hashes)
        # Where the hashes of the same first bits begin, and how many they are at most.
        self.begin = np.searchsorted(hashes[order] >> np.uint64(64 - BITS), np.arange(1 << BITS)).astype(np.int32)
        self.most = int(np.diff(self.begin, append=len(order)).max())
        beyond = order[-1:].repeat(self.most)
        self.order = np.append(order, beyond)
        self.sorted = hashes[self.order].view(np.int64)

    def symbol(self, hashes: np.ndarray) -> np.ndarray:
        """The symbol of each word."""
        out = np.full(len(hashes), RARE, dtype=np.int64)
        at = self.begin[hashes.view(np.uint64) >> np.uint64(64 - BITS)]
        for k in range(self.most):
            found = np.flatnonzero(self.sorted[at + k] == hashes)
            out[found] = FIRST + self.order[at[found] + k]
        return out

    def symbols(self, hashes: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """The symbols of each text, its end included."""
        out = self.symbol(hashes)
        ends = np.cumsum(sizes)
        return np.split(np.insert(out, ends, STOP), ends[:-1] + np.arange(1, len(sizes)))


def as_context(data: np.ndarray, last_context: int) -> np.ndarray:
    """Symbols as parts of contexts: words too rare for one are ``NONE``. Ids follow the frequency."""
    return np.where(data > last_context, NONE, data)


def word_keys(texts: list[np.ndarray], last_context: int) -> Iterator[np.ndarray]:
    """Packed (context, symbol) of every symbol of every text, once for each length of context that its
    words allow; a text's start is a context word of its own (``STOP``). Behind any rarer word no context of
    words goes further back: the table has those of each rarer word."""
    start = np.array([STOP])
    data = np.concatenate([x for t in texts for x in (start, start, t)])
    size = np.array([len(t) + 2 for t in texts])
    inside = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
    context = as_context(data, last_context)
    real = inside >= DEPTH
    before, allowed, older = np.zeros(len(data), dtype=np.int64), real, np.zeros(len(data), dtype=np.int64)
    for d in range(DEPTH + 1):
        if d:
            newer, older = older, np.concatenate([np.zeros(d, dtype=np.int64), context[:-d]])
            allowed = allowed & (older != NONE) & (newer != RARE)
            before = before | (older << (BITS * d))
        yield np.where(allowed, before | data | (d << 56), -1)[real]


def transition_counts(docs: DataFrame, words: Words, last_context: int) -> DataFrame:
    """How often each symbol follows each context of words in the texts of ``docs`` (one column)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for _, group in parts(batch, 0, PIECE):
                keys = np.concatenate(list(word_keys(words.symbols(*hashed_words(group)), last_context)))
                yield np.unique(keys[keys >= 0], return_counts=True)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in summed(found(batches), 8 * MEMORY, "key"):
            yield rows.take(pa.array(np.argsort(chained(rows.column(0).to_numpy()))))

    return unpacked(counted_by_range(docs, sums, ["key"], 1))


def kept_contexts(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``depth, context, symbol, c, n`` of the frequent contexts that pass the test, a row each (the empty context
    always does), and all frequent contexts of the greatest length, sorted.

    ``n`` counts all symbols behind the context; rare ones are left out. The three shares bound the rows,
    which come as Arrow columns: a list of as many tuples would take the driver several times the memory.
    """
    counts = stored(counts, "symbols")
    sizes = counts.groupBy("depth", "context").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("kinds"))
    total = sizes.filter("depth = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # The share bounds the number of contexts from here on.
    sizes = stored(sizes.filter((F.col("depth") == 0) | (F.col("n") >= max(1, LEAST_SHARE * total))), "contexts")
    frequent = counts.join(sizes, ["depth", "context"])
    mask = "CASE depth WHEN 1 THEN 0L " + " ".join(f"WHEN {d} THEN {(1 << (BITS * (d - 1))) - 1}L" for d in range(2, DEPTH + 1)) + " END"
    parent = frequent.select(
        (F.col("depth") + 1).alias("depth"), F.col("context").alias("shorter"), "symbol", F.col("c").alias("c_up"), F.col("n").alias("n_up")
    )
    compared = frequent.filter("depth > 0").withColumn("shorter", F.expr(f"context & ({mask})")).join(parent, ["depth", "shorter", "symbol"])
    share, share_up = F.col("c") / F.col("n"), F.col("c_up") / F.col("n_up")
    # Each occurrence is predicted from the others, or chance alone would look like divergence.
    others = F.greatest(F.col("c") - 1 - DISCOUNT, F.lit(0.0)) / F.greatest(F.col("n") - 1, F.lit(1))
    left_out = others + DISCOUNT * F.col("kinds") / F.col("n") * share_up
    divergent = (
        compared.groupBy("depth", "context")
        .agg(F.sum(share * F.log(left_out / share_up)).alias("divergence"))
        .filter(F.col("divergence") >= LEAST_DIVERGENCE)
        .select("depth", "context")
    )
    kept = frequent.join(divergent.unionByName(sizes.filter("depth = 0").select("depth", "context")), ["depth", "context"], "left_semi")
    own = (F.col("depth") == 0) | ((F.col("c") >= LEAST_TIMES) & (F.col("c") >= LEAST_CHANCE * F.col("n")))
    table = kept.filter(own).select(*(F.col(c).cast("long").alias(c) for c in ("depth", "context", "symbol", "c", "n"))).toArrow()
    longest = sizes.filter(F.col("depth") == DEPTH).select("context").toArrow().column(0).to_numpy()
    return np.stack([c.to_numpy() for c in table.columns], axis=1), np.sort(longest)


class SuffixTree:
    """The kept contexts with their smoothed distributions, in log10, as sorted arrays: a Python object for each
    chance would cost every worker ten times the memory. A context is (length, packed symbols)."""

    def __init__(self, rows: np.ndarray | list[tuple[int, int, int, int, int]], alphabet: int):
        """``rows`` as ``kept_contexts`` gives them; the symbols are 0 to ``alphabet`` - 1."""
        rows = np.asarray(rows, dtype=np.int64).reshape(-1, 5)
        context = rows[:, 0] << 56 | rows[:, 1] << BITS
        key, c, n = context | rows[:, 2], rows[:, 3], rows[:, 4]
        order = np.argsort(key)
        context, key, c, n = context[order], key[order], c[order], n[order]
        #: Kept contexts; the empty one is there without any rows too.
        self.contexts, first, kinds = np.unique(np.append(context, 0), return_index=True, return_counts=True)
        kinds[0] -= 1
        owner = np.searchsorted(self.contexts, context)
        sizes = np.append(n, 0)[first]
        sums = np.bincount(owner, weights=c, minlength=len(self.contexts))
        self.keys, self.logs = key, np.zeros(len(key))
        self.rest, self.up = np.zeros(len(self.contexts)), np.full(len(self.contexts), -1, dtype=np.int64)
        whole = sizes[0] + 0.5 * alphabet
        self.rest[0] = math.log10(0.5 / whole)
        depths = self.contexts >> 56
        for d in range(DEPTH + 1):
            own = depths[owner] == d
            if d == 0:
                self.logs[own] = np.log10((c[own] + 0.5) / whole)
                continue
            nodes = np.flatnonzero(depths == d)
            packed = (self.contexts[nodes] & ((1 << 56) - 1)) >> BITS
            self.up[nodes] = self.longest_of(np.full(len(nodes), d - 1), packed)
            rest = np.ones(len(self.contexts))
            rest[nodes] = (sizes[nodes] - sums[nodes] + DISCOUNT * kinds[nodes]) / sizes[nodes]
            self.rest[nodes] = np.log10(rest[nodes])
            shorter = 10 ** self.log10_of(self.up[owner[own]], key[own] & MASK)
            self.logs[own] = np.log10((c[own] - DISCOUNT) / n[own] + rest[owner[own]] * shorter)

    @property
    def nodes(self) -> list[tuple[int, int]]:
        return [(k >> 56, (k & ((1 << 56) - 1)) >> BITS) for k in self.contexts.tolist()]

    def longest_of(self, depth: np.ndarray, context: np.ndarray) -> np.ndarray:
        """The place of the longest kept suffix, no longer than ``depth``, of each context."""
        out = np.zeros(len(depth), dtype=np.int64)
        for d in range(1, DEPTH + 1):  # longer ones later, so they win
            key = d << 56 | (context & ((1 << (BITS * d)) - 1)) << BITS
            at = np.minimum(np.searchsorted(self.contexts, key), len(self.contexts) - 1)
            out = np.where((depth >= d) & (self.contexts[at] == key), at, out)
        return out

    def log10_of(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The logarithm of the chance of each symbol in a kept context."""
        out, node, open_ = np.zeros(len(node)), node.copy(), np.arange(len(node))
        while len(open_):
            key = self.contexts[node[open_]] | symbol[open_]
            if len(self.keys):
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                found = self.keys[at] == key
                out[open_[found]] += self.logs[at[found]]
            else:
                found = np.zeros(len(open_), dtype=bool)
            open_ = open_[~found]
            out[open_] += self.rest[node[open_]]
            node[open_] = self.up[node[open_]]
            open_ = open_[node[open_] >= 0]
        return out

    def longest(self, depth: int, context: int) -> tuple[int, int]:
        """The longest kept suffix of a context."""
        key = int(self.contexts[self.longest_of(np.array([depth]), np.array([context]))[0]])
        return key >> 56, (key & ((1 << 56) - 1)) >> BITS

    def log10(self, node: tuple[int, int], symbol: int) -> float:
        """The logarithm of the chance of ``symbol`` in a kept context."""
        at = np.searchsorted(self.contexts, node[0] << 56 | node[1] << BITS)
        return float(self.log10_of(np.array([at]), np.array([symbol]))[0])


class Model:
    """The tree and the counts of frequent words: all that a task needs besides the rarer words' counts."""

    def __init__(self, words: Words, log_counts: np.ndarray, last_context: int, tree: SuffixTree):
        self.words, self.log_counts, self.last_context, self.tree = words, log_counts, last_context, tree

    def transitions(self, texts: list[np.ndarray]) -> np.ndarray:
        """For each text the log10 probability of its symbols. Equal transitions are looked up once."""
        keys = None
        for longer in word_keys(texts, self.last_context):
            keys = longer if keys is None else np.where(longer >= 0, longer, keys)
        unique, back = np.unique(keys, return_inverse=True)
        node = self.tree.longest_of(unique >> 56, (unique & ((1 << 56) - 1)) >> BITS)
        chance = self.tree.log10_of(node, unique & MASK)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        return np.bincount(owner, weights=chance[back], minlength=len(texts))


def chained(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit key of several values in order."""
    out = np.uint64(0)
    for part in parts:
        out = mixed((out + np.asarray(part).astype(np.int64).view(np.uint64)) * MULTIPLIER + np.uint64(1))
    return out


def marked_slots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two of 2^``bits`` bits that mark each key."""
    keys = keys.view(np.uint64)
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int64), (keys >> np.uint64(64 - bits)).astype(np.int64)


class Marks:
    """Keys marked in a fixed number of bits: whether a key may be among them."""

    def __init__(self, keys: DataFrame):
        """``keys`` has one column: a key, or several of them, packed."""
        # Of that size are the bitmaps that Spark joins.
        size, slots = 4096, MARK_BITS

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(1 << slots, dtype=bool)
            for batch in batches:
                for slot in marked_slots(flat(batch, 0, np.int64), slots):
                    bits[slot] = True
            rows = np.packbits(bits, bitorder="little").reshape(-1, size)
            used = np.flatnonzero(rows.any(axis=1))
            cut = np.arange(len(used) + 1) * size
            yield pa.RecordBatch.from_arrays([pa.array(used), *packed(cut, rows[used].ravel())], ["bucket", "bits"])

        rows = keys.mapInArrow(frugal(run), "bucket long, bits binary").groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        rows = stored(rows, "marks").toArrow()
        self.slots, self.bits = slots, np.zeros((1 << slots) // 8, dtype=np.uint8)
        for bucket, bits in zip(rows.column(0).to_pylist(), rows.column(1)):
            self.bits[size * bucket : size * (bucket + 1)] = np.frombuffer(bits.as_buffer(), dtype=np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        low, high = marked_slots(keys, self.slots)
        out = self.bits[low >> 3] >> (low & 7).astype(np.uint8) & 1 == 1
        at = np.flatnonzero(out)
        high = high[at]
        out[at] = self.bits[high >> 3] >> (high & 7).astype(np.uint8) & 1 == 1
        return out


def histories(hashes: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """For every symbol of every text, its end included: hash, symbol, and both of the one and of the two before.

    ``hashes`` are those of all words; the start of a text is a word of its own.
    """
    size = np.array([len(t) for t in texts])
    ends = np.cumsum(size) - 1
    h = np.insert(hashes, ends - np.arange(len(texts)), END)
    data = np.concatenate(texts)
    inside = np.arange(len(h)) - np.repeat(ends + 1 - size, size)
    out = [h, data]
    for back in range(1, DEPTH + 1):
        at = np.maximum(np.arange(len(h)) - back, 0)
        started = inside >= back
        out += [np.where(started, h[at], START), np.where(started, data[at], STOP)]
    return tuple(out)


def in_table(last_context: int, frequent: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which contexts of one and of two words, given by their symbols, are not frequent."""
    rest_one, rest_two = ((x == RARE) | (x > last_context) for x in (one, two))
    packed = (two << BITS) | one
    at = np.minimum(np.searchsorted(frequent, packed), max(len(frequent) - 1, 0))
    known = frequent[at] == packed if len(frequent) else np.zeros(len(one), dtype=bool)
    # The start before the start says no more than the start alone.
    return rest_one, (rest_one | rest_two | ~known) & ((one != STOP) | (two != STOP))


def gathered(rows: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """``rows`` as fewer, longer ones: columns of several pieces behind each other, ``GATHERED`` rows and more."""
    kept, size = [], 0
    for columns in rows:
        kept.append(columns)
        size += len(columns[0])
        if size >= GATHERED:
            # Nothing is held here of what is passed on.
            whole, kept, size = [tuple(np.concatenate(c) for c in zip(*kept))], [], 0
            yield whole.pop()
    if kept:
        yield tuple(np.concatenate(c) for c in zip(*kept))


def counted(rows: Iterator[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """``names, c``: equal rows are counted in each piece and again in what is gathered of several."""

    def of_pieces() -> Iterator[tuple[np.ndarray, ...]]:
        for columns in rows:
            key = chained(*columns)
            order, at = runs(key)
            yield (key[order[at]], *(c[order[at]] for c in columns), np.diff(at, append=len(key)))

    def merged(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        key, *columns, times = found
        order, at = runs(key)
        sums = np.add.reduceat(times[order], at) if len(at) else times
        return pa.RecordBatch.from_arrays([*(pa.array(c[order[at]]) for c in columns), pa.array(sums)], [*names, "c"])

    return map(merged, gathered(of_pieces()))


def counted_by_range(docs: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], names: list[str], least: int) -> DataFrame:
    """``names, c``: sums of the counts of equal ``rows`` (``names, c``) that the tasks have of ``docs``, if they are at
    least ``least``. A task's rows come sorted by key and are dealt out by ranges of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            columns = [c.to_numpy() for c in batch.columns]
            span, cut = ranges(chained(*columns[:-1]))
            yield pa.RecordBatch.from_arrays([pa.array(span), *packed(cut, *columns)], ["span", *names, "c"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_ranges(batches):
            columns = [np.concatenate([flat(b, n, np.int64) for b in whole]) for n in (*names, "c")]
            order, at = runs(chained(*columns[:-1]))
            sums = np.add.reduceat(columns[-1][order], at) if len(at) else columns[-1]
            often = sums >= least
            at = order[at[often]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[at]) for c in columns[:-1]), pa.array(sums[often])], [*names, "c"])

    sent = docs.mapInArrow(frugal(run), ", ".join(["span int", *(f"{n} binary" for n in names), "c binary"]))
    return sent.repartition("span").sortWithinPartitions("span").mapInArrow(frugal(merged), ", ".join(f"{n} long" for n in (*names, "c")))


def whole_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Sorted rows of ranges, so that those of one range stay together: ``GATHERED`` values and more, if ranges allow it."""
    kept, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        span, ends = batch.column("span").to_numpy(), np.append(0, np.cumsum(lengths(batch, "c", np.int64)))
        if size >= GATHERED and kept[-1].column("span")[-1].as_py() != span[0]:
            yield kept
            kept, size = [], 0
        start = 0
        for at in np.flatnonzero(span[1:] != span[:-1]) + 1:
            if size + ends[at] - ends[start] >= GATHERED:
                yield [*kept, batch.slice(start, at - start)]
                kept, size, start = [], 0, at
        kept.append(batch.slice(start))
        size += ends[-1] - ends[start]
    if kept:
        yield kept


def repeated_pairs(docs: DataFrame, words: Words, marks: Marks) -> DataFrame:
    """``b, s, c``: how often ``s`` follows the word ``b``, by their hash, if twice or more. ``marks`` has the rarer
    words that occur twice or more."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            for _, group in parts(batch, 0, PIECE):
                hashes, sizes = hashed_words(group)
                s, symbol, b, before, *_ = histories(hashes, words.symbols(hashes, sizes))
                often = np.flatnonzero(((symbol != RARE) | marks(s)) & ((before != RARE) | marks(b)))
                yield b[often], s[often]

    return counted_by_range(docs, lambda batches: counted(found(batches), ["b", "s"]), ["b", "s"], LEAST_TIMES)


def repeated_triples(docs: DataFrame, words: Words, last_context: int, frequent: np.ndarray, marks: Marks) -> DataFrame:
    """``a, b, s, c``: how often ``s`` follows the words ``a`` and ``b``, a context that is not frequent, if twice or more.

    ``marks`` has the pairs that occur twice or more; no triple does without both of its pairs.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            for _, group in parts(batch, 0, PIECE):
                hashes, sizes = hashed_words(group)
                s, _, b, one, a, two = histories(hashes, words.symbols(hashes, sizes))
                often = np.flatnonzero(in_table(last_context, frequent, one, two)[1])
                often = often[marks(chained(b[often], s[often]))]
                often = often[marks(chained(a[often], b[often]))]
                yield a[often], b[often], s[often]

    return counted_by_range(docs, lambda batches: counted(found(batches), ["a", "b", "s"]), ["a", "b", "s"], LEAST_TIMES)


def keyed(table: DataFrame, *names: str) -> DataFrame:
    """``table`` with ``key``, that of the columns, as ``chained`` gives it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = chained(*(batch.column(n).to_numpy() for n in names)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, "key"])

    return table.mapInArrow(frugal(run), ", ".join([*(f"{n} {t}" for n, t in table.dtypes), "key long"]))


def rest_rows(counts: DataFrame, shared: Broadcast, depth: int) -> DataFrame:
    """``counts`` (``a, b, s, c``, with ``depth`` 1 ``n`` too) as ``context, pair, word, below, rare, rest, up, c[, n]``: the keys
    of the context and of its symbol; that of the word if it is a rarer one; that of the pair ``b, s`` if what the table says
    of contexts of one word, or the rarer word, changes its chance; and the logarithm of the chance of the symbol in the
    longest kept suffix in the collected part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            a, b, s = (batch.column(k).to_numpy() for k in range(3))
            before = np.where(b == START, STOP, model.words.symbol(b))
            symbol = np.where(s == END, STOP, model.words.symbol(s))
            # The longest suffix in the collected part, of the words' classes.
            one = as_context(before, model.last_context)
            two = as_context(np.where(a == START, STOP, model.words.symbol(a)), model.last_context) if depth > 1 else np.zeros_like(one)
            long = (two != NONE) & (one != RARE)
            node = model.tree.longest_of(np.where(one == NONE, 0, np.where(long, 2, 1)), (np.where(long, two, 0) << BITS) | one)
            rest, rare = (before == RARE) | (one == NONE), symbol == RARE
            up = model.tree.log10_of(node, symbol)
            key = chained(b) if depth == 1 else chained(a, b)
            pair = chained(key, s)
            # Keys that no table has are spread over the partitions.
            own = chained(key, s, 0)
            below = np.where(rest | rare, chained(chained(b), s), own)
            keys = [pa.array(x.view(np.int64)) for x in (key, pair, np.where(rare, s.view(np.uint64), own), below)]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(rare), pa.array(rest), pa.array(up), *batch.columns[3:]], ["context", "pair", "word", "below", "rare", "rest", "up", *batch.schema.names[3:]]
            )

    given = ["c", "n"] if depth == 1 else ["c"]
    schema = "context long, pair long, word long, below long, rare boolean, rest boolean, up double, " + ", ".join(f"{n} long" for n in given)
    return counts.select("a", "b", "s", *given).mapInArrow(frugal(run), schema)


def judged(up: np.ndarray, c: np.ndarray, n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each context is kept, what it adds to the logarithm of the chance of any symbol in the longest kept
    suffix (``up``), and what each of its own symbols adds beside. Contexts begin ``at`` these rows.

    ``c`` are the counts of the repeated symbols of a context and ``n`` (one for each context) says how often it occurs. As
    every occurrence has one symbol behind it, ``n`` tells how many symbols were seen once there. Without ``n``, which
    is 0 then, nothing is kept.
    """
    size = np.diff(at, append=len(c))
    known, n = n > 0, np.maximum(n, 1)
    ones = n - np.add.reduceat(c, at)
    kinds = ones + size
    back = DISCOUNT * kinds / n
    rest = (ones + DISCOUNT * size) / n
    up, of = 10.0**up, np.repeat(np.arange(len(at)), size)
    with np.errstate(all="ignore"):
        left_out = np.maximum(c - 1 - DISCOUNT, 0.0) / (n[of] - 1) + back[of] * up
        divergence = np.add.reduceat(c / n[of] * np.log(left_out / up), at)
        # Words seen once in the context have nothing to predict them but the discount.
        kept = known & (divergence + ones / n * np.log(back) >= LEAST_DIVERGENCE)
        more = np.log10(((c - DISCOUNT) / n[of] + rest[of] * up) / up) - np.log10(rest)[of]
        return kept, np.log10(rest), more


def rest_table(rows: DataFrame, pairs: bool) -> DataFrame:
    """The table, as ``ranged`` gives it, that ``context, pair, up, c, n, lower`` rows make; with ``pairs`` also all that a context
    and what is below it (``lower``) add for each pair. ``n`` may stand in a row of its own, without a pair."""
    # No nulls, or Arrow would give numbers of 64 bits as double.
    rows = rows.select("context", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("pair", "up", "c", "n", "lower")))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """``key, value, kind`` of whole contexts. Contexts that are not frequent are no large groups."""
        kept: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                context = batch.column(0).to_numpy()
                last = int(np.searchsorted(context, context[-1]))
                if not last and (not kept or kept[-1].column(0)[-1].as_py() == context[0]):
                    kept.append(batch)
                    continue
                whole, kept = [*kept, batch.slice(0, last)], [batch.slice(last)]
            else:
                whole = kept
            if whole:
                yield of_contexts(*(np.concatenate([b.column(k).to_numpy() for b in whole]) for k in range(6)))

    def of_contexts(context: np.ndarray, pair: np.ndarray, up: np.ndarray, c: np.ndarray, n: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        new = np.ones(len(context), dtype=bool)
        new[1:] = context[1:] != context[:-1]
        of = np.cumsum(new) - 1
        size = np.maximum.reduceat(n, np.flatnonzero(new)) if len(of) else n
        real = np.flatnonzero(c > 0)
        context, pair, up, c, lower, of = (x[real] for x in (context, pair, up, c, lower, of))
        at = np.flatnonzero(np.diff(of, prepend=-1))
        if not len(at):
            return np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int32)
        kept, rest, more = judged(up, c, size[of[at]], at)
        times = np.diff(at, append=len(c))
        own = np.repeat(kept, times)
        keys, values = [context[at[kept]], pair[own]], [rest[kept], more[own]]
        kinds = [np.full(len(keys[0]) + len(keys[1]), TREE, dtype=np.int32)]
        if pairs:
            keys.append(pair)
            values.append(lower + np.where(own, np.repeat(rest, times) + more, 0.0))
            kinds.append(np.full(len(pair), PAIR, dtype=np.int32))
        return np.concatenate(keys), np.concatenate(values), np.concatenate(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_range(found(batches))

    return rows.repartition("context").sortWithinPartitions("context").mapInArrow(frugal(run), RANGED)


#: Columns of a part of the table: ``keys`` and ``values`` of one range and kind.
RANGED = "kind int, span int, keys binary, values binary"


def by_range(rows: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """``RANGED`` rows of ``key, value, kind``."""
    for key, value, kind in gathered(rows):
        for k in np.unique(kind):
            of_kind = np.flatnonzero(kind == k)
            order = of_kind[np.argsort(key[of_kind])]
            span, cut = ranges(key[order])
            columns = [pa.array(np.full(len(span), k)), pa.array(span), *packed(cut, key[order], value[order])]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "span", "keys", "values"])


def ranged(table: DataFrame) -> DataFrame:
    """``table`` (``key, value, kind``) as a row for each range of keys and kind that a task has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_range(tuple(c.to_numpy() for c in b.columns) for b in batches)

    return table.select("key", "value", "kind").mapInArrow(frugal(run), RANGED)


def unranged(rows: DataFrame) -> DataFrame:
    """``key, value`` of ``ranged`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(flat(b, 0, np.int64)), pa.array(flat(b, 1, np.float64))], ["key", "value"])

    return rows.select("keys", "values").mapInArrow(frugal(run), "key long, value double")


def one_word_table(pairs: DataFrame, contexts: DataFrame, shared: Broadcast, rarer: DataFrame, unknown: float) -> DataFrame:
    """The part of the table with contexts of one word, and for each repeated pair of words (``PAIR``) all that its rarer
    word and that part add to the logarithm of the chance in the collected part.

    A longer context asks for that one number of each of its symbols: whatever follows it twice follows its last word
    twice. ``contexts`` has the words (``b``) that are no frequent contexts and ``n``, how often each occurs; ``rarer``
    has ``key, value`` of the rarer words.
    """
    counts = pairs.join(contexts.hint("shuffle_hash"), "b", "left").withColumn("a", F.lit(0).cast("long"))
    # Pairs behind a frequent context are groups of their own; those of two frequent words say nothing.
    rows = rest_rows(counts, shared, 1).filter("rest OR rare").withColumn("context", F.when(F.col("rest"), F.col("context")).otherwise(F.col("pair")))
    rows = rows.join(rarer.select(F.col("key").alias("word"), F.col("value").alias("of_word")).hint("shuffle_hash"), "word", "left")
    lower = F.when(F.col("rare"), F.coalesce("of_word", F.lit(unknown))).otherwise(0.0)
    rows = rows.withColumn("lower", lower).withColumn("up", F.col("up") + F.col("lower"))
    return stored(rest_table(rows, pairs=True), "rest-table")


def two_word_table(triples: DataFrame, sizes: DataFrame, shared: Broadcast, of_pairs: DataFrame) -> DataFrame:
    """The part of the table with contexts of two words. ``sizes`` has ``key, n``, how often each context occurs, and
    ``of_pairs`` ``key, value`` of the pairs of ``one_word_table``."""
    rows = rest_rows(triples, shared, 2).select("context", "pair", "below", "up", "c")
    rows = rows.join(of_pairs.select(F.col("key").alias("below"), F.col("value").alias("lower")).hint("shuffle_hash"), "below", "left")
    rows = rows.select("context", "pair", (F.col("up") + F.coalesce("lower", F.lit(0.0))).alias("up"), "c", F.lit(0.0).alias("lower"))
    rows = rows.unionByName(sizes.select(F.col("key").alias("context"), "n"), allowMissingColumns=True)
    return stored(rest_table(rows, pairs=False), "rest-table")


#: Columns of what texts ask for: the number of the first text, the key, whether it is one of the table, how far behind
#: the first each text that has the key comes and how often it has it (32 bits each), and a text's own values.
ASKED = ["row", "h", "is_tree", "texts", "own"]


def once_a_text(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once for a text, the text and how often it has the key."""
    order, at = runs(chained(key, owner))
    return key[order[at]], owner[order[at]], np.diff(at, append=len(key))


def grouped(is_tree: np.ndarray, key: np.ndarray, row: np.ndarray, times: np.ndarray, own_type: pa.DataType) -> pa.RecordBatch:
    """One row for each key, with the list of its texts."""
    order = np.argsort(key)
    is_tree, key, first_row = is_tree[order], key[order], row.min(initial=1 << 62)
    new = np.ones(len(key), dtype=bool)
    # A word that has the key of a row of the table only makes a few rows more.
    new[1:] = (key[1:] != key[:-1]) | (is_tree[1:] != is_tree[:-1])
    at = np.flatnonzero(new)
    texts = pa.ListArray.from_arrays(np.append(at, len(key)).astype(np.int32), ((row - first_row) << 32 | times)[order])
    columns = [pa.array(np.full(len(at), first_row)), pa.array(key[at]), pa.array(is_tree[at]), texts, pa.nulls(len(at), own_type)]
    return pa.RecordBatch.from_arrays(columns, ASKED)


def asked_rows(asked: pa.RecordBatch, first: int, own: pa.StructArray) -> Iterator[pa.RecordBatch]:
    """The rows, one for each range of keys, of what ``grouped`` texts ask for, and one with their own values. All that these
    texts get goes by ``first``, the number of the first of them."""
    keys, texts = asked.column("h").to_numpy(), asked.column("texts")
    span, cut = ranges(keys)
    n, offsets, packed_times = len(span), texts.offsets.to_numpy(), texts.values.to_numpy()
    behind = (packed_times >> 32) + (asked.column("row")[0].as_py() - first if len(keys) else 0)
    columns = [pa.array(np.full(n, ASK, dtype=np.int32)), pa.array(span), pa.array(np.full(n, first))]
    is_tree = asked.column("is_tree").to_numpy(zero_copy_only=False)
    columns += packed(cut, keys, is_tree, np.diff(offsets)) + packed(offsets[cut], behind.astype(np.int32), (packed_times & 0xFFFFFFFF).astype(np.int32))
    yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.list_(own.type))], SENT)
    anywhere = (first ^ first >> 33) % (1 << RANGE_BITS)
    columns = [pa.array([OWN], pa.int32()), pa.array([anywhere], pa.int32()), pa.array([first]), *(pa.nulls(1, pa.binary()) for _ in range(5))]
    yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(np.array([0, len(own)], dtype=np.int32), own)], SENT)


class Lookup:
    """Values by their key, in a task."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        keys, values = (np.concatenate(c) for c in zip((np.zeros(0, dtype=np.int64), np.zeros(0)), *rows))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, 0 without one; a key that two rows have gets both values."""
        at = np.searchsorted(self.keys, keys)
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        while len(todo):
            todo = todo[at[todo] < len(self.keys)]
            todo = todo[self.keys[at[todo]] == keys[todo]]
            out[todo] += self.values[at[todo]]
            at[todo] += 1
        return out


def met_rows(batches: Iterator[pa.RecordBatch], of_count: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """``first, texts, value, log, seen, own`` of the rows of some ranges, sorted by their kind: for all texts that a task took
    together, what the table, and the rarer words beside unknown ones, add to both scores and to the known words."""
    rows: tuple[list, list] = ([], [])
    known: list[Lookup] = []
    for batch in batches:
        cut = np.searchsorted(batch.column("kind").to_numpy(), np.arange(OWN + 2))
        of = [batch.slice(cut[k], cut[k + 1] - cut[k]) for k in range(OWN + 1)]
        for kind in (TREE, WORD):
            # Copies, as the rows of a batch would keep all of it.
            rows[kind].append((flat(of[kind], "keys", np.int64).copy(), flat(of[kind], "values", np.float64).copy()))
        names = ["first", "texts", "value", "log", "seen", "own"]
        if of[OWN].num_rows:
            n, own = of[OWN].num_rows, of[OWN].column("own")
            yield pa.RecordBatch.from_arrays([of[OWN].column("first"), *(pa.nulls(n, pa.binary()) for _ in range(4)), own], names)
        if not of[ASK].num_rows:
            continue
        if not known:
            known = [Lookup(r) for r in rows]
        keys, is_tree, counts = (flat(of[ASK], c, t) for c, t in (("keys", np.int64), ("is_tree", bool), ("counts", np.int32)))
        value, log, seen = np.zeros(len(keys)), np.zeros(len(keys)), np.zeros(len(keys), dtype=np.int64)
        value[is_tree] = known[TREE](keys[is_tree])
        words = np.flatnonzero(~is_tree)
        c = known[WORD](keys[words])
        words, c = words[c > 0], c[c > 0]
        value[words], log[words], seen[words] = of_count(c), np.log10(c + 0.5) - math.log10(0.5), 1
        found = (value != 0) | (seen > 0)
        of_text = np.repeat(found, counts)
        first = np.repeat(of[ASK].column("first").to_numpy(), lengths(of[ASK], "texts", np.int32))[of_text]
        text, times = (flat(of[ASK], c, np.int32)[of_text] for c in ("texts", "times"))
        order, at = runs(first + text)
        first, text = first[order[at]], text[order[at]]
        sums = []
        for x in (value, log, seen):
            x = np.repeat(x[found], counts[found]) * times
            sums.append(np.add.reduceat(x[order], at) if len(at) else x)
        new = np.ones(len(first), dtype=bool)
        new[1:] = first[1:] != first[:-1]
        at = np.flatnonzero(new)
        columns = packed(np.append(at, len(first)), text, *sums)
        yield pa.RecordBatch.from_arrays([pa.array(first[at]), *columns, pa.nulls(len(at), of[OWN].column("own").type)], names)


def text_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of texts from all of their ``met_rows``, which are in one partition."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    own = [b.filter(b.column("own").is_valid()) for b in rows]
    values = pa.concat_arrays([b.column("own").flatten() for b in own])
    size = np.concatenate([pc.list_value_length(b.column("own")).to_numpy() for b in own]).astype(np.int64)
    first = np.concatenate([b.column("first").to_numpy() for b in own])
    row = np.repeat(first, size) + np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
    order = np.argsort(row)
    met = [b.filter(b.column("texts").is_valid()) for b in rows]
    text = np.concatenate([np.repeat(b.column("first").to_numpy(), lengths(b, "texts", np.int32)) + flat(b, "texts", np.int32) for b in met])
    place = order[np.searchsorted(row[order], text)] if len(text) else text
    value, log, seen = (
        np.bincount(place, weights=np.concatenate([flat(b, c, t) for b in met]), minlength=len(row))
        for c, t in (("value", np.float64), ("log", np.float64), ("seen", np.int64))
    )
    doc_id, held, size, words, base, score = values.flatten()
    columns = [doc_id, held, size, pa.array(words.to_numpy() + seen.astype(np.int64)), pa.array(base.to_numpy() + log), pa.array(score.to_numpy() + value)]
    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "logs", "score"])


def lm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Null and empty texts are their end alone; repeated rows and null keys are scored like any other (rows
    are told apart by their place in the scan); other columns are ignored. Without training texts the
    tree knows nothing and every symbol is equally likely. A rarer word or key of the table is one key of the
    join for the texts that a task takes together, with a list of those that have it; a frequent word, which
    would be a hot key there, never enters it. Keys are dealt out, and joined, by ranges, and the texts in
    ``ROUNDS`` parts, by key.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(doc_id).alias("held_out"))
    training = rows.filter(~F.col("held_out")).select("text")
    words = stored(word_counts(training, "text"), "words")
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = words.filter(F.col("h") == END).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    least = max(LEAST_COUNT, FREQUENT * total)
    top = words.filter((F.col("h") != END) & (F.col("c") >= least)).collect()
    top.sort(key=lambda r: (-r["c"], r["h"]))
    frequent = Words([r["h"] for r in top])
    log_counts = np.zeros(FIRST + len(top))
    log_counts[STOP] = math.log10(ends + 0.5)
    log_counts[FIRST:] = np.log10(np.array([r["c"] for r in top], dtype=float) + 0.5)
    last_context = FIRST - 1 + sum(r["c"] >= LEAST_SHARE * total for r in top)
    rarer = words.filter((F.col("h") != END) & (F.col("c") < least))
    rare = rarer.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words"), F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice")
    ).first()
    # What counts of rarer words lose to unknown ones: as often as words are seen once rather than twice.
    # Without any seen twice that would leave nothing of a count of one.
    lost = rare["once"] / (rare["once"] + 2 * rare["twice"]) if rare["once"] and rare["twice"] else DISCOUNT
    kept, longest = kept_contexts(transition_counts(training, frequent, last_context))
    model = Model(frequent, log_counts, last_context, SuffixTree(kept, len(log_counts)))
    unknown = math.log10((lost * rare["words"] + 1) / (rare["tokens"] + 1.0))
    shared = spark.sparkContext.broadcast(model)
    of_word = F.log10((F.col("c") - F.lit(lost)) / F.lit(rare["tokens"] + 1.0))
    known_words = rarer.select(F.col("h").alias("key"), of_word.alias("value"))
    pairs = stored(repeated_pairs(training, frequent, Marks(rarer.filter("c > 1").select("h"))), "pairs")
    # Words that are no contexts of the collected part, with their counts.
    contexts = words.filter((F.col("h") != END) & (F.col("c") < max(least, LEAST_SHARE * total))).select(F.col("h").alias("b"), F.col("c").alias("n"))
    below = one_word_table(pairs, contexts, shared, known_words, unknown)
    sizes = keyed(pairs, "b", "s").select("key", F.col("c").alias("n"))
    triples = stored(repeated_triples(training, frequent, last_context, longest, Marks(sizes.select("key"))), "triples")
    table = two_word_table(triples, sizes, shared, unranged(below.filter(F.col("kind") == PAIR)))
    table = below.filter(F.col("kind") == TREE).unionByName(table)
    marked = spark.sparkContext.broadcast(Marks(table.select("keys")))

    def looked_up(hashes: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The keys that the table may have, each once for a text with its number."""
        marks = marked.value
        s, _, b, b_symbol, a, a_symbol = histories(hashes, texts)
        text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        keys, owner = [], []
        for wanted, context in zip(in_table(last_context, longest, b_symbol, a_symbol), (lambda at: chained(b[at]), lambda at: chained(a[at], b[at]))):
            at = np.flatnonzero(wanted)
            key = context(at)
            passed = marks(key)
            at, key = at[passed], key[passed]
            pair = chained(key, s[at])
            with_pair = marks(pair)
            keys += [key, pair[with_pair]]
            owner += [text[at], text[at[with_pair]]]
        return once_a_text(np.concatenate(keys).view(np.int64), np.concatenate(owner))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_rows: list[tuple[int, pa.StructArray]] = []
        for is_tree, key, row, times in gathered(asked(batches, own_rows)):
            first, own = own_rows[0][0], pa.concat_arrays([values for _, values in own_rows])
            own_rows.clear()
            yield from asked_rows(grouped(is_tree, key, row, times, pa.null()), first, own)

    def asked(batches: Iterator[pa.RecordBatch], own_rows: list[tuple[int, pa.StructArray]]) -> Iterator[tuple[np.ndarray, ...]]:
        """Whether it is one of the table, key, row and times of what each text asks for; the number of the first text
        and the texts' own values go to ``own_rows``."""
        model = shared.value
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for done, group in parts(batch, 1, PIECE):
                hashes, sizes = hashed_words(group)
                texts = model.words.symbols(hashes, sizes)
                m = len(texts)
                known = np.array([int((t >= FIRST).sum()) + int(ends > 0) for t in texts])
                base = np.array([float(model.log_counts[t].sum()) for t in texts])
                # Every rarer word counts as unknown until it meets its count.
                unseen = np.array([int((t == RARE).sum()) for t in texts])
                base, score = base + unseen * math.log10(0.5), model.transitions(texts) + unseen * unknown
                values = [batch.column(0).slice(done, m), batch.column(2).slice(done, m), pa.array([len(t) for t in texts], pa.int64())]
                values += [pa.array(known), pa.array(base), pa.array(score)]
                own_rows.append((number, pa.StructArray.from_arrays(values, ["doc_id", "held_out", "size", "known", "base", "score"])))
                # The rarer words of each text, each once with its number.
                is_rare = np.concatenate([t[:-1] for t in texts]) == RARE
                of_words = once_a_text(hashes[is_rare], np.repeat(np.arange(m), sizes)[is_rare])
                of_tree = looked_up(hashes, texts)
                is_tree = np.repeat([False, True], [len(of_words[0]), len(of_tree[0])])
                key, owner, times = (np.concatenate(c) for c in zip(of_words, of_tree))
                yield is_tree, key, number + owner, times
                number += m

    def of_count(c: np.ndarray) -> np.ndarray:
        return np.log10((c - lost) / (rare["tokens"] + 1.0)) - unknown

    own = f"array<struct<doc_id: {kind}, held_out: boolean, size: long, known: long, base: double, score: double>>"
    schema = f"kind int, span int, first long, keys binary, is_tree binary, counts binary, texts binary, times binary, own {own}"
    met_schema = f"first long, texts binary, value binary, log binary, seen binary, own {own}"
    sums_schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, score double"
    counts = rarer.select(F.col("h").alias("key"), F.col("c").cast("double").alias("value"), F.lit(WORD).alias("kind"))
    lookup = table.unionByName(stored(ranged(counts), "word-table"))
    scored = []
    for k in range(ROUNDS):
        part = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == k).mapInArrow(frugal(run), schema)
        # A task holds the table of its ranges of keys in memory; what the texts ask for passes by.
        met = part.unionByName(lookup, allowMissingColumns=True).repartition("span").sortWithinPartitions("kind", "first")
        met = met.mapInArrow(frugal(lambda batches: met_rows(batches, of_count)), met_schema)
        scored.append(stored(met.repartition("first").mapInArrow(frugal(text_sums), sums_schema), "scores"))
    sums = functools.reduce(DataFrame.unionByName, scored)
    whole = math.log10(total + 0.5 * (distinct + 1))
    return sums.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        "score",
    )
