"""Periodic runs of words: candidates on a harmonic grid, extended exactly through a run-length grammar.

A stretch of four periods ``p`` holds four multiples of ``p``, so three equal steps on the grid of every
``p`` find a place in each such run; the grids of all periods have n ln n places together. How far the
period reaches from there is a longest common extension of two places of one text. It is read off a
grammar made by recompression: blocks of one symbol and pairs over a partition of the symbols are
replaced in turn, equal factors alike wherever they stand, so that two places climb the levels side by
side while they match and come down at the first difference, in a number of steps that grows with the
logarithm of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import MULTIPLIER, PIECE, fresh, groups, mixed, utf8, word_hashes

#: Candidates that are extended at one time.
CHUNK = 1 << 18
#: Steps on the grid that a run must show, so runs have an exponent of one more at least.
STEPS = 3

RUN = "array<struct<start:long,length:long,period:long>>"


@dataclass
class Level:
    """One sequence of the grammar, and the phrases of it that are the symbols of the next level."""

    symbols: np.ndarray
    up: np.ndarray  # the phrase of each symbol
    first: np.ndarray  # the first symbol of each phrase, and the end
    blocks: bool


def _named(keys: np.ndarray, new: int) -> tuple[np.ndarray, int]:
    names, place = np.unique(keys, return_inverse=True)
    return place + new, new + len(names)


def recompressed(symbols: np.ndarray) -> list[Level]:
    """The levels of the grammar of ``symbols``. Negative symbols are separators, each of them once, at both
    ends too; they stay as they are, and the last level has one symbol between any two of them."""
    levels, now, new, turn = [], symbols, int(symbols.max(initial=0)) + 1, 0
    while ((now[1:] >= 0) & (now[:-1] >= 0)).any():
        begins = np.ones(len(now), dtype=bool)
        blocks = turn % 2 == 0
        if blocks:
            begins[1:] = now[1:] != now[:-1]
        else:
            side = (mixed(now.astype(np.uint64) * MULTIPLIER + np.uint64(turn)) & np.uint64(1)).astype(bool)
            word = now >= 0
            left, right = word & side, word & ~side
            pairs, others = left[:-1] & right[1:], right[:-1] & left[1:]
            begins[1:] = ~max(pairs, others, key=np.count_nonzero)
        turn += 1
        if begins.all():
            continue
        first = np.append(np.flatnonzero(begins), len(now))
        size = np.diff(first)
        after = now[first[:-1]]
        many = size > 1
        second = size[many] if blocks else now[first[:-1][many] + 1]
        after[many], new = _named(after[many] << 32 | second, new)
        levels.append(Level(now, np.cumsum(begins) - 1, first, blocks))
        now = after
    levels.append(Level(now, np.arange(len(now)), np.arange(len(now) + 1), True))
    return levels


def extended(levels: list[Level], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many symbols from places ``a`` and ``b`` on are equal, to the right (``step`` 1) or left (-1).

    ``a`` and ``b`` differ and lie between the same separators.
    """
    x, y = a.copy(), b.copy()
    differ: list[list[np.ndarray]] = [[] for _ in levels]
    active = np.arange(len(a))
    for h, level in enumerate(levels):
        same = level.symbols[x[active]] == level.symbols[y[active]]
        differ[h].append(active[~same])
        active = active[same]
        if not len(active):
            break
        p, q = x[active], y[active]
        u, v = level.up[p], level.up[q]
        if step > 0:
            rest_p, rest_q = level.first[u + 1] - p, level.first[v + 1] - q
            edge = (level.first[u] == p) & (level.first[v] == q)
        else:
            rest_p, rest_q = p - level.first[u] + 1, q - level.first[v] + 1
            edge = (level.first[u + 1] == p + 1) & (level.first[v + 1] == q + 1)
        # Inside a phrase: go to its end. Parts of blocks that differ in length end the match.
        move = np.where(edge, 0, np.minimum(rest_p, rest_q)) * step
        x[active], y[active] = p + move, q + move
        ends = ~edge & (rest_p != rest_q)
        differ[h].append(active[ends])
        active = active[~ends]
        x[active], y[active] = level.up[x[active]], level.up[y[active]]
    down = np.zeros(0, dtype=np.int64)
    for h in range(len(levels) - 1, -1, -1):
        down = np.concatenate([down, *differ[h]])
        if h == 0 or not len(down):
            continue
        below = levels[h - 1]
        p, q = x[down], y[down]
        size = np.minimum(below.first[p + 1] - below.first[p], below.first[q + 1] - below.first[q])
        p, q = (below.first[p], below.first[q]) if step > 0 else (below.first[p + 1] - 1, below.first[q + 1] - 1)
        same = below.symbols[p] == below.symbols[q]
        move = np.where(same, size if below.blocks else 1, 0) * step
        x[down], y[down] = p + move, q + move
    return (x - a) * step


def grid(symbols: np.ndarray, start: np.ndarray, size: np.ndarray, least: int, periods: range) -> Iterator[tuple[int, np.ndarray]]:
    """Places on the grid of each period from which ``STEPS`` steps find equal symbols in one text.

    Texts stand one after the other in falling order of their ``size``, so that each period looks only at
    texts that are long enough.
    """
    owner = np.repeat(np.arange(len(size)), size)
    for p in periods:
        texts = np.searchsorted(-size, -max(least, (STEPS + 1) * p), side="right")
        if not texts:
            return
        stop = start[texts - 1] + size[texts - 1]
        row = symbols[:stop:p]
        same = row[1:] == row[:-1]
        at = np.flatnonzero(same[2:] & same[1:-1] & same[:-2]) * p
        if len(at):
            at = at[owner[at] == owner[at + STEPS * p]]
            if len(at):
                yield p, at


def runs_of(texts: list[np.ndarray], least: int) -> list[np.ndarray]:
    """``start, length, period`` of the runs of each sequence of symbols, by start and period."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    out = [np.zeros((0, 3), dtype=np.int64) for _ in texts]
    size = np.array([len(texts[k]) for k in order], dtype=np.int64)
    start = np.cumsum(size) - size
    flat = np.concatenate([texts[k] for k in order]) if order else np.zeros(0, dtype=np.int64)
    if not len(flat):
        return out
    owner = np.repeat(np.arange(len(size)), size)
    levels = None
    found = np.zeros((0, 3), dtype=np.int64)  # start, end, period
    cover = np.full(len(flat), -1, dtype=np.int64)
    low = 1
    while low <= size[0] // (STEPS + 1):
        hits = list(grid(flat, start, size, least, range(low, 2 * low)))
        low *= 2
        if not hits:
            continue
        if levels is None:
            # A separator before each text and one behind the last.
            lone = np.insert(flat, start, -2 - np.arange(len(size)))
            levels = recompressed(np.append(lone, -1))
        period = np.repeat([p for p, _ in hits], [len(at) for _, at in hits])
        place = np.concatenate([at for _, at in hits])
        for k in range(0, len(place), CHUNK):
            i, p = place[k : k + CHUNK], period[k : k + CHUNK]
            # A run of a period that divides p reaches as far under p: nothing new is found in it.
            r = cover[i]
            known = np.zeros(len(i), dtype=bool)
            if len(found):
                known = (r >= 0) & (p % found[r, 2] == 0) & (i + STEPS * p < found[r, 1])
            i, p = i[~known], p[~known]
            if not len(i):
                continue
            a = i + owner[i] + 1
            right, left = extended(levels, a, a + p, 1), extended(levels, a, a + p, -1)
            got = np.stack([i - left + 1, i + p + right, p], axis=1)
            length = got[:, 1] - got[:, 0]
            got = np.unique(got[(length >= least) & (length >= (STEPS + 1) * p)], axis=0)
            # Of equal stretches the smallest period counts; the others are its multiples.
            got = got[np.unique(got[:, :2], axis=0, return_index=True)[1]]
            before = len(found)
            found = np.concatenate([found, got])
            for n in np.argsort(got[:, 1] - got[:, 0], kind="stable"):
                cover[got[n, 0] : got[n, 1]] = before + n
    if not len(found):
        return out
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    found = found[np.unique(found[:, :2], axis=0, return_index=True)[1]]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    texts_of = owner[found[:, 0]]
    for n in np.unique(texts_of):
        own = found[texts_of == n]
        out[order[n]] = np.stack([own[:, 0] - start[n], own[:, 1] - own[:, 0], own[:, 2]], axis=1)
    return out


def may_repeat(texts: list[np.ndarray], least: int) -> np.ndarray:
    """Which sequences have any candidate; the others, most texts, need no grammar."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    size = np.array([len(texts[k]) for k in order], dtype=np.int64)
    start = np.cumsum(size) - size
    flat = np.concatenate([texts[k] for k in order])
    hit = np.zeros(len(texts), dtype=bool)
    if len(flat):
        owner = np.repeat(order, size)
        for _, at in grid(flat, start, size, least, range(1, int(size[0]) // (STEPS + 1) + 1)):
            hit[owner[at]] = True
    return hit


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside the repetitions of ``runs``: of each run its first period stays."""
    if not len(runs):
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    keep = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
    return b" ".join([words[k] for k in keep.tolist()])


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 6) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    ``runs`` has ``start, length, period`` (in words, from 0) of every stretch of ``least`` words or more and
    of four times its smallest period or more that cannot be extended keeping that period, by start and
    period. ``collapsed`` is the text with single blanks, where of each run only the first period stays. A
    null, empty or blank text has no runs and the empty text; rows with one key, or none, are rows of
    their own; other columns are ignored. Narrow: nothing is shuffled, and a task holds the words of
    some megabytes of text, or of one longer text.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch, 1)
            runs: list[np.ndarray] = [None] * len(texts)
            order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
            at = 0
            for group in groups([texts[k] for k in order], 4 * PIECE):
                own = order[at : at + len(group)]
                at += len(group)
                hashed = [word_hashes(t, lower=False).view(np.int64) for t in group]
                some = np.flatnonzero(may_repeat(hashed, least))
                numbers: dict[bytes, int] = {}
                exact = [np.array([numbers.setdefault(w, len(numbers)) for w in group[k].split()], dtype=np.int64) for k in some]
                for k in own:
                    runs[k] = np.zeros((0, 3), dtype=np.int64)
                for k, found in zip(some, runs_of(exact, least)):
                    runs[own[k]] = found
            kept, counts = [], []
            for t, found in zip(texts, runs):
                words = t.split()
                counts.append(len(words))
                kept.append(collapsed(words, found))
            flat = np.concatenate(runs) if runs else np.zeros((0, 3), dtype=np.int64)
            fields = [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)]
            ends = np.cumsum([0, *(len(r) for r in runs)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUN}, collapsed string")


def most_periodic(runs: str = "runs") -> Column:
    """The run of greatest length by period; of equal ones the first."""

    def better(best: Column, run: Column) -> Column:
        # Compared crosswise, as whole numbers.
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def with_planted_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` where one row in ten, by the checksum of its key, ends in words that repeat with a period.

    With h the checksum of the decimal key and g = h div 10, the n words of a row with h mod 10 = 0 repeat
    from word a = g mod n on with the period 1 + (n - a) div (3 + g mod 8). Rows without a key stay.
    """
    hashed, words = fresh(docs, "hashed"), fresh(docs, "words")
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    cut = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The words are a column of their own, else every place of the new text would cut the old one again.
    some = docs.withColumn(hashed, h).withColumn(words, F.when(F.col(hashed) % 10 == 0, cut))
    n, g = F.size(words), F.floor(F.col(hashed) / 10)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    place = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
    places = fresh(some, "places")
    some = some.withColumn(places, F.when(n > 0, place))
    tail = F.array_join(F.transform(places, lambda i: F.get(words, i)), " ")
    return some.withColumn(text, F.when(n > 0, tail).otherwise(F.col(text))).select(*docs.columns)


def run_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 6) -> DataFrame:
    """Per row the number of runs, the most periodic run (nulls without one) and digests of all runs and of
    the collapsed text: ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256``."""
    found = periodic_runs(docs, doc_id, text, least).withColumn("best", most_periodic())
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
