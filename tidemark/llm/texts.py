"""Texts inside Arrow batches: UTF-8 bytes, bounded pieces, words and 64-bit hashes of runs of words.

A word is a run of bytes other than the ASCII blanks ``\\x20 \\x09-\\x0D``, which is what ``bytes.split``
cuts at. Blanks are single bytes in UTF-8, so bytes and code points give the same words.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

BLANKS = b" \t\n\x0b\x0c\r"
#: Bytes of text that are cut into words at one time.
PIECE = 1 << 20

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


Batches = Iterator[pa.RecordBatch]


@functools.cache
def _trim() -> Callable[[int], int] | None:
    """The C library's call that hands unused memory back, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return None


def give_back() -> None:
    """Unused memory back to the system. Workers are kept for later tasks, of this and of other steps, beside
    the heap of their executor; without this each keeps the most that any of its tasks needed."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def frugal(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, memory given back when its task ends."""

    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def utf8(batch: pa.RecordBatch, column: str | int) -> list[bytes]:
    """The texts of a batch as UTF-8, null as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.large_binary()).to_pylist()]


def folded(text: bytes) -> bytes:
    """A-Z as a-z, for tokenizers of lower case, so that fewer chunks differ. A text that may hold special
    tokens, which are told by case, stays as it is."""
    return text if b"<|" in text else text.lower()


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes, cut behind a blank, so that no word is cut."""
    start = 0
    while len(text) - start > size:
        end = start + size
        while end < len(text) and text[end - 1] not in BLANKS:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def groups(texts: list[bytes], size: int = 4 * PIECE) -> Iterator[list[bytes]]:
    """Consecutive texts, together up to ``size`` bytes; a longer text stands alone."""
    group, total = [], 0
    for t in texts:
        if group and total + len(t) > size:
            yield group
            group, total = [], 0
        group.append(t)
        total += len(t)
    if group:
        yield group


def parts(batch: pa.RecordBatch, column: str | int, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """Where ``groups`` of the texts of a batch begin, and their texts as UTF-8, null as empty. One group is taken
    out of the batch at a time, so the texts of a batch never stand beside it as Python objects all at once."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for k, length in enumerate(lengths.tolist()):
        if k > start and total + length > size:
            yield start, utf8(batch.slice(start, k - start), column)
            start, total = k, 0
        total += length
    if start < len(lengths):
        yield start, utf8(batch.slice(start), column)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
_LOWER = _BYTES[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]
_UP = np.ones(1, dtype=np.uint64)
_DOWN = np.ones(1, dtype=np.uint64)


def word_hashes(text: bytes, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of every word of ``text``, in order; ``lower`` takes A-Z as a-z."""
    return word_spans(text, lower)[0]


def word_spans(text: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word of ``text``. Works piece by piece, so memory follows the words."""
    parts, offset = [], 0
    for piece in pieces(text):
        hashes, start, end = _piece_spans(piece, lower)
        parts.append((hashes, start + offset, end + offset))
        offset += len(piece)
    return tuple(np.concatenate(p) for p in zip(*parts))


def _piece_spans(text: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    global _UP, _DOWN
    data = np.frombuffer(text, dtype=np.uint8)
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if len(_UP) <= n:
        _UP, _DOWN = _powers(MULTIPLIER, 2 * n + 1), _powers(INVERSE, 2 * n + 1)
    solid = np.ones(n + 2, dtype=np.int8)
    solid[0] = solid[-1] = 0
    solid[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    edge = np.diff(solid)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _BYTES)[data] * _UP[:n], out=total[1:])
    return mixed((total[end] - total[start]) * _DOWN[start] + (end - start).astype(np.uint64)), start, end


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words; of the whole sequence if there are fewer; none of none."""
    n = len(words)
    if n == 0:
        return words
    m = min(length, n)
    out = np.full(n - m + 1, np.uint64(m), dtype=np.uint64)
    for k in range(m):
        out = out * MULTIPLIER + words[k : n - m + 1 + k]
    return mixed(out)


def shingle_set(text: bytes, length: int = 5) -> np.ndarray:
    """The distinct runs of ``length`` words as sorted hashes."""
    return np.unique(run_hashes(word_hashes(text), length))
