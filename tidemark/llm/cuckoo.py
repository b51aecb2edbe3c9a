"""A cuckoo filter over 128-bit keys: approximate membership with deletion."""

from __future__ import annotations

import numpy as np

from tidemark.llm.texts import MULTIPLIER, mixed

SLOTS = 4
#: Fingerprints that may be moved to make room for one key.
KICKS = 500
#: Share of the slots up to which a filter takes keys.
FULL = 0.9


def halves(keys: list[bytes]) -> np.ndarray:
    """Keys of 16 bytes as two columns of 64-bit numbers."""
    return np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints. A key has two buckets, each of which follows from the other and the
    fingerprint, so a fingerprint can be moved without its key, and one copy of it can be taken out again."""

    def __init__(self, buckets: int, table: bytes | None = None) -> None:
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16) if table is None else np.frombuffer(table, dtype="<u2").reshape(buckets, SLOTS).copy()
        self.mask = np.uint64(buckets - 1)

    @classmethod
    def for_keys(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(2, int(np.ceil(np.log2(max(keys, 1) / (SLOTS * FULL))))))

    @property
    def items(self) -> int:
        return int(np.count_nonzero(self.table))

    def room(self) -> int:
        return max(0, int(self.table.size * FULL) - self.items)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mixed(mark.astype(np.uint64) * MULTIPLIER) & self.mask)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = np.maximum(keys[:, 0] >> np.uint64(48), np.uint64(1)).astype(np.uint16)
        first = keys[:, 1] & self.mask
        return mark, first, self._other(first, mark)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """True for every key that is in, and for few others."""
        mark, first, second = self._places(keys)
        return (self.table[first] == mark[:, None]).any(axis=1) | (self.table[second] == mark[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> np.ndarray:
        """Puts a fingerprint of every key in; tells which keys found no room."""
        mark, first, second = self._places(keys)
        left = np.arange(len(keys))
        for bucket in (first, second):  # most keys find a free slot at once
            left = left[~self._fill(mark[left], bucket[left])]
        return left[[not self._kick(int(mark[k]), int(second[k])) for k in left]] if len(left) else left

    def _fill(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        order = np.argsort(bucket, kind="stable")
        sorted_bucket = bucket[order]
        begins = np.flatnonzero(np.append(True, sorted_bucket[1:] != sorted_bucket[:-1])[: len(order)])
        rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
        taken = self.table[sorted_bucket] != 0
        fits = rank < SLOTS - taken.sum(axis=1)
        slots = np.argsort(taken, axis=1, kind="stable")  # free slots first
        at = np.flatnonzero(fits)
        self.table[sorted_bucket[at], slots[at, rank[at]]] = mark[order[at]]
        done = np.zeros(len(mark), dtype=bool)
        done[order[at]] = True
        return done

    def _kick(self, mark: int, bucket: int) -> bool:
        moved = []
        for turn in range(KICKS):
            row = self.table[bucket]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = mark
                return True
            slot = turn % SLOTS
            moved.append((bucket, slot, int(row[slot])))
            row[slot], mark = mark, int(row[slot])
            bucket = int(self._other(np.array([bucket], dtype=np.uint64), np.array([mark], dtype=np.uint16))[0])
        for bucket, slot, mark in reversed(moved):  # no room: everything back to where it was
            self.table[bucket, slot] = mark
        return False

    def delete(self, keys: np.ndarray) -> np.ndarray:
        """Takes one fingerprint of every key out; tells which keys had none."""
        mark, first, second = self._places(keys)
        missing = []
        for k, m in enumerate(mark):
            for bucket in (first[k], second[k]):
                at = np.flatnonzero(self.table[bucket] == m)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break
            else:
                missing.append(k)
        return np.array(missing, dtype=np.int64)


class Layers:
    """Filters of growing size for keys of unknown number: a full one is followed by one of twice the size."""

    def __init__(self, tables: list[bytes], expected: int) -> None:
        self.filters = [CuckooFilter(len(t) // (2 * SLOTS), t) for t in tables]
        self.expected = expected

    def contains(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), dtype=bool)
        for f in self.filters:
            found |= f.contains(keys)
        return found

    def insert(self, keys: np.ndarray) -> None:
        while len(keys):
            room = self.filters[-1].room() if self.filters else 0
            if not room:
                least = len(self.filters[-1].table) * 2 * SLOTS if self.filters else 0
                self.filters.append(CuckooFilter.for_keys(int(max(self.expected, len(keys), least * FULL))))
                room = self.filters[-1].room()
            refused = self.filters[-1].insert(keys[:room])
            if len(refused):  # too many alike for this layer: a larger one has other buckets
                self.filters.append(CuckooFilter(2 * len(self.filters[-1].table)))
            keys = np.concatenate([keys[:room][refused], keys[room:]])

    def delete(self, keys: np.ndarray) -> np.ndarray:
        """The largest filter is looked at first: whatever looks like a key there looks like it in a smaller
        one too, not the other way about, so no other key loses its last fingerprint."""
        for f in sorted(self.filters, key=lambda f: -len(f.table)):
            keys = keys[f.delete(keys)]
        return keys

    def tables(self) -> list[bytes]:
        return [f.table.astype("<u2").tobytes() for f in self.filters]
