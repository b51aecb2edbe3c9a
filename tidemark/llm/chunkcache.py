"""What a tokenizer makes of blank-separated chunks, remembered between the rows of a Python worker.

No token of the tokenizer reaches over a blank, and most chunks come again and again, so a text is encoded
as the ids of its chunks. The memory holds two generations of at most ``capacity`` chunks each; what was
not asked for during a whole generation is forgotten, so a worker's memory is bounded for any corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Generic, TypeVar

import numpy as np

from tidemark.llm.texts import word_spans

Encoded = TypeVar("Encoded")


class ChunkCache(Generic[Encoded]):
    def __init__(self, encode: Callable[[list[bytes]], Iterable[Encoded]], capacity: int = 150_000):
        self.encode, self.capacity = encode, capacity
        self.young: dict[bytes, Encoded] = {}
        self.old: dict[bytes, Encoded] = {}

    def clear(self) -> None:
        """For the end of a task: a worker that goes on to other work holds nothing."""
        self.young, self.old = {}, {}

    def of(self, cut: list[list[bytes]]) -> list[list[Encoded]]:
        """What each chunk of each list becomes. Chunks that are new are encoded together."""
        get = self.young.get
        out = [list(map(get, chunks)) for chunks in cut]
        open_ = [k for k, found in enumerate(out) if None in found]
        if open_:
            if len(self.young) > self.capacity:
                self.old, self.young = self.young, {}
            absent = {c for k in open_ for c, v in zip(cut[k], out[k]) if v is None}
            known = absent & self.old.keys()
            new = list(absent - known)
            self.young.update([(c, self.old[c]) for c in known])
            self.young.update(zip(new, self.encode(new), strict=True))
            fetch = self.young
            for k in open_:
                out[k] = [fetch[c] if v is None else v for c, v in zip(cut[k], out[k])]
        return out

    def ids_of(self, texts: list[bytes]) -> list[np.ndarray]:
        """The 16-bit ids of each text, for chunks that become bytes of such ids.

        The chunks of all texts are told apart by hash and length, so each different one is looked up once
        and the ids are put together as arrays.
        """
        hashes, start, end = word_spans(b"\n".join(texts), lower=False)
        _, first, back = np.unique(hashes + (end - start).astype(np.uint64), return_index=True, return_inverse=True)
        joined = b"\n".join(texts)
        found = self.of([[joined[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]])[0]
        ids = np.frombuffer(b"".join(found), dtype="<u2")
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 2
        each = size[back]
        ends = np.cumsum(each)
        at = np.repeat((np.cumsum(size) - size)[back] - (ends - each), each)
        at += np.arange(len(at))
        flat = ids[at]
        # Where each text ends, in chunks and then in ids.
        border = np.cumsum([len(t) + 1 for t in texts])
        cut = np.concatenate([[0], ends])[np.searchsorted(start, border)]
        return np.split(flat, cut[:-1])
