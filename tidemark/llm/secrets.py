"""Secrets in texts: three fixed patterns, and formats learnt from what the patterns find.

The strings that the patterns find are labelled credentials. For each kind a prefix tree of its strings
is reduced to a probabilistic automaton by merging states whose outgoing frequencies agree within the
Hoeffding bound; one more automaton is learnt from other tokens that are no likely credentials.
Every token of every text that is as long as the shortest labelled string may be, and what base spans
leave of a token, is then scored by how much likelier it is as a credential than as an ordinary token;
that alone decides, however many tokens are credentials.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import frugal, utf8

# The three kinds in their order, and what a match must have.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Tokens that are scored: from the least length of a labelled string on.
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_.=-]{%d,}" % ASSIGN_MIN)
#: Ordinary tokens below and from ``LONG_MIN`` characters on; long ones are rare and sampled by themselves.
ORDINARY, LONG = "ordinary", "long"
LONG_MIN = 16
LABELS = (*KINDS, ORDINARY, LONG)
#: Strings per label from which the automata are learnt: those with the least digests.
SAMPLE = 2_000
#: Tokens whose gain a task remembers.
REMEMBERED = 100_000
#: Characters of a labelled string that enter its prefix tree. Scores take whole tokens.
TREE_DEPTH = 128
ALPHA = 0.01
#: A token is a secret if it is a million times likelier (as a logarithm) than as an ordinary token.
LEAST_GAIN = 14.0
#: What a token in capitals loses (as a logarithm) where it is taken for an ordinary one in small letters.
CAPITALS = 7.0
#: Tokens that ordinary ones are learnt from first: each part between marks is of letters or of digits alone.
PLAIN = re.compile(rb"[+/_.=-]*(?:(?:[A-Za-z]+|[0-9]+)(?:[+/_.=-]+|$))*")

_HEX_RUN = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
#: Symbols of the automata: a-f, g-z, A-Z and 0-9 as one each, every other character as itself.
_CLASS = bytes(
    97 if 97 <= b <= 102 else 103 if 103 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)
)
#: Characters that a symbol stands for; within a class all are equally likely.
WIDTH = {97: 6, 103: 20, 65: 26, 48: 10}


def base_spans(text: bytes) -> list[tuple[int, int, int, int, int]]:
    """``start, kind, end, from, to`` in bytes of every match; ``from`` and ``to`` are the secret itself."""
    found = []
    folded = text.lower()
    if any(k in folded for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_MIN:
                found.append((m.start(), 0, m.end(), *m.span(2)))
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    if b"x" * HEX_MIN in text.translate(_HEX_RUN):
        found += [(m.start(), 2, m.end(), *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_MIN]
    return sorted(found)


def other_tokens(text: bytes, spans: list[tuple]) -> Iterator[tuple[int, int]]:
    """The candidates of ``text``, less what spans cover of them; parts that are left too short are none."""
    edges = sorted((s[0], s[2]) for s in spans)
    at, covered = 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        start = max(start, covered)
        while at < len(edges) and edges[at][0] < end:
            if edges[at][0] - start >= ASSIGN_MIN:
                yield start, edges[at][0]
            covered = max(covered, edges[at][1])
            start = max(start, covered)
            at += 1
        if end - start >= ASSIGN_MIN:
            yield start, end


class Automaton:
    """A probabilistic automaton over classes of characters, learnt by state merging."""

    def __init__(self, strings: Counter[bytes], alpha: float = ALPHA):
        self.next: list[dict[int, int]] = [{}]
        self.count: list[dict[int, int]] = [{}]
        self.ends = [0]
        for string, times in strings.items():
            state = 0
            for symbol in string[:TREE_DEPTH].translate(_CLASS):
                self.count[state][symbol] = self.count[state].get(symbol, 0) + times
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                    self.ends.append(0)
                state = self.next[state][symbol]
            self.ends[state] += times
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._reduce()
        self._weigh()

    def _total(self, state: int) -> int:
        return self.ends[state] + sum(self.count[state].values())

    def _alike(self, a: int, b: int) -> bool:
        """Whether the frequencies of both states, and of all that follows both, agree."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self._total(a), self._total(b)
            if not n or not m:
                continue
            most = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > most:
                return False
            for symbol in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a].get(symbol, 0) / n - self.count[b].get(symbol, 0) / m) > most:
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    todo.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Adds the counts of a subtree of the prefix tree to the states that read the same strings."""
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            for symbol, times in self.count[b].items():
                self.count[a][symbol] = self.count[a].get(symbol, 0) + times
                if symbol in self.next[a]:
                    todo.append((self.next[a][symbol], self.next[b][symbol]))
                else:
                    self.next[a][symbol] = self.next[b][symbol]

    def _reduce(self) -> None:
        """Settled states grow from the root; each state behind them is merged into one or becomes one."""
        settled = [0]
        while True:
            known = set(settled)
            edge = [(a, s, t) for a in settled for s, t in sorted(self.next[a].items()) if t not in known]
            if not edge:
                return
            a, symbol, tree = max(edge, key=lambda e: (self._total(e[2]), -e[2]))
            twin = next((r for r in settled if self._alike(r, tree)), None)
            if twin is None:
                settled.append(tree)
            else:
                self.next[a][symbol] = twin
                self._fold(twin, tree)

    def _weigh(self) -> None:
        """Logarithms of the chances with one added to each; an unseen symbol leads to the root."""
        reached, todo = {0: 0}, [0]
        while todo:
            for t in self.next[todo.pop()].values():
                if t not in reached:
                    reached[t] = len(reached)
                    todo.append(t)
        self.steps: list[dict[int, tuple[float, int]]] = []
        self.stop: list[float] = []
        self.unseen: list[float] = []
        for state in reached:
            n = self._total(state) + 32
            width = {s: WIDTH.get(s, 1) for s in self.count[state]}
            self.steps.append({s: (math.log((c + 1) / n / width[s]), reached[self.next[state][s]]) for s, c in self.count[state].items()})
            self.stop.append(math.log((self.ends[state] + 1) / n))
            self.unseen.append(math.log(1 / n / 8))

    def score(self, symbols: bytes) -> float:
        """The logarithm of the likelihood of a string given as symbols."""
        state, total, steps, unseen = 0, 0.0, self.steps, self.unseen
        for symbol in symbols:
            step = steps[state].get(symbol)
            if step is None:
                total, state = total + unseen[state], 0
            else:
                total, state = total + step[0], step[1]
        return total + self.stop[state]


class Formats:
    """The automata of all kinds and the gain from which a token counts as a secret.

    Unlabelled credentials are among the other tokens, and an automaton that learnt them would find them
    ordinary. So it is learnt from plain tokens first, then once more with those of the others that are
    no secrets by it.
    """

    def __init__(self, samples: dict[str, list[bytes]]):
        self.kinds = [(k, Automaton(Counter(samples[name]))) for k, name in enumerate(KINDS) if samples.get(name)]
        self.threshold = LEAST_GAIN
        self.known: dict[bytes, tuple[float, int]] = {}
        ordinary = samples.get(ORDINARY, []) + samples.get(LONG, [])
        plain = [t for t in ordinary if PLAIN.fullmatch(t)]
        self.ordinary = Automaton(Counter(plain))
        mixed = [t for t in ordinary if not PLAIN.fullmatch(t) and self._gain(t)[0] <= self.threshold]
        if mixed:
            self.ordinary = Automaton(Counter(plain + mixed))

    def gain(self, token: bytes) -> tuple[float, int]:
        """How much likelier as a credential, and as which kind. Short tokens recur, so theirs are remembered."""
        if len(token) > 2 * LONG_MIN:
            return self._gain(token)
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[token] = self._gain(token)
        return found

    def _gain(self, token: bytes) -> tuple[float, int]:
        symbols = token.translate(_CLASS)
        best = max(((a.score(symbols), -k) for k, a in self.kinds), default=(-math.inf, 0))
        ordinary = self.ordinary.score(symbols)
        if token.isupper():  # words in capitals are too rare to be learnt from
            ordinary = max(ordinary, self.ordinary.score(token.lower().translate(_CLASS)) - CAPITALS)
        return best[0] - ordinary, -best[1]


def labelled(docs: DataFrame, text: str, sample: int = SAMPLE) -> dict[str, list[bytes]]:
    """At most ``sample`` distinct strings per kind and of short and long ordinary tokens, those of least digest.

    Every text is searched. A task passes on its own least ``sample`` per label, so what is shuffled and
    collected is bounded by the parameter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict[int, bytes]] = [{} for _ in LABELS]
        limit = [1 << 64] * len(kept)

        def add(label: int, token: bytes) -> None:
            digest = int.from_bytes(hashlib.blake2b(token, digest_size=8).digest())
            if digest < limit[label]:
                kept[label][digest] = token
                if len(kept[label]) >= 2 * sample:
                    least = sorted(kept[label])[:sample]
                    kept[label] = {d: kept[label][d] for d in least}
                    limit[label] = least[-1]

        for batch in batches:
            for t in utf8(batch, 0):
                spans = base_spans(t)
                for _, kind, _, start, end in spans:
                    add(kind, t[start:end])
                for start, end in other_tokens(t, spans):
                    add(len(KINDS) + (end - start >= LONG_MIN), t[start:end])
        rows = [(label, d, k[d]) for label, k in enumerate(kept) for d in sorted(k)[:sample]]
        labels, digests, tokens = zip(*rows) if rows else ((), (), ())
        order = np.array(digests, dtype=np.uint64) >> np.uint64(1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.int32()), pa.array(order.astype(np.int64)), pa.array([t[:TREE_DEPTH] for t in tokens], pa.binary())],
            ["label", "digest", "token"],
        )

    rows = docs.select(text).mapInArrow(frugal(run), "label int, digest long, token binary").distinct()
    first = F.row_number().over(Window.partitionBy("label").orderBy("digest", "token"))
    out: dict[str, list[bytes]] = {}
    for row in rows.withColumn("k", first).filter(F.col("k") <= sample).collect():
        out.setdefault(LABELS[row["label"]], []).append(bytes(row["token"]))
    return {name: sorted(tokens) for name, tokens in out.items()}


def all_spans(text: bytes, formats: Formats) -> tuple[list[tuple], list[tuple[int, int, int]]]:
    """Base spans, and all spans as ``start, kind, end``, both in bytes and in order."""
    base = base_spans(text)
    spans = [s[:3] for s in base]
    for start, end in other_tokens(text, base):
        gain, kind = formats.gain(text[start:end])
        if gain > formats.threshold:
            spans.append((start, kind, end))
    return base, sorted(spans)


def described(text: bytes, spans: list[tuple]) -> str:
    """``kind:start:end`` of each span in code points, comma-joined."""
    points, at, seen = {}, 0, 0
    for edge in sorted({e for s in spans for e in (s[0], s[2])}):
        seen += len(text[at:edge].decode("utf-8", "replace"))
        at, points[edge] = edge, seen
    return ",".join(f"{KINDS[s[1]]}:{points[s[0]]}:{points[s[2]]}" for s in spans)


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex`` (base matches), ``base_sha256``,
    ``spans`` (base and learnt, ``kind:start:end`` in code points) and ``n_learnt``.

    Null and empty texts have no spans; repeated rows and null keys are answered like any other; other
    columns are ignored. Without labelled strings nothing is learnt and the base spans remain. Two narrow
    passes over the texts; between them the bounded sample is collected and the automata are sent along.
    """
    formats = Formats(labelled(docs, text, sample))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in utf8(batch, 1):
                base, spans = all_spans(t, formats)
                kinds = Counter(s[1] for s in base)
                digest = hashlib.sha256(described(t, base).encode()).hexdigest()
                rows.append((kinds[0], kinds[1], kinds[2], digest, described(t, spans), len(spans) - len(base)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_learnt"],
            )

    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learnt long"
    return docs.select(doc_id, text).mapInArrow(frugal(run), schema)


def mask_secrets(docs: DataFrame, text: str = "text", mask: str = "<secret>", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mask``; overlapping spans become one. All columns stay."""
    formats = Formats(labelled(docs, text, sample))
    put = mask.encode()

    def masked(t: bytes) -> bytes:
        parts, at = [], 0
        for start, _, end in all_spans(t, formats)[1]:
            if start >= at:
                parts += [t[at:start], put]
            at = max(at, end)
        return b"".join(parts) + t[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.schema.get_field_index(text)
            given = batch.column(column)
            new = [None if old is None else masked(old) for old in given.cast(pa.large_binary()).to_pylist()]
            yield batch.set_column(column, batch.schema.field(column), pa.array(new, pa.large_binary()).cast(given.type))

    return docs.mapInArrow(frugal(run), docs.schema)
