"""Toxicity by compression: windows that a toxic dictionary shortens more than an ordinary one does.

Both zstandard dictionaries are trained on labelled documents. The ordinary one comes from windows of
ordinary text. The toxic one is trained on the words of toxic text in which short strings recur that
ordinary text lacks, and holds the ordinary one as well, so what both classes share costs the same under
both. A window's gain is the difference of its two lengths. Where toxic words are made of the stems of
ordinary ones, parts of words compress alike; so each window is also compressed as the codes of its words,
of 16 bytes each, with a second pair of dictionaries, where only whole words match. The largest gains of a
document and their number are calibrated on labelled documents that trained no dictionary.

The labelled documents that teach are bounded by their number; each teaches by its whole text. Their
texts stay in tasks: marks of near copies, typical strings, words, windows and features are collected.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import fresh, frugal, mixed, utf8, word_hashes
from tidemark.llm.tables import stored

#: Labelled documents of each class that are learnt from: those of least hash among the permitted ones.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 1_500, 4_500
#: Windows of ordinary text that its dictionary is trained on: those of least hash.
ORDINARY_WINDOWS = 20_000
#: Words of a window.
WINDOW = 8
ORDINARY_SIZE, TOXIC_SIZE = 16_384, 4_096
LEVEL = 3
#: A string of ``GRAM`` bytes, or a word, is toxic if it is in so many toxic documents and so many times likelier there.
GRAM, LEAST_DOCS, LEAST_WORD_DOCS, LIFT = 5, 5, 3, 20
#: The bit that tells codes of words from strings of ``GRAM`` bytes, and the bytes that a code is written as.
IS_CODE, CODE = np.uint64(1 << 8 * GRAM), 16
#: Marks by which near copies are known, and least hashes in each.
BANDS, BAND = 10, 6
LIMIT = 0.7
#: Window gains that are counted: of text, of codes.
STEPS, CODE_STEPS = (4, 6), (4, 8)
#: A task counts so many strings before it passes them on.
MEMORY = 1_000_000


def windows(text: bytes) -> Iterator[bytes]:
    """The words of ``text`` in lower case, ``WINDOW`` at a time; a text without words is one empty window."""
    words = text.lower().split()
    for i in range(0, max(1, len(words)), WINDOW):
        yield b" " + b" ".join(words[i : i + WINDOW]) + b" "


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    # Tables as for a larger source, so that one part of the dictionary does not push out the other.
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, hash_log=17, chain_log=17, window_log=17, write_checksum=False, write_content_size=False, write_dict_id=False
    )
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=words, compression_params=settings)


def trained(size: int, samples: Counter[bytes]) -> bytes:
    """What dictionary training selects from ``samples``, after the most frequent of them as far as room is left.

    Training keeps little of few or short samples; what stands last in a dictionary is found at least cost.
    """
    ordered = sorted(samples.items(), key=lambda s: (-s[1], s[0]))
    try:
        chosen = zstandard.train_dictionary(size, [s for s, times in ordered for _ in range(times)]).as_bytes()
    except zstandard.ZstdError:
        chosen = b""
    return (b"".join(s for s, _ in reversed(ordered[:size])) + chosen)[-size:]


def copy_marks(text: bytes) -> list[int]:
    """Marks of the long words of ``text``, each from ``BAND`` of their least hashes. Texts that share a mark are
    near copies: with four in five of their long words in common 95 in 100 share one, with one in five hardly any."""
    words = np.unique(word_hashes(b" ".join(w for w in text.split() if len(w) > 7)))
    if not len(words):
        return []
    least = [int(mixed(words + np.uint64(k + 1)).min()) for k in range(BANDS * BAND)]
    return [hash((b, *least[b * BAND : (b + 1) * BAND])) for b in range(BANDS)]


def distinct(marked: list[tuple]) -> list:
    """The keys of ``(key, marks)`` without those of near copies: copies would make their own words look typical."""
    seen: set[int] = set()
    kept = []
    for key, marks in marked:
        if seen.isdisjoint(marks):
            kept.append(key)
        seen.update(marks)
    return kept


def grams(text: bytes) -> np.ndarray:
    """The distinct strings of ``GRAM`` bytes, as integers."""
    data = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", dtype=np.uint8).astype(np.uint64)
    n = max(0, len(data) - GRAM + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        out = out * np.uint64(256) + data[k : n + k]
    return np.unique(out)


def codes(text: bytes) -> np.ndarray:
    """The codes of all words of ``text``, in order."""
    return mixed(word_hashes(text)) | IS_CODE


def written(words: np.ndarray) -> bytes:
    """Codes as bytes. One that a dictionary holds saves far more than the match costs."""
    return np.stack([words, mixed(words + np.uint64(1))], axis=1).tobytes()


def string_counts(lessons: DataFrame) -> DataFrame:
    """``s, ordinary, toxic``: in how many texts of either class of ``lessons`` (``toxic, text``) each string of
    ``GRAM`` bytes is, and each word as its code; ``is_code`` tells which."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, int]] = []

        def counted() -> pa.RecordBatch:
            sides = [np.unique(np.concatenate([np.zeros(0, np.uint64), *(x for x, t in held if t == c)]), return_counts=True) for c in (0, 1)]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([x.view(np.int64) for x, _ in sides])),
                    pa.array(np.concatenate([sides[0][1], 0 * sides[1][1]])),
                    pa.array(np.concatenate([0 * sides[0][1], sides[1][1]])),
                ],
                ["s", "ordinary", "toxic"],
            )

        size = 0
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), utf8(batch, 1)):
                held.append((np.concatenate([grams(text), np.unique(codes(text))]), toxic))
                size += len(held[-1][0])
                if size > MEMORY:
                    yield counted()
                    size = 0
        yield counted()

    counts = lessons.select("toxic", "text").mapInArrow(frugal(run), "s long, ordinary long, toxic long")
    counts = counts.groupBy("s").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    return counts.withColumn("is_code", F.col("s").bitwiseAND(int(IS_CODE)) != 0)


def typical(counts: DataFrame, n_ordinary: int, n_toxic: int) -> DataFrame:
    """The rows of ``string_counts`` that are typical of toxic texts."""
    lift = F.col("toxic") / n_toxic / ((F.col("ordinary") + 0.5) / n_ordinary)
    least = F.when(F.col("is_code"), LEAST_WORD_DOCS).otherwise(LEAST_DOCS)
    return counts.filter((F.col("toxic") >= least) & (lift >= LIFT))


def frequent_codes(counts: DataFrame, side: str, size: int) -> bytes:
    """The codes of the words in most texts of one side, the commonest last, up to ``size`` bytes."""
    rows = counts.filter(F.col("is_code") & (F.col(side) > 0)).orderBy(F.desc(side), "s").limit(size // CODE).collect()
    return written(np.array([r["s"] for r in reversed(rows)], dtype=np.int64).view(np.uint64))


def toxic_words(lessons: DataFrame, known: frozenset[int]) -> Counter[bytes]:
    """The words of the toxic ones of ``lessons`` that hold one of the strings ``known``, in how many texts. No
    more than the dictionary has bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in utf8(batch, 0):
                for word in set(text.lower().split()):
                    padded = b" " + word + b" "
                    if any(int.from_bytes(padded[i : i + GRAM]) in known for i in range(len(padded) - GRAM + 1)):
                        found[padded] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    words = lessons.filter("toxic = 1").select("text").mapInArrow(frugal(run), "word binary, n long")
    words = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(TOXIC_SIZE)
    return Counter({bytes(r["word"]): r["n"] for r in words.collect()})


def ordinary_windows(lessons: DataFrame) -> Counter[bytes]:
    """``ORDINARY_WINDOWS`` windows of the ordinary ones of ``lessons``, those of least hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[tuple[int, bytes]] = []
        for batch in batches:
            for text in utf8(batch, 0):
                for window in windows(text):
                    key = -int(mixed(word_hashes(window).sum(dtype=np.uint64, keepdims=True))[0] >> np.uint64(1))
                    if len(least) < ORDINARY_WINDOWS:
                        heapq.heappush(least, (key, window))
                    elif key > least[0][0]:
                        heapq.heapreplace(least, (key, window))
        keys, found = zip(*least) if least else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array([-k for k in keys], pa.int64()), pa.array(found, pa.binary())], ["h", "window"])

    rows = lessons.filter("toxic = 0").select("text").mapInArrow(frugal(run), "h long, window binary")
    return Counter(bytes(r["window"]) for r in rows.orderBy("h", "window").limit(ORDINARY_WINDOWS).collect())


def falling_gains(ordinary: Callable[[bytes], bytes], toxic: Callable[[bytes], bytes], parts: Iterable[bytes]) -> np.ndarray:
    """How much shorter each part is by the toxic compressor, the largest gain first."""
    return np.sort(np.array([len(ordinary(w)) - len(toxic(w)) for w in parts], dtype=float))[::-1]


def highest(gains: np.ndarray) -> np.ndarray:
    return np.pad(gains[:3], (0, max(0, 3 - len(gains))))


class Model:
    """Two pairs of dictionaries and a calibration; picklable, made anew into compressors where it is used."""

    def __init__(self, share: float):
        """``share``: the part of toxic documents among the labelled ones, and the score until the model is calibrated."""
        self.share, self.weights = share, None

    def train(self, ordinary: Counter[bytes], toxic: Counter[bytes], ordinary_codes: bytes, toxic_codes: bytes) -> None:
        self.ordinary = trained(ORDINARY_SIZE, ordinary)
        self.toxic = self.ordinary + trained(TOXIC_SIZE, toxic)
        self.ordinary_codes, self.toxic_codes = ordinary_codes, ordinary_codes + toxic_codes
        self.toxic_words = np.sort(np.frombuffer(toxic_codes, dtype=np.uint64)[:: CODE // 8])

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Both classes count as much as they have labels, however many were sampled."""
        prior = min(max(self.share, 1e-3), 1 - 1e-3)
        self._calibrate(x, y, np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean())))

    def open(self) -> None:
        if hasattr(self, "toxic"):
            self.by_text = compressor(self.ordinary).compress, compressor(self.toxic).compress
            self.by_codes = compressor(self.ordinary_codes).compress, compressor(self.toxic_codes).compress

    def features(self, text: bytes) -> list[float]:
        gains = falling_gains(*self.by_text, windows(text))
        size, first = np.log(len(gains)), highest(gains)
        out = [*first, *[float((gains >= s).sum()) for s in STEPS], size, float(gains.mean()), first[0] * size, first[1] * size]
        words = codes(text)
        # A window without any code of the toxic dictionary costs the same under both.
        at = np.minimum(np.searchsorted(self.toxic_words, words), len(self.toxic_words) - 1)
        differ = np.unique(np.flatnonzero(self.toxic_words[at] == words) // WINDOW) if len(self.toxic_words) else []
        gains = np.zeros(max(1, -(-len(words) // WINDOW)))
        gains[: len(differ)] = falling_gains(*self.by_codes, (written(words[k * WINDOW : (k + 1) * WINDOW]) for k in differ))
        gains = np.sort(gains)[::-1]
        out += [*highest(gains), *[float((gains >= s).sum()) for s in CODE_STEPS]]
        return [*out, float(np.maximum(gains, 0).sum()), float(gains.mean())]

    def _calibrate(self, x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> None:
        """Logistic regression by Newton's method."""
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-9
        z = self._design(x)
        w, ridge = np.zeros(z.shape[1]), 1e-2 * np.eye(z.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (importance * (p - y)) + 1e-2 * w
            bend = (z * (importance * p * (1 - p))[:, None]).T @ z + ridge
            w = w - np.linalg.solve(bend, slope)
        self.weights = w

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), (x - self.mean) / self.spread])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None or not texts:
            return np.full(len(texts), self.share)
        z = self._design(np.array([self.features(t) for t in texts]))
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))


def fitted(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> Model:
    """The model from the labelled documents whose crc32 of the key modulo 3 is not 1.

    The keys of the sample are chosen from the labels alone, ``TOXIC_SAMPLE`` and ``ORDINARY_SAMPLE`` of
    them; then their whole texts are stored, one a key (the least where a key has several). Two in three
    documents of each class that are no near copies train the dictionaries, the others calibrate.
    """
    known = labels.select(F.col(doc_id).alias("key"), F.col(label).cast("int").alias("toxic")).filter("toxic in (0, 1)")
    known = known.filter(~held_out("key")).groupBy("key").agg(F.max("toxic").alias("toxic"))
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    model = Model(counts["toxic"] / counts["n"] if counts["n"] else 0.0)
    order = [F.xxhash64("key"), F.col("key")]
    toxic = known.filter("toxic = 1").orderBy(*order).limit(TOXIC_SAMPLE)
    chosen = toxic.unionByName(known.filter("toxic = 0").orderBy(*order).limit(ORDINARY_SAMPLE))
    chosen = stored(chosen.select("key", "toxic"), "labelled")
    texts = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text")).filter(F.length("text") > 0).join(chosen, "key")
    lessons = stored(texts.groupBy("key", "toxic").agg(F.min("text").alias("text")), "lessons")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = pa.array([copy_marks(t) for t in utf8(batch, 2)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), marks], ["key", "toxic", "marks"])

    kind = lessons.schema["key"].dataType.simpleString()
    rows = lessons.select("key", "toxic", "text").mapInArrow(frugal(marked), f"key {kind}, toxic int, marks array<long>")
    rows = rows.withColumn("h", F.xxhash64(F.lit(1), "key")).collect()
    rows.sort(key=lambda r: (r["h"], str(r["key"])))
    roles = []
    for c in (0, 1):
        keys = distinct([(r["key"], r["marks"]) for r in rows if r["toxic"] == c])
        cut = 2 * len(keys) // 3
        if not cut or cut == len(keys):
            return model  # too few labels of a class: every score is the share
        roles += [(k, n >= cut) for n, k in enumerate(keys)]
    lessons = stored(lessons.join(docs.sparkSession.createDataFrame(roles, f"key {kind}, calibrates boolean"), "key"), "roles")
    taught = lessons.filter("not calibrates")
    counts = stored(string_counts(taught), "strings")
    sizes = {r["toxic"]: r["count"] for r in taught.groupBy("toxic").count().collect()}
    found = stored(typical(counts, sizes[0], sizes[1]), "typical")
    known = frozenset(found.filter("not is_code").select("s").toArrow().column(0).to_pylist())
    model.train(
        ordinary_windows(taught),
        toxic_words(taught, known),
        frequent_codes(counts, "ordinary", ORDINARY_SIZE),
        frequent_codes(found, "toxic", TOXIC_SIZE),
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.open()
        for batch in batches:
            x = pa.array([model.features(t) for t in utf8(batch, 2)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), x], ["key", "toxic", "x"])

    measured = lessons.filter("calibrates").select("key", "toxic", "text").mapInArrow(frugal(features), f"key {kind}, toxic int, x array<double>")
    measured = sorted(measured.collect(), key=lambda r: str(r["key"]))
    model.calibrate(np.array([r["x"] for r in measured]), np.array([r["toxic"] for r in measured], dtype=float))
    return model


def held_out(doc_id: str):
    """Rows that nothing is learnt from."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "utf-8")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score`` (0 to 1) and ``predicted`` (1 from ``LIMIT`` on).

    Every window of every whole text is compressed; null and empty texts count as one empty window.
    Repeated rows and null keys are scored like any other, a null key is not held out; other columns
    are no input. If a class has no labels, every score is the share of toxic labels. Narrow: the model
    (about 80 kB) goes to the tasks.
    """
    model = fitted(docs, labels, doc_id, text, label)
    kind, flag = docs.schema[doc_id].dataType.simpleString(), fresh(docs, "held_out")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.open()
        for batch in batches:
            score = model.scores(utf8(batch, 1))
            columns = [batch.column(0), batch.column(2), pa.array(score, pa.float64()), pa.array((score >= LIMIT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.withColumn(flag, held_out(doc_id)).select(doc_id, text, flag)
    return rows.mapInArrow(frugal(run), f"doc_id {kind}, held_out boolean, score double, predicted int")
