"""Repeated passages by content-defined chunks.

A chunk ends where a gear hash of the last bytes has zeros in fixed places, so the cuts depend on the
content alone: inside a passage that two texts share they fall on the same bytes, whatever stands
before it. Chunks with one digest are equal; runs of repeated chunks are passages. The first occurrence
(least key, least place) stays, all others can be cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import MULTIPLIER, PIECE, fresh, mixed, utf8
from tidemark.llm.tables import stored

#: Bytes that decide about a cut, and the bits of their hash that must be zero: one place in 16. With sparser
#: cuts too little of some passages of just over 50 words is left between the chunks over their ends.
REACH = 16
ZEROS = np.uint32(0b1111 << 11)
#: Least and most bytes of a chunk.
LEAST, MOST = 8, 128
#: A run of repeated chunks is a passage from so many bytes on. A passage of 50 words has about 300, of
#: which the chunks that reach over its ends are lost.
PASSAGE = 96

_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER) >> np.uint64(32)).astype(np.uint32)


def possible_cuts(text: bytes) -> np.ndarray:
    """The ends of chunks before sizes are looked at. Long texts are hashed piece by piece."""
    data, found = np.frombuffer(text, dtype=np.uint8), []
    for start in range(0, len(data), PIECE):
        before = min(start, REACH - 1)
        h = _GEAR[data[start - before : start + PIECE]]
        step = 1
        while step < REACH:  # sums over 1, 2, 4 ... bytes, each older byte shifted once more
            older = h[:-step] << np.uint32(step)
            h[step:] += older
            step *= 2
        found.append(np.flatnonzero((h[before:] & ZEROS) == 0) + (start + 1))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def chunk_ends(text: bytes) -> list[int]:
    """The end of every chunk, the last one at the end of the text."""
    ends, last = [], 0
    for cut in [*possible_cuts(text).tolist(), len(text)]:
        while cut - last > MOST:
            last += MOST
            ends.append(last)
        if cut - last >= LEAST or (cut == len(text) and cut > last):
            ends.append(cut)
            last = cut
    return ends


def chunk_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``digest, doc_id, start, size`` of every chunk; places in bytes of the UTF-8 text. Narrow."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, starts, ends, counts = [], [], [], []
            for t in utf8(batch, 1):
                cut = chunk_ends(t)
                begin = [0, *cut[:-1]]
                digests += [xxhash.xxh3_64_intdigest(t[a:b]) for a, b in zip(begin, cut)]
                starts += begin[: len(cut)]
                ends += cut
                counts.append(len(cut))
            owner = np.repeat(np.arange(len(counts)), counts)
            start = np.array(starts, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(digests, dtype=np.uint64).view(np.int64)),
                    batch.column(0).take(pa.array(owner)),
                    pa.array(start),
                    pa.array((np.array(ends, dtype=np.int64) - start).astype(np.int32)),
                ],
                ["digest", "doc_id", "start", "size"],
            )

    return docs.select(doc_id, text).mapInArrow(run, f"digest long, doc_id {kind}, start long, size int")


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passage: int = PASSAGE) -> DataFrame:
    """``doc_id, start, end, cut`` of every passage that occurs twice or more, in one document or several.

    ``cut`` tells the parts of ``passage`` bytes or more that occur before (in a document of lesser key, or
    earlier in this one) from those that stay. Digests are counted before the shuffle; the chunks then meet the digests that
    occur twice in a join that adaptive execution can split at a digest with very many chunks; what a
    document has is put in order by itself. Null and empty texts have no chunks; rows with one key are
    one document; a null key is the least; other columns are ignored.
    """
    chunks = chunk_rows(docs, doc_id, text)
    # A null key must stay the least one, which an ordinary minimum would skip.
    often = chunks.groupBy(F.col("digest")).agg(
        F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("unnamed")
    ).filter("times > 1")
    met = chunks.join(often, "digest")
    own, same = Window.partitionBy("doc_id").orderBy("start"), Window.partitionBy("doc_id", "digest").orderBy("start")
    first = F.when(F.col("unnamed"), F.col("doc_id").isNull()).otherwise(F.col("doc_id").eqNullSafe(F.col("least")))
    marked = met.repartition("doc_id").distinct().withColumn("cut", ~(first & (F.row_number().over(same) == 1)))
    joined = F.lag(F.col("start") + F.col("size")).over(own).eqNullSafe(F.col("start"))
    run = F.sum(F.when(joined, 0).otherwise(1)).over(own)
    runs = marked.withColumn("run", run)
    # The parts of a passage: consecutive chunks with the same fate.
    turn = F.lag("cut").over(Window.partitionBy("doc_id", "run").orderBy("start")).eqNullSafe(F.col("cut"))
    parts = runs.withColumn("part", F.sum(F.when(turn, 0).otherwise(1)).over(Window.partitionBy("doc_id", "run").orderBy("start")))
    whole = F.sum("size").over(Window.partitionBy("doc_id", "run"))
    extent = (F.min("start").alias("start"), F.max("end").alias("end"), F.first("cut").alias("cut"))
    found = (
        parts.withColumn("whole", whole)
        .filter(F.col("whole") >= passage)
        .withColumn("end", F.col("start") + F.col("size"))
        .groupBy("doc_id", "run", "part")
        .agg(*extent)
        # What occurs before stays too if it is no passage by itself: a short common line beside a first occurrence.
        .withColumn("cut", F.col("cut") & (F.col("end") - F.col("start") >= passage))
    )
    return (
        found.withColumn("turn", turn)
        .withColumn("part", F.sum(F.when(F.col("turn"), 0).otherwise(1)).over(Window.partitionBy("doc_id", "run").orderBy("start")))
        .groupBy("doc_id", "run", "part")
        .agg(*extent)
        .select("doc_id", "start", "end", "cut")
    )


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passage: int = PASSAGE) -> DataFrame:
    """One row per document with repeated passages: ``doc_id, n_parts, repeated_bytes, cut_bytes, repeated, cut``.

    ``repeated`` lists all parts of passages and ``cut`` those that occur before, as ``start:end`` in
    bytes, comma-joined in order.
    """
    found = repeated_passages(docs, doc_id, text, passage)
    place = F.struct("start", "end")

    def listed(places):
        return F.array_join(F.transform(F.array_sort(places), lambda p: F.concat_ws(":", p["start"], p["end"])), ",")

    size = F.col("end") - F.col("start")
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.sum(size).alias("repeated_bytes"),
        F.sum(F.when(F.col("cut"), size).otherwise(0)).alias("cut_bytes"),
        listed(F.collect_list(place)).alias("repeated"),
        listed(F.collect_list(F.when(F.col("cut"), place))).alias("cut"),
    )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passage: int = PASSAGE) -> DataFrame:
    """``docs`` with the cut parts taken out of ``text``; all other columns stay."""
    columns, key, cut = docs.columns, fresh(docs, "key"), fresh(docs, "cut")
    found = substring_dedup(docs, doc_id, text, passage).filter("cut != ''")
    cuts = stored(found.select(F.col("doc_id").alias(key), F.col("cut").alias(cut)), "cuts")
    joined = docs.join(cuts, F.col(doc_id).eqNullSafe(F.col(key)), "left").select(*columns, cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            given = batch.column(at)
            texts = given.cast(pa.large_binary()).to_pylist()
            new = [t if t is None or not c else taken_out(t, c) for t, c in zip(texts, batch.column(len(columns)).to_pylist())]
            kept = batch.set_column(at, batch.schema.field(at), pa.array([None if t is None else t.decode("utf-8", "ignore") for t in new], given.type))
            yield kept.select(columns)

    return joined.mapInArrow(run, docs.schema)


def taken_out(text: bytes, cut: str) -> bytes:
    parts, at = [], 0
    for place in cut.split(","):
        start, end = map(int, place.split(":"))
        parts.append(text[at:start])
        at = end
    return b"".join(parts) + text[at:]
