"""Line dedup that takes documents in and out again.

A store holds which texts have which line (``postings``), an exact count of the texts of every line with
the least and greatest document (``counts``), and cuckoo filters of all counted lines, a few for each shard
of the lines. A batch of documents asks the filters first: lines that no filter knows are new and need no
look-up among the counts; the others, known lines and a few that only look like one, are looked up exactly.
Documents that leave take their counts with them, and a line that nobody holds any more leaves its filter,
which no Bloom filter could do. So the store after any insertions and deletions equals one made from what is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.cuckoo import Layers, halves
from tidemark.llm.tables import stored
from tidemark.llm.texts import BLANKS, utf8

#: Code points of a line that counts.
LEAST = 10
#: Distinct lines of a shard at first; later its filters grow in layers.
SHARD = 1 << 15

FILTERS = "shard int, layer int, table binary"


@dataclass(frozen=True)
class LineStore:
    """Stored tables; each change makes a new store and leaves the old one as it was."""

    postings: DataFrame  # key, doc_id, text_hash
    counts: DataFrame  # key, shard, texts, first, last
    filters: DataFrame  # shard, layer, table
    shards: int


def line_key(line: bytes) -> bytes | None:
    """A digest of the line without the blanks around it and with A-Z as a-z; none if it is too short."""
    line = line.strip(BLANKS).lower()
    if len(line) < LEAST or len(line) < 4 * LEAST and len(line.decode()) < LEAST:
        return None
    return xxhash.xxh3_128_digest(line)


def line_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, doc_id, text_hash`` of the distinct lines of every text of a document with a key. Narrow."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owner = [], []
            for k, t in enumerate(utf8(batch, 2)):
                own = {line_key(line) for line in t.split(b"\n")} - {None}
                keys += own
                owner += [k] * len(own)
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(0).take(at), batch.column(1).take(at)], ["key", "doc_id", "text_hash"])

    named = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id), F.xxhash64(text).alias("text_hash"), F.col(text))
    return named.mapInArrow(run, f"key binary, doc_id {kind}, text_hash long")


def _counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(F.count(F.lit(1)).alias("texts"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


def _layers(filters: pa.Table, expected: int) -> Layers:
    rows = sorted(filters.select(["layer", "table"]).to_pylist(), key=lambda r: r["layer"])
    return Layers([r["table"] for r in rows], expected)


def _asked(counts: DataFrame, filters: DataFrame) -> DataFrame:
    """``counts`` with ``known``, as the filters of a shard tell; the others are put in. Filters with what they
    then hold come as rows with a ``layer``. A shard has a row for each line, whoever holds it."""
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in counts.schema)}, known boolean, layer int, table binary"
    names = counts.columns

    def run(key: tuple, lines: pa.Table, tables: pa.Table) -> pa.Table:
        layers = _layers(tables, SHARD)
        keys = halves(lines.column("key").to_pylist())
        known = layers.contains(keys)
        layers.insert(keys[~known])
        after = layers.tables()
        n, m = len(lines), len(after)
        columns = {c: pa.chunked_array([*lines.column(c).chunks, pa.nulls(m, lines.column(c).type)]) for c in names if c != "shard"}
        columns["shard"] = pa.array([key[0].as_py()] * (n + m), pa.int32())
        columns["known"] = pa.array([*known.tolist(), *[None] * m], pa.bool_())
        columns["layer"] = pa.array([None] * n + list(range(m)), pa.int32())
        columns["table"] = pa.array([None] * n + after, pa.binary())
        return pa.table({c: columns[c] for c in [*names, "known", "layer", "table"]})

    return counts.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(run, schema)


def _changed(filters: DataFrame, keys: DataFrame, insert: bool) -> DataFrame:
    """``filters`` with ``keys`` (``shard, key``) put in or taken out."""

    def run(key: tuple, lines: pa.Table, tables: pa.Table) -> pa.Table:
        layers = _layers(tables, SHARD)
        if len(lines):
            own = halves(lines.column("key").to_pylist())
            if insert:
                layers.insert(own)
            elif len(layers.delete(own)):
                raise ValueError("a counted line is missing in its filter")
        after = layers.tables()
        return pa.table({"shard": pa.array([key[0].as_py()] * len(after), pa.int32()), "layer": pa.array(range(len(after)), pa.int32()), "table": pa.array(after, pa.binary())})

    return keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(run, FILTERS)


def new_store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineStore:
    """A store of the lines of ``docs``, its shards made for them."""
    postings = stored(line_keys(docs, doc_id, text).distinct(), "postings")
    counts = stored(_counted(postings), "line-counts")
    shards = max(1, -(-counts.count() // SHARD))
    none = docs.sparkSession.createDataFrame([], FILTERS)
    asked = stored(_asked(counts.withColumn("shard", _shard(shards)), none), "line-filters")
    return LineStore(postings, *_parted(asked), shards)


def _shard(shards: int):
    return F.pmod(F.hash("key"), F.lit(shards)).alias("shard")


def _parted(asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    lines = asked.filter("layer IS NULL").drop("known", "layer", "table")
    return lines, asked.filter("layer IS NOT NULL").select("shard", "layer", "table")


def insert(store: LineStore, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineStore:
    """``store`` with ``docs``. Texts that it holds already under the same key are not counted twice."""
    held = ["key", "doc_id", "text_hash"]
    new = stored(line_keys(docs, doc_id, text).distinct().join(store.postings, held, "left_anti").select(held), "postings")
    asked = stored(_asked(_counted(new).withColumn("shard", _shard(store.shards)), store.filters), "line-asked")
    filters = asked.filter("layer IS NOT NULL").select("shard", "layer", "table")
    lines = asked.filter("layer IS NULL").drop("layer", "table")
    known = lines.filter("known").drop("known")
    old = store.counts.select("key", *(F.col(c).alias(f"old_{c}") for c in ("texts", "first", "last")))
    met = stored(known.join(old, "key", "left"), "line-known")
    # A filter sometimes knows a line that nobody holds: it is new after all, and its fingerprint is put in.
    filters = stored(_changed(filters, met.filter("old_texts IS NULL").select("shard", "key"), True), "line-filters")
    columns = ["key", "shard", "texts", "first", "last"]
    merged = met.select(
        "key",
        "shard",
        (F.col("texts") + F.coalesce("old_texts", F.lit(0))).alias("texts"),
        F.least("first", "old_first").alias("first"),
        F.greatest("last", "old_last").alias("last"),
    )
    untouched = store.counts.join(known.select("key"), "key", "left_anti").select(columns)
    counts = stored(untouched.unionByName(merged).unionByName(lines.filter("NOT known").select(columns)), "line-counts")
    return LineStore(stored(store.postings.unionByName(new), "postings"), counts, filters, store.shards)


def delete(store: LineStore, doc_ids: DataFrame, doc_id: str = "doc_id") -> LineStore:
    """``store`` without the documents named by ``doc_ids``; names that it does not hold change nothing."""
    ids = stored(doc_ids.select(F.col(doc_id).alias("doc_id")).filter("doc_id IS NOT NULL").distinct(), "leaving")
    gone = stored(store.postings.join(ids, "doc_id", "left_semi"), "postings-gone")
    left = stored(store.postings.join(ids, "doc_id", "left_anti").select(store.postings.columns), "postings")
    lost = _counted(gone).select("key", *(F.col(c).alias(f"lost_{c}") for c in ("texts", "first", "last")))
    touched = stored(store.counts.join(lost, "key"), "line-touched")
    columns = ["key", "shard", "texts", "first", "last"]
    stay = touched.withColumn("texts", F.col("texts") - F.col("lost_texts")).filter("texts > 0")
    ends = (F.col("first") == F.col("lost_first")) | (F.col("last") == F.col("lost_last"))
    # Where the least or greatest document left, the next one is found among those that are left.
    found = _counted(left.join(stay.filter(ends).select("key"), "key", "left_semi")).select("key", "first", "last")
    moved = stay.filter(ends).select("key", "shard", "texts").join(found, "key").select(columns)
    empty = touched.filter("texts = lost_texts").select("shard", "key")
    counts = (
        store.counts.join(touched.select("key"), "key", "left_anti")
        .select(columns)
        .unionByName(stay.filter(~ends).select(columns))
        .unionByName(moved)
    )
    return LineStore(left, stored(counts, "line-counts"), stored(_changed(store.filters, empty, False), "line-filters"), store.shards)


def kept_lines(store: LineStore, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` of every row of ``docs``, whose documents ``store`` holds.

    Lines of ten code points or more that two documents or more hold stay in the least of them alone. A
    null or empty text is one empty line. Rows with one key are one document, whose lines are counted
    once, and stay rows of their own; a row without a key is no document: its lines count nowhere and
    stay. Other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    often = store.counts.filter("first < last").select("key", "first")
    # A line that very many hold: adaptive execution splits its postings, and the few rows of a text meet later.
    drops = store.postings.join(often, "key").filter("doc_id > first").groupBy("doc_id", "text_hash").agg(F.collect_list("key").alias("drops"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    met = rows.join(drops, ["doc_id", "text_hash"], "left").select("doc_id", "text", "drops")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, dropped, kept = [], [], []
            for t, drop in zip(utf8(batch, 1), batch.column(2)):
                lines = t.split(b"\n")
                drop = set(drop.as_py() or ())
                left = [line for line in lines if line_key(line) not in drop] if drop else lines
                total.append(len(lines))
                dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept"],
            )

    return met.mapInArrow(run, f"doc_id {kind}, n_lines long, n_dropped long, kept string")


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row, by a store of its own."""
    kept = kept_lines(new_store(docs, doc_id, text), docs, doc_id, text)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def read_store(spark: SparkSession, path: str) -> LineStore:
    postings, counts, filters = (spark.read.parquet(f"{path}/{t}") for t in ("postings", "counts", "filters"))
    return LineStore(postings, counts, filters, spark.read.parquet(f"{path}/shards").first()["shards"])


def write_store(store: LineStore, path: str) -> None:
    """Keeps ``store`` under ``path``, which must not exist."""
    store.postings.write.parquet(f"{path}/postings")
    store.counts.write.parquet(f"{path}/counts")
    store.filters.write.parquet(f"{path}/filters")
    store.postings.sparkSession.createDataFrame([(store.shards,)], "shards int").write.parquet(f"{path}/shards")
