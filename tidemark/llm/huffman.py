"""Token ids as canonical Huffman codes of limited length, in blocks that are decoded on their own.

One code serves the whole data set: it is built from the counts of all ids. A block holds whole
documents, its ids as one bit string, and the bit offset of every ``STRIDE``-th id. Decoding starts at
all these offsets at once and reads one id per offset and step through a table of all bit patterns.

The files are Parquet tables, so any store that Spark reads and writes will do:

* ``codebook``: one row, the code length of every id as a byte (0: the id does not occur);
* ``blocks``: one row per block in ascending order of the key, ``part, block, first`` (ids before it in
  its part), ``n_ids``, ``doc_ids``, ``doc_tokens``, ``offsets`` (bits, little-endian unsigned 32-bit)
  and ``bits``;
* ``parts``: one row per part, ``part, n_ids``. Parts follow each other in the order of the key.
"""

from __future__ import annotations

import functools
import os
import unicodedata
import zlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_characters, well_known
from tidemark.llm.chunkcache import ChunkCache
from tidemark.llm.texts import PIECE, folded, groups, pieces, utf8
from tidemark.llm.tables import stored
from tidemark.session import shared_path

#: Longest code. The decoding table has 2 to this power entries.
LIMIT = 16
#: Ids between two bit offsets.
STRIDE = 64
#: A block is closed when it has this many ids; a longer document is one block.
BLOCK_IDS = 1 << 16
END_ID = 1
MARKS = ".,;:!?"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for ids with counts above 0 (package-merge)."""
    ids = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(ids)
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit into codes of {limit} bits")
    if n < 2:
        lengths[ids] = 1
        return lengths
    weights = np.sort(counts[ids].astype(np.float64))
    order = ids[np.argsort(counts[ids], kind="stable")]
    # Level by level: the ids again, and the pairs of the level below. Only the kind of each item is kept.
    packages, kinds = np.zeros(0), []
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        kinds.append(rank < n)
        merged = merged[rank]
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
    # The cheapest 2n - 2 items of the top level; each package among them opens two items one level below.
    sorted_lengths = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for is_id in reversed(kinds):
        used = int(is_id[:take].sum())
        sorted_lengths[:used] += 1
        take = 2 * (take - used)
    lengths[order] = sorted_lengths
    return lengths


class Codebook:
    """Codes in canonical order: by length, then by id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        self.codes = np.zeros(len(lengths), dtype=np.int64)
        width = self.lengths[order]
        # Each code starts where the one before ends, as parts of the space of LIMIT-bit patterns.
        ends = np.cumsum(1 << (LIMIT - width))
        starts = ends - (1 << (LIMIT - width))
        self.codes[order] = starts >> (LIMIT - width)
        self.symbol = np.repeat(order, 1 << (LIMIT - width)).astype(np.int64)
        self.width = np.repeat(width, 1 << (LIMIT - width))
        gap = (1 << LIMIT) - len(self.symbol)  # one id alone fills half of the space
        self.symbol, self.width = np.pad(self.symbol, (0, gap)), np.pad(self.width, (0, gap), constant_values=1)

    def write(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of ``ids`` and the offset of every ``STRIDE``-th."""
        width = self.lengths[ids]
        ends = np.cumsum(width)
        at = ends - width
        size = int(ends[-1]) if len(ids) else 0
        value = self.codes[ids] << (24 - width - (at & 7))
        first, n = at >> 3, (size >> 3) + 4
        out = np.zeros(n)
        for k in range(3):  # codes do not overlap, so sums of bytes are bytes
            out += np.bincount(first + k, weights=(value >> (16 - 8 * k)) & 255, minlength=n)[:n]
        return out.astype(np.uint8).tobytes(), at[::STRIDE].astype("<u4")

    def read(self, bits: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids, read from all ``offsets`` side by side."""
        data = np.frombuffer(bits, dtype=np.uint8).astype(np.int64)
        window = data[:-2] << 16
        window |= data[1:-1] << 8
        window |= data[2:]
        at = offsets.astype(np.int64)
        out = np.zeros((len(at), STRIDE), dtype=np.int64)
        last = n - STRIDE * (len(at) - 1)
        for k in range(STRIDE):
            if k == last:
                at = at[:-1]
            pattern = (window[at >> 3] >> (8 - (at & 7))) & 0xFFFF
            out[: len(at), k] = self.symbol[pattern]
            at = at + self.width[pattern]
        return out.reshape(-1)[:n]


@functools.lru_cache(maxsize=2)
def cache_for(path: str) -> ChunkCache:
    """The tokenizers library behind a memory of chunks; one per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    characters, tokenize = byte_characters(), tokenizer.model.tokenize
    marks = {m: pack("<H", *tokenizer.encode(m, add_special_tokens=False).ids) for m in MARKS}

    def letters(word: str) -> bytes:
        """A word of letters is one piece for the tokenizer's pattern, so its model can take it at once."""
        if not word.isascii():
            word = "".join([characters[b] for b in word.encode()])
        ids = [token.id for token in tokenize(word)]
        return pack(f"<{len(ids)}H", *ids)

    def encode(chunks: list[bytes]) -> list[bytes]:
        """Words of letters, with or without one mark behind them, which is a piece of its own; everything else
        passes through the whole tokenizer."""
        out, others = [], []
        for k, chunk in enumerate(chunks):
            word = chunk.decode("utf-8", "replace")
            if word.isascii():
                word = word.lower()
            elif well_known(word) and "Σ" not in word:
                word = unicodedata.normalize("NFC", word).lower()
            else:
                word = ""
            if word.isalpha():
                out.append(letters(word))
            elif word and word[-1] in marks and word[:-1].isalpha():
                out.append(letters(word[:-1]) + marks[word[-1]])
            else:
                out.append(b"")
                others.append(k)
        whole = [chunks[k].decode("utf-8", "replace") for k in others]
        for k, found in zip(others, tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
            out[k] = pack(f"<{len(found.ids)}H", *found.ids)
        return out

    return ChunkCache(encode, 150_000)


def encode_ids(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 16-bit): the ids of each text and ``END_ID``.

    Null and empty texts have the end id alone. The tokenizer's chunks end at blanks, so a long text
    is encoded piece by piece.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    end = np.array([END_ID], dtype="<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cache_for(tokenizer)
        for batch in batches:
            done = 0
            for group in groups(utf8(batch, 1), 8 * PIECE):
                if len(group) > 1:
                    out = [ids.tobytes() + end for ids in cache.ids_of([folded(t) for t in group])]
                else:
                    out = [b"".join([cache.ids_of([piece])[0].tobytes() for piece in pieces(folded(group[0]))]) + end]
                keys, done = batch.column(0).slice(done, len(group)), done + len(group)
                counts = pa.array([len(ids) // 2 for ids in out], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, counts, pa.array(out, pa.binary())], ["doc_id", "n_tokens", "ids"])
        cache.clear()

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")


def id_counts(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in all of ``encoded``. One row per id and task is shuffled, one per id collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            ids = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(ids, dtype="<u2"), minlength=1 << 16)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["id", "n"])

    out = np.zeros(1 << 16, dtype=np.int64)
    for row in encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row["id"]] = row["n"]
    return out


def write_ids(encoded: DataFrame, path: str) -> None:
    """Writes ``doc_id, n_tokens, ids`` in the format above, in ascending order of ``doc_id`` (null first)."""
    spark = encoded.sparkSession
    lengths = code_lengths(id_counts(encoded))
    kind = encoded.schema["doc_id"].dataType.simpleString()
    book = lengths.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Codebook(np.frombuffer(book, dtype=np.uint8)), TaskContext.get().partitionId()
        first, number, held, size = 0, 0, [], 0

        def block():
            ids = np.concatenate([np.frombuffer(ids, dtype="<u2") for _, ids in held]).astype(np.int64)
            bits, offsets = code.write(ids)
            keys = pa.array([[key for key, _ in held]], pa.list_(key_type))
            tokens = pa.array([[len(ids) // 2 for _, ids in held]], pa.list_(pa.int64()))
            plain = [pa.array([v], t) for v, t in ((part, pa.int32()), (number, pa.int64()), (first, pa.int64()), (len(ids), pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [*plain, keys, tokens, pa.array([offsets.tobytes()], pa.binary()), pa.array([bits], pa.binary())],
                ["part", "block", "first", "n_ids", "doc_ids", "doc_tokens", "offsets", "bits"],
            )

        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((key, ids))
                size += len(ids) // 2
                if size >= BLOCK_IDS:
                    yield block()
                    first, number, held, size = first + size, number + 1, [], 0
        if held:
            yield block()

    schema = f"part int, block long, first long, n_ids long, doc_ids array<{kind}>, doc_tokens array<long>, offsets binary, bits binary"
    ordered = encoded.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, schema).write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(schema).parquet(f"{path}/blocks")
    blocks.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).write.parquet(f"{path}/parts")
    spark.createDataFrame([(bytearray(book),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codebook")


def read_ids(spark: SparkSession, path: str, kind: str = "bigint", with_ids: bool = False) -> DataFrame:
    """One row per document of the files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``start`` counts the ids of all documents before it. Blocks are decoded where they are read; only
    the sizes of the parts, one row each, meet in one place.
    """
    lengths = spark.read.parquet(f"{path}/codebook").first()["lengths"]
    book = bytes(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Codebook(np.frombuffer(book, dtype=np.uint8))
        for batch in batches:
            for row in batch.to_pylist():
                ids = code.read(row["bits"], np.frombuffer(row["offsets"], dtype="<u4"), row["n_ids"]).astype("<u4")
                ends = np.cumsum(row["doc_tokens"])
                texts = [ids[e - n : e].tobytes() for e, n in zip(ends, row["doc_tokens"])]
                starts = row["first"] + ends - np.array(row["doc_tokens"])
                columns = [
                    pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                    pa.array(np.full(len(ends), row["part"]), pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(row["doc_tokens"], pa.int64()),
                    pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                ]
                names = ["doc_id", "part", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(texts, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, part int, inside long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    decoded = spark.read.parquet(f"{path}/blocks").mapInArrow(run, schema)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.read.parquet(f"{path}/parts").select(
        F.col("part").alias("of"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before")
    )
    out = decoded.join(parts, F.col("part") == F.col("of")).withColumn("start", F.col("before") + F.col("inside"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)


def pack_ids(docs: DataFrame, tokenizer: str, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes ``docs``, writes the files to ``path`` (default: the shared folder) and reads them back.

    Rows with one key stay separate and follow each other; a null key comes first; other columns are
    ignored; an empty table gives files without blocks and an empty result. The ids are stored once
    between counting and writing, so texts are encoded a single time.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "ids")
    encoded = stored(encode_ids(docs, tokenizer, doc_id, text), "encoded")
    write_ids(encoded, path)
    return read_ids(spark, path, docs.schema[doc_id].dataType.simpleString())
