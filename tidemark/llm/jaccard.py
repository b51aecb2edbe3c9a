"""All links of Jaccard similarity 0.8 or more between documents as sets of 5-word shingles.

Exact, in three narrowing steps:

1. Of each set the first shingles in the order of their hashes are looked at. Two similar sets have a
   known number of common shingles among these, so documents with fewer that occur elsewhere have no
   partner at all. Most documents leave here, having sent six tenths of their shingles.
2. The others become classes of equal sets. Shingles are ordered rare first, and each class posts those
   of its prefix. Members of a posting list are candidates if their sizes (length filter), their places
   in the order (positional filter) and the parities of parts of their sets (suffix filter) allow it.
3. Candidates are verified once per pair. In each list the members first meet a few hubs of the list,
   which links large groups of near copies without their pairs; then whatever pairs remain across
   different components of a list are compared, so no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.texts import PIECE, fresh, frugal, mixed, parts, shingle_set
from tidemark.llm.tables import stored

WORDS = 5
PERCENT = 80
HUBS = 8
#: 64-bit words of parities per set for the suffix filter.
PARITY_WORDS = 8
#: Bytes of text whose shingles a task holds at one time, in many times their size, beside those of the other
#: tasks of its executor. The size decides how often a shingle of many documents is sent, not what is found.
PART = PIECE
#: Bits in which the keys of documents with possible partners are marked: 4 MB, whatever their number.
MARK_BITS = 25


def least_common(n: int) -> int:
    """Shingles that a set of ``n`` shares at least with any similar set."""
    return (PERCENT * n + 99) // 100


def wanted(n: int) -> int:
    """Common shingles that the first filter looks for in a set of ``n``: two fifths."""
    return (2 * n + 4) // 5


def _sampled(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows ``h, doc_id, added, need, n``: shingles of long prefixes, and one row with ``n`` per document.

    With ``c`` common shingles at least, the first ``size - c + k`` of two sets in any one order share
    ``k``. Shingles that several documents of a part of a batch have are counted there (``added``) and sent
    once without a document, so the most frequent shingle makes one row per part.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def sampled(texts: list[bytes], keys: pa.Array) -> pa.RecordBatch:
        sets = [shingle_set(t, WORDS) for t in texts]
        n = np.array([len(s) for s in sets], dtype=np.int64)
        heads = [s[: len(s) - least_common(len(s)) + wanted(len(s))].copy() for s in sets]
        first = np.array([s[0] if len(s) else 0 for s in sets], dtype=np.uint64)
        del sets
        owner = np.repeat(np.arange(len(heads), dtype=np.int32), [len(h) for h in heads])
        every = np.concatenate(heads)
        del heads
        hashes, back, count = np.unique(every, return_inverse=True, return_counts=True)
        common = count[back] > 1
        del back
        added = np.bincount(owner[common], minlength=len(n))
        need = np.array([wanted(least_common(int(k))) if k else 1 for k in n], dtype=np.int64)
        spread = mixed(first + np.arange(len(n), dtype=np.uint64))
        alone, shared = ~common, hashes[count > 1]
        h = np.concatenate([every[alone], shared, spread]).view(np.int64)
        docs_of = pa.concat_arrays([keys.take(pa.array(owner[alone])), pa.nulls(len(shared), keys.type), keys])
        rest = len(h) - len(n)
        tail = [pa.concat_arrays([pa.nulls(rest, pa.int64()), pa.array(x, pa.int64())]) for x in (added, need, n)]
        return pa.RecordBatch.from_arrays([pa.array(h), docs_of, *tail], ["h", "doc_id", "added", "need", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, group in parts(batch, 1, PART):
                yield sampled(group, batch.column(0).slice(start, len(group)))

    return docs.select(doc_id, text).mapInArrow(frugal(run), f"h long, doc_id {kind}, added long, need long, n long")


def shared_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n, shared, need``: a document with ``shared < need`` is linked with nothing.

    Where several texts have one key, ``shared`` is that of all and ``need`` the least of theirs, so that
    no text that can be linked is lost by the others.
    """
    rows = _sampled(docs, doc_id, text).withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("h")))
    useful = rows.filter("n is not null or (doc_id is not null and times > 1)")
    return useful.groupBy("doc_id").agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
        F.sum(F.coalesce(F.col("added"), F.lit(1))).alias("shared"),
        F.coalesce(F.min("need"), F.lit(1)).alias("need"),
    )


def shingle_classes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, digest, n, shingles, parity`` for documents with words."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def parity(s: np.ndarray) -> list[int]:
        odd = np.bincount((s % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, group in parts(batch, 1, PART):
                sets = [shingle_set(t, WORDS) for t in group]
                keys = batch.column(0).slice(start, len(group))
                columns = [
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([parity(s) for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([keys, *columns], ["doc_id", "digest", "n", "shingles", "parity"])

    schema = f"doc_id {kind}, digest binary, n long, shingles array<long>, parity array<long>"
    return docs.select(doc_id, text).mapInArrow(frugal(run), schema).filter("n > 0")


def postings(classes: DataFrame) -> DataFrame:
    """``h, rep, n, place, parity`` for the prefix shingles of each class that others have too.

    ``place`` counts from 1 in the rare-first order of the class, shingles that it has alone included.
    """
    each = classes.select("rep", "n", F.explode("shingles").alias("h"))
    often = each.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = Window.partitionBy("rep")
    least = F.expr(f"({PERCENT} * n + 99) div 100")
    ranked = each.join(often, "h").select(
        "h", "rep", "n", F.row_number().over(own.orderBy("df", "h")).alias("k"), F.count(F.lit(1)).over(own).alias("shared")
    )
    placed = ranked.filter(F.col("shared") >= least).withColumn("place", F.col("n") - F.col("shared") + F.col("k"))
    return placed.filter(F.col("place") <= F.col("n") - least + 1).join(
        classes.select("rep", "parity"), "rep"
    ).select("h", "rep", "n", "place", "parity")


def possible() -> Column:
    """Whether rows ``x`` and ``y`` of one list can be similar: length, positional and suffix filter."""
    n_x, n_y = F.col("x.n"), F.col("y.n")
    length = (100 * F.least(n_x, n_y)) >= (PERCENT * F.greatest(n_x, n_y))
    # What both can have in common if this is their first common shingle. Similar sets pass in the list of
    # their first one, whatever the others say, so nothing is lost and few pairs come up more than once.
    rest = F.least(n_x - F.col("x.place"), n_y - F.col("y.place")) + 1
    positional = 100 * rest >= PERCENT * (n_x + n_y - rest)
    # Sets that differ in d shingles differ in at most d parities; similar ones differ in at most this many:
    # common c >= p (n_x + n_y) / (100 + p) gives d = n_x + n_y - 2 c.
    differ = F.aggregate(F.zip_with("x.parity", "y.parity", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, k: s + k)
    suffix = (100 + PERCENT) * differ <= (100 - PERCENT) * (n_x + n_y)
    return length & positional & suffix


def verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are links."""
    sets = classes.select("rep", "n", "shingles")
    one = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    sized = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", common.alias("c"))
    return sized.filter(100 * F.col("c") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("c"))).select("a", "b")


def _hubs(lists: DataFrame, numbers: range) -> DataFrame:
    """Of each list with several members the least under each of several hashes, so that lists that are alike
    get the same hubs."""
    row = F.struct("rep", "n", "place", "parity", "component")
    least = lists.groupBy("h").agg(
        F.count(F.lit(1)).alias("members"),
        *[F.min(F.struct(F.xxhash64("rep", F.lit(k)).alias("o"), row.alias("row"))).alias(f"hub{k}") for k in numbers],
    ).filter("members > 1")
    rows = F.array_distinct(F.array(*[F.col(f"hub{k}.row") for k in numbers]))
    return least.select("h", F.explode(rows).alias("row")).select("h", "row.*")


def class_links(classes: DataFrame, given: DataFrame) -> DataFrame:
    """``node, component`` of the classes (``rep``) that have links, the ``given`` ones (``a, b``) included.

    First every member of a list meets one hub, then several more where components still differ, then
    whatever is left in a list with more than one component. A pair is verified once at most.
    """
    lists = stored(postings(classes), "postings")
    links = tried = found = None
    met, apart = F.col("x.h") == F.col("y.h"), F.col("x.component") != F.col("y.component")
    rounds = [range(1), *([range(1, HUBS)] if HUBS > 1 else []), None]
    for numbers in rounds:
        if found is None:
            labelled = lists.withColumn("component", F.col("rep"))
        else:
            member = found.withColumnsRenamed({"node": "rep"})
            labelled = lists.join(member, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
            open_ = labelled.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("h")
            labelled = stored(labelled.join(open_, "h", "left_semi"), "open")
        if numbers is None:
            pairs = labelled.alias("x").join(labelled.alias("y"), met & apart & (F.col("x.rep") < F.col("y.rep")) & possible())
        else:
            pairs = labelled.alias("x").join(_hubs(labelled, numbers).alias("y"), met & apart & possible())
        new = pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
        new = stored(new if tried is None else new.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = new if tried is None else tried.unionByName(new)
        more = stored(verified(new, classes), "links")
        if found is None or not more.isEmpty():
            links = more.unionByName(given) if links is None else links.unionByName(more)
            found = stored(components(links), "components")
    return found


def _likely(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``rows`` whose key is in ``keys``, and a few others.

    Hashes of the keys are marked in ``2 ** MARK_BITS`` bits, which are all that is sent to the tasks (4 MB),
    so texts that no join will keep need not be shuffled for it. The more bits are set, the more others pass.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(1 << MARK_BITS))
    marks = keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    place = F.bitmap_bit_position("slot").cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.call_function("shiftright", byte, place % 8).bitwiseAND(F.lit(1)) == 1
    met = rows.withColumn("slot", slot).withColumn("bucket", F.bitmap_bucket_number("slot")).join(F.broadcast(marks), "bucket")
    return met.where(marked).select(*rows.columns)


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per key: ``doc_id, n_shingles, class_id, component_id``.

    ``class_id`` is the least key with the same set, ``component_id`` the least that links reach. Null
    and empty texts have no shingles and are linked with nothing. Rows with one key are one document,
    linked through any of its texts, ``n_shingles`` being that of the largest; a null key gives one row
    with null ids. Other columns are ignored; an empty table gives an empty one.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counts = stored(shared_counts(slim), "shared")
    hopeful = counts.filter("shared >= need and doc_id is not null").select("doc_id")
    # An inner join with the distinct keys: Spark would move a semi-join below the marks and shuffle all texts.
    some = _likely(slim, hopeful, "doc_id").join(hopeful, "doc_id")
    sets = stored(shingle_classes(some, "doc_id", "text"), "sets")
    classes = stored(
        sets.groupBy("digest").agg(
            F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("shingles").alias("shingles"), F.first("parity").alias("parity")
        ).withColumn("rep", F.monotonically_increasing_id()),  # stored, so a class keeps its number
        "classes",
    )
    member = stored(sets.select("doc_id", "digest").join(classes.select("digest", "rep", "least"), "digest").drop("digest"), "members")
    # A key with texts of several classes links them.
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).filter("a < last").select("doc_id", "a")
    same_key = member.join(several, "doc_id").filter("rep > a").select("a", F.col("rep").alias("b")).distinct()
    found = class_links(classes, stored(same_key, "key-links"))
    joined = member.join(found, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep"))
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = joined.join(least, "component").groupBy("doc_id").agg(F.min("least").alias("class_id"), F.min("component_id").alias("component_id"))
    return counts.join(placed, "doc_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key is the least of its component, with all their columns."""
    found, name = jaccard_components(docs, doc_id, text), fresh(docs, "gone")
    gone = stored(found.filter("component_id < doc_id").select(F.col("doc_id").alias(name)), "gone")
    return docs.join(gone, F.col(doc_id) == F.col(name), "left_anti")
