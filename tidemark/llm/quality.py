"""Quality rules per document and per host: failure rates shrunk by an empirical beta prior.

Documents are measured one by one. Each host's failures are counted per rule, the counts of all hosts
give a beta prior per rule by the method of moments, and each host's rate is drawn towards it: a host
with few documents is judged by what is usual, one with many by its own record. The verdict on the host
then goes back to its documents: a soft rule that a document fails counts unless its host has a record
of failing it less than is usual, and nothing is kept from a host that fails nearly always.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import BLANKS, fresh, frugal, groups, utf8
from tidemark.llm.tables import stored

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
#: Soft rules as conditions on the counts, exact in integers.
SOFT_RULES = {
    "symbols": "10 * n_symbols > n_words",
    "marks": "2 * n_marks > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "long_words": "word_chars > 12 * n_words",
}
#: A soft failure counts on hosts whose shrunk rate of that rule is at least this share of the usual rate, the
#: mean over hosts. A host without a record has the usual rate; only a better record waives the rule.
KNOWN_FOR = 0.9
#: Hosts whose shrunk rate of documents that fail at all is above this lose all documents.
HOST_LIMIT = 0.9
#: Weight of the prior, in documents, where hosts differ no more than chance would have it.
EVEN_HOSTS = 1e6
#: Texts of more words count windows in arrays instead of tuples.
LONG = 50_000

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_marks bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text has at least twice."""
    n = len(words)
    if n < 4:
        return 0
    if n > LONG:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
        _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
        _, window, count = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        again = count[window] > 1
    else:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        count = Counter(windows)
        again = np.fromiter((count[w] > 1 for w in windows), dtype=bool, count=n - 2)
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The columns of ``COUNTS`` for one text."""
    words = text.split()
    blanks = len(text) - len(text.translate(None, BLANKS))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.translate(None, BLANKS)]
    return (
        len(words),
        len(text.decode("utf-8", "replace")) - blanks,
        symbols,
        text.count(b"!"),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def rule_counts(docs: DataFrame, text: str = "text", counts: str = "counts") -> DataFrame:
    """``docs`` with a struct column ``counts`` that holds the columns of ``COUNTS``. Narrow."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = [c.split()[0] for c in COUNTS.split(", ")]
    inner = ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in COUNTS.split(", "))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for group in groups(utf8(batch, text)):  # a part of the batch at a time, which bounds what is held twice
                columns = list(zip(*[measure(t) for t in group]))
                struct = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
                part = batch.slice(done, len(group))
                done += len(group)
                yield pa.RecordBatch.from_arrays([*part.columns, struct], [*batch.schema.names, counts])

    return docs.mapInArrow(frugal(run), f"{schema}, `{counts}` struct<{inner}>")


def base_failed(counts: str) -> Column:
    return F.expr(f"{counts}.n_words < {MIN_WORDS} or 100 * {counts}.n_repeat_words > {MAX_REPEATED} * {counts}.n_words")


def soft_failed(counts: str, rule: str) -> Column:
    fields = [c.split()[0] for c in COUNTS.split(", ")]
    condition = SOFT_RULES[rule]
    for name in fields:
        condition = condition.replace(name, f"{counts}.{name}")
    return F.expr(condition)


def host_table(measured: DataFrame, host: str, counts: str, known_for: float = KNOWN_FOR, host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host (null is one): ``host``, ``n_docs``, its verdict per rule and on the whole.

    The counts are combined before the shuffle, so a host with a third of all rows is a few rows there.
    The prior is one row of sums over all hosts.
    """
    rules = [*SOFT_RULES, "any"]
    failed = {r: soft_failed(counts, r) for r in SOFT_RULES}
    any_failed = base_failed(counts)
    for f in failed.values():
        any_failed = any_failed | f
    failed["any"] = any_failed
    hosts = stored(
        measured.groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("n_docs"), *[F.sum(failed[r].cast("long")).alias(f"failed_{r}") for r in rules]
        ),
        "hosts",
    )
    moments = hosts.agg(
        F.avg(1 / F.col("n_docs")).alias("noise"),
        *[F.avg(F.col(f"failed_{r}") / F.col("n_docs")).alias(f"mean_{r}") for r in rules],
        *[F.var_pop(F.col(f"failed_{r}") / F.col("n_docs")).alias(f"var_{r}") for r in rules],
    ).first()
    rates = {r: shrunk(moments, r) for r in rules}
    return hosts.select(
        "host",
        "n_docs",
        *[(rates[r] >= F.lit(known_for * (moments[f"mean_{r}"] or 0.0))).alias(f"known_{r}") for r in SOFT_RULES],
        (rates["any"] > host_limit).alias("rejected"),
    )


def shrunk(moments, rule: str) -> Column:
    """The mean of the beta posterior of a host's rate."""
    mean, noise = moments[f"mean_{rule}"] or 0.0, moments["noise"] or 0.0
    chance = mean * (1 - mean)
    # What the rates vary beyond the noise of counting; from it the weight of the prior.
    beyond = (moments[f"var_{rule}"] or 0.0) - chance * noise
    weight = min(EVEN_HOSTS, max(0.0, chance / beyond - 1)) if beyond > 0 else EVEN_HOSTS
    return (F.col(f"failed_{rule}") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))


def judged(measured: DataFrame, host: str, counts: str, **limits: float) -> DataFrame:
    """``measured`` with ``base_failed``, ``host_rejected`` and ``kept``."""
    hosts = host_table(measured, host, counts, **limits)
    hosts = stored(hosts.withColumnsRenamed({c: f"__{c}" for c in hosts.columns}), "verdicts")
    soft = F.lit(False)
    for rule in SOFT_RULES:
        soft = soft | (soft_failed(counts, rule) & F.col(f"__known_{rule}"))
    base = F.coalesce(base_failed(counts), F.lit(True))
    joined = measured.join(hosts, F.col(host).eqNullSafe(F.col("__host")))
    return joined.withColumns(
        {"base_failed": base, "host_rejected": F.col("__rejected"), "kept": ~base & ~soft & ~F.col("__rejected")}
    ).drop(*hosts.columns)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its counts, ``base_failed``, ``host_rejected`` and ``kept``.

    A null text has no words and fails; a null host is a host of its own; repeated rows are counted and
    answered each; an empty table gives an empty one; other columns are ignored. Texts are read once:
    the counts are stored, and hosts and verdicts come from them.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    counts = stored(rule_counts(slim).drop("text"), "counts")
    out = judged(counts, "host", "counts")
    return out.select("doc_id", "counts.*", "base_failed", "host_rejected", "kept")


def keep_good(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Texts are measured twice, once for the hosts and once for the verdict, which costs less than
    moving them: nothing but counts per host is shuffled while the hosts are few enough for Spark to
    broadcast them; beyond that the rows meet their hosts in a join that adaptive execution splits.
    """
    counts, record = fresh(docs, "counts"), docs.columns
    hosts = rule_counts(docs.select(host, text), text, counts).drop(text)
    table = host_table(hosts, host, counts)
    names = {c: fresh(docs, f"__{c}") for c in table.columns}
    table = stored(table.withColumnsRenamed(names), "verdicts")
    good = ~base_failed(counts) & ~F.col(names["rejected"])
    for rule in SOFT_RULES:
        good = good & ~(soft_failed(counts, rule) & F.col(names[f"known_{rule}"]))
    measured = rule_counts(docs, text, counts)
    return measured.join(table, F.col(host).eqNullSafe(F.col(names["host"]))).filter(good).select(*record)
