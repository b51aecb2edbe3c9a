"""Lines and words of a text collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import is_word, words
from tidemark.operators.aggregates import distinct_count, group_counts, row_count
from tidemark.operators.ranking import top_k
from tidemark.operators.reshape import explode_words
from tidemark.sources.readers import typed

WORD_COUNT = "word string, count bigint"
LINE_BREAK = r"\r\n|\r|\n"


def lines_of(texts: DataFrame, text: str) -> DataFrame:
    """Non-empty lines of a column of whole texts, as column ``value``."""
    return explode_words(texts, F.split(F.col(text), LINE_BREAK), "value").where(F.length("value") > 0)


def words_of(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row per word; pieces that are empty or hold a digit are no words."""
    return explode_words(lines, words(text)).where(is_word("word"))


def line_total(lines: DataFrame) -> DataFrame:
    return row_count(lines, "lines")


def line_starts(lines: DataFrame, text: str = "value", n: int = 8, width: int = 60) -> DataFrame:
    """The first characters of the first ``n`` lines in text order."""
    return top_k(lines, [F.asc(text)], n).select(F.substring(text, 1, width).alias("start"))


def word_total(word_rows: DataFrame) -> DataFrame:
    return row_count(word_rows, "words")


def word_distinct(word_rows: DataFrame) -> DataFrame:
    return distinct_count(word_rows, "word", "distinct_words")


def word_counts(word_rows: DataFrame) -> DataFrame:
    """Each word with its number of occurrences."""
    return group_counts(word_rows, ["word"])


def typed_word_counts(counts: DataFrame) -> DataFrame:
    """Word counts under the declared record ``word string, count bigint``."""
    return typed(counts, WORD_COUNT)


def rarest_first(counts: DataFrame) -> DataFrame:
    """Word counts in ascending order of count and word."""
    return counts.orderBy("count", "word")


def most_common_word(word_rows: DataFrame, length: int, prefix: str) -> DataFrame:
    """The most common word of a length and prefix; equal counts give the first in text order.

    The condition is on the word itself, so it is applied before the words are counted.
    """
    chosen = word_rows.where((F.length("word") == length) & F.col("word").startswith(prefix))
    return top_k(word_counts(chosen), [F.desc("count"), F.asc("word")], 1)
