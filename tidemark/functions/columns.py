"""Column expressions shared by the operators and plans."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

# White space between words, and the hexadecimal name of an image file.
WORD_BREAK = r"[ \t\n\x0B\f\r]+"
IMAGE_NAME = r"([0-9A-F\-]+)\.png$"
MS_PER_DAY = 86_400_000


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sum_of(*values: Column | str) -> Column:
    """``a + b + ...``; NULL if any of them is."""
    return reduce(add, [as_column(value) for value in values])


def signed_text(value: Column | str) -> Column:
    """A number as text, with ``+`` in front if it is positive."""
    number = as_column(value)
    return F.concat(F.when(number > 0, "+").otherwise(""), number.cast("string"))


def celsius(fahrenheit: Column | str) -> Column:
    return (as_column(fahrenheit) - 32) * 5 / 9


def kilo(value: Column | str) -> Column:
    """Average watts over an hour as kWh, and any other thousandth."""
    return as_column(value) / 1000


def random_value(seed: int, top: float = 100, digits: int = 1) -> Column:
    """Seeded uniform number below ``top``; which row gets which depends on the partitioning."""
    return F.round(F.rand(seed) * top, digits)


def epoch_ms(wall_clock: Column | str) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp read as UTC, whatever the session's zone."""
    ts = as_column(wall_clock)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    return (
        F.unix_date(F.to_date(ts)).cast("long") * MS_PER_DAY
        + seconds * 1000
        + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000)
    ).cast("long")


def utc_time(ms: Column | str) -> Column:
    """Zone-less UTC timestamp of epoch milliseconds."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.expr("INTERVAL '0.001' SECOND") * as_column(ms)


def local_time(ms: Column | str, zone: str) -> Column:
    """Wall-clock time in ``zone``: a region such as ``Europe/Helsinki`` or an offset such as ``+03:00``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_time(ms))


def hour_start(ts: Column | str) -> Column:
    """A zone-less timestamp cut down to its hour."""
    time = as_column(ts)
    return F.to_date(time).cast("timestamp_ntz") + F.expr("INTERVAL '1' HOUR") * F.hour(time)


def local_hour(ms: Column | str, zone: str) -> Column:
    """Start of the wall-clock hour in ``zone`` that holds an epoch-millisecond time."""
    return hour_start(local_time(ms, zone))


def words(text: Column | str) -> Column:
    """Text cut at white space; empty pieces are still in."""
    return F.split(as_column(text), WORD_BREAK)


def is_word(piece: Column | str) -> Column:
    """Not empty and without a digit 0-9."""
    word = as_column(piece)
    return (F.length(word) > 0) & ~word.rlike("[0-9]")


def newton_root(value: Column | str, degree: int = 5, steps: int = 90) -> Column:
    """Odd root by Newton's method from 1, a fixed number of steps; NULL where a step divides by zero."""
    target = as_column(value).cast("double")

    def step(x: Column, _: Column) -> Column:
        return ((degree - 1) * x + F.try_divide(target, F.pow(x, F.lit(degree - 1)))) / degree

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(1.0).cast("double"), step)


def file_code(path: Column | str, pattern: str = IMAGE_NAME) -> Column:
    """Code at the end of a file path, by default the hexadecimal name of a PNG."""
    return F.regexp_extract(as_column(path), pattern, 1)


def cyclic_distance(a: Column | str, b: Column | str, period: int) -> Column:
    """Steps between two positions on a circle such as the months (12) or the hours (24)."""
    apart = F.pmod(F.abs(as_column(a) - as_column(b)), F.lit(period))
    return F.least(apart, F.lit(period) - apart)
