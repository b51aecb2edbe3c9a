"""Random columns that depend on a row's key, a seed and a counter, and on nothing else.

``rand`` draws by the place of a row in its partition, so another layout gives other rows other values,
and a lost task may give a row another value than before. These values are the first 52 bits of
a digest, so every engine that knows MD5 draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS = 52
#: Stands for a NULL in a key, which must not be the empty text.
NOTHING = "\\N"


def keyed_uniform(keys: Sequence[str | Column], seed: int = 0, draw: int = 0) -> Column:
    """Uniform in [0, 1): one value for each key, seed and number of the ``draw``."""
    parts = [F.coalesce(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"), F.lit(NOTHING)) for k in keys]
    text = F.concat_ws("|", *parts, F.lit(str(seed)), F.lit(str(draw)))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long") / F.lit(float(1 << BITS))


def keyed_value(keys: Sequence[str | Column], seed: int = 0, top: float = 100, digits: int = 1, draw: int = 0) -> Column:
    """Uniform below ``top``, rounded."""
    return F.round(keyed_uniform(keys, seed, draw) * top, digits)


def keyed_normal(keys: Sequence[str | Column], seed: int = 0, draw: int = 0) -> Column:
    """Standard normal, from the draws ``2 * draw`` and ``2 * draw + 1``."""
    radius = F.sqrt(-2 * F.log(1 - keyed_uniform(keys, seed, 2 * draw)))
    return radius * F.cos(2 * math.pi * keyed_uniform(keys, seed, 2 * draw + 1))


def keyed_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 0) -> list[DataFrame]:
    """``df`` in parts of about these shares, each row in one part; rows of one key stay together."""
    total, low, parts = math.fsum(weights), 0.0, []
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    tagged = df.withColumn("_u", keyed_uniform(keys, seed))
    for k, weight in enumerate(weights):
        high = low + weight / total
        # The last part takes what rounding leaves above its edge.
        inside = F.col("_u") >= low if k == len(weights) - 1 else (F.col("_u") >= low) & (F.col("_u") < high)
        parts.append(tagged.where(inside).drop("_u"))
        low = high
    return parts
