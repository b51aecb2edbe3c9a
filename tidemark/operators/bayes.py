"""Gaussian Bayes classification: one aggregation to fit, a column expression to predict.

A class is described by its share of the rows and by mean and variance of each input, so the fit is
a single group-by whose result has a row per class. Scores are sums of logarithms over literals: no
model object travels, and any engine can repeat the figures.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import cyclic_distance

#: Share of the largest variance of an input that is added to every variance, so that none is zero.
SMOOTHING = 1e-9


@dataclass(frozen=True)
class ClassMoments:
    label: int
    rows: int
    means: tuple[float, ...]
    variances: tuple[float, ...]


@dataclass(frozen=True)
class GaussianBayes:
    inputs: tuple[str, ...]
    classes: tuple[ClassMoments, ...]
    smoothing: float

    def _log_score(self, own: ClassMoments, total: int) -> Column:
        start = math.log(own.rows / total)
        parts = []
        for name, mean, variance in zip(self.inputs, own.means, own.variances):
            variance += self.smoothing
            start -= math.log(2 * math.pi * variance) / 2
            away = F.col(name) - mean
            parts.append(away * away / (2 * variance))
        return F.lit(start) - reduce(Column.__add__, parts)

    def scored(self, df: DataFrame, classes: int) -> DataFrame:
        """``df`` without rows that miss an input, with ``prediction`` and the vector ``probability`` of classes
        0 to ``classes`` - 1. Classes without training rows have probability 0; ties go to the least."""
        total = sum(own.rows for own in self.classes)
        by_label = {own.label: own for own in self.classes}
        names = [f"_score{k}" for k in sorted(by_label)]
        present = df.dropna(subset=list(self.inputs))
        with_scores = present.withColumns({name: self._log_score(by_label[k], total) for name, k in zip(names, sorted(by_label))})
        best = F.greatest(*names) if len(names) > 1 else F.col(names[0])
        with_best = with_scores.withColumn("_best", best)
        chance = {k: F.exp(F.col(name) - F.col("_best")) for name, k in zip(names, sorted(by_label))}
        whole = reduce(Column.__add__, chance.values())
        chosen = F.coalesce(*[F.when(F.col(name) == F.col("_best"), F.lit(float(k))) for name, k in zip(names, sorted(by_label))])
        chances = F.array(*[chance[k] / whole if k in chance else F.lit(0.0) for k in range(classes)])
        return with_best.withColumns({"prediction": chosen, "probability": array_to_vector(chances)}).drop(*names, "_best")


def fit_gaussian_bayes(train: DataFrame, inputs: Sequence[str], label: str, smoothing: float = SMOOTHING) -> GaussianBayes:
    """Class moments of the rows that miss neither label nor input; a row per class reaches the driver.

    The rows without classes raise ``ValueError``.
    """
    clean = train.dropna(subset=[label, *inputs])
    aggregates = [F.count("*").alias("rows")]
    for k, name in enumerate(inputs):
        aggregates += [F.avg(name).alias(f"mean{k}"), F.var_pop(name).alias(f"variance{k}")]
    found = sorted(clean.groupBy(F.col(label).cast("int").alias("label")).agg(*aggregates).collect(), key=lambda r: r["label"])
    if not found:
        raise ValueError("no rows to learn from")
    places = range(len(inputs))
    classes = tuple(
        ClassMoments(r["label"], r["rows"], tuple(r[f"mean{k}"] for k in places), tuple(r[f"variance{k}"] for k in places)) for r in found
    )
    total = sum(own.rows for own in classes)
    largest = 0.0
    for k in places:
        mean = math.fsum(own.rows * own.means[k] for own in classes) / total
        spread = math.fsum(own.rows * (own.variances[k] + (own.means[k] - mean) ** 2) for own in classes) / total
        largest = max(largest, spread)
    return GaussianBayes(tuple(inputs), classes, smoothing * largest)


def confusion(scored: DataFrame, label: str, period: int, prediction: str = "prediction") -> DataFrame:
    """Rows by true class and predicted class, with their distance on the circle of classes."""
    truth, told = F.col(label).cast("int"), F.col(prediction).cast("int")
    return scored.groupBy(truth.alias("truth"), told.alias("told")).agg(F.count("*").alias("rows")).withColumn(
        "away", cyclic_distance(F.col("truth"), F.col("told"), period)
    )
