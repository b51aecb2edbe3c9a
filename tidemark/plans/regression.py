"""A line through measured points, end to end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.ml import fit_line, key_split, score


def line_figures(spark: SparkSession, model: LinearRegressionModel, inputs: Sequence[str]) -> DataFrame:
    """Coefficients and intercept of a fitted line, one row."""
    values = [float(c) for c in model.coefficients] + [float(model.intercept)]
    fields = ", ".join(f"`{name}` double" for name in [*inputs, "intercept"])
    return spark.createDataFrame([tuple(values)], fields)


def fit_and_score(
    points: DataFrame,
    inputs: Sequence[str],
    label: str,
    split_keys: Sequence[str],
    train: float = 0.83,
    seed: int = 1,
    portable: bool = False,
) -> tuple[LinearRegressionModel, DataFrame, DataFrame]:
    """The model of the training part, with the scored training and test parts."""
    fit_rows, test_rows = key_split(points, split_keys, train, seed, portable)
    model = fit_line(fit_rows, inputs, label)
    return model, score(model, fit_rows, inputs), score(model, test_rows, inputs)


def with_error(scored: DataFrame, label: str) -> DataFrame:
    return scored.withColumn("error", F.col(label) - F.col("prediction"))
