from __future__ import annotations


def rows(df) -> list[tuple]:
    """All rows in a stable order; NULL before other values."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is not None, str(v)) for v in row])


def values(df, column: str) -> list:
    return [row[column] for row in df.select(column).collect()]


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
