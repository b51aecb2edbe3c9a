"""Tables between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark import session

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there, its shuffle files given up.

    Once the table is written, nothing reads the shuffles that made it; without this setting they would
    stay on the executors' disks until the driver happens to collect its garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        return session.stored(df, purpose)
    finally:
        conf.set(CLEAN_UP, before)
