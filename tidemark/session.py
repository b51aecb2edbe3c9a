"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Partitions to which ``spread`` deals out small files; unset: none.
PARTITIONS_KEY = "tidemark.partitions"


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # A small shuffle may feed a step that multiplies its rows: leave it on all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; a cluster without it is an
    error, because a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/tidemark/{purpose}-{uuid.uuid4().hex}"


def spread(scan: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """``scan`` dealt out by key to so many partitions; by default to those that ``tidemark.partitions`` of
    the session names, and left as it is without either.

    For work that costs far more per row than a shuffle does, such as cutting texts, on files too small
    to be split. Neither the size of the table nor that of the cluster is looked at, so a large table is
    shuffled only if asked for.
    """
    number = partitions or int(scan.sparkSession.conf.get(PARTITIONS_KEY, None) or 0)
    return scan.repartition(number, *keys) if number else scan


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    For a result that several passes read: they see the same rows, including what a recomputation may
    change (partition numbers, the last digits of a sum), need only the columns they use, and survive
    the loss of the executors that computed it.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
