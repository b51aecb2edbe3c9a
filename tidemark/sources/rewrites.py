"""Changes to a folder of Parquet files that rewrite only the files with matching rows.

The files that hold matches are found through ``_metadata.file_path``; their rows are read, changed and
written beside the folder's files, out of sight of readers. Then the new files are moved in and the old
ones removed; all others stay byte for byte. Before the first move the old names are noted, so that
``finish_rewrites`` can complete a change whose driver was lost. One writer at a time; a reader that lists the
folder between the moves sees rows of both.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.tables import delete_where, merge_upsert, update_where

STAGE = "_rewrite-"


@dataclass(frozen=True)
class Rewrite:
    """How many files a change replaced, wrote, and left as they were."""

    replaced: int
    written: int
    kept: int


class _Folder:
    """The files of a table, through Hadoop's file system, so that any store will do."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.jvm = spark, spark._jvm
        self.path = self._path(path)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: object):
        return self.jvm.org.apache.hadoop.fs.Path(*parts)

    def data_files(self, below: object) -> list:
        """Files that Spark's readers would see below a folder."""
        found, todo = [], [below]
        while todo:
            for status in self.fs.listStatus(todo.pop()):
                name = status.getPath().getName()
                if name.startswith(("_", ".")):
                    continue
                (todo if status.isDirectory() else found).append(status.getPath())
        return found

    def stages(self) -> list:
        return [s.getPath() for s in self.fs.listStatus(self.path) if s.getPath().getName().startswith(STAGE)]

    def finish(self, stage: object) -> tuple[int, int]:
        """Moves the staged files in and removes the old ones; a stage without its list of old names is dropped."""
        moved = removed = 0
        noted = self._path(stage, "old")
        if self.fs.exists(self._path(noted, "_SUCCESS")):
            new = self._path(stage, "new")
            root = str(self.fs.makeQualified(new)) + "/"
            for file in self.data_files(new):
                to = self._path(self.path, str(self.fs.makeQualified(file)).removeprefix(root))
                self.fs.mkdirs(to.getParent())
                if not self.fs.rename(file, to):
                    raise OSError(f"cannot move {file} to {to}")
                moved += 1
            for row in self.spark.read.schema("value string").text(str(noted)).collect():
                removed += bool(self.fs.delete(self._path(row["value"]), False))
        self.fs.delete(stage, True)
        return moved, removed


def finish_rewrites(spark: SparkSession, path: str) -> int:
    """Completes changes that were cut off while files were moved, and drops those cut off before; their number."""
    folder = _Folder(spark, path)
    stages = folder.stages()
    for stage in stages:
        folder.finish(stage)
    return len(stages)


def rewrite_files(
    spark: SparkSession,
    path: str,
    hits: Callable[[DataFrame], DataFrame],
    change: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
) -> Rewrite:
    """Replaces the files that hold a row of ``hits`` by ``change`` of all their rows.

    ``hits`` gets the table with the column ``_file`` and must keep it; ``change`` gets the rows of those files
    (none, if there are no hits) and may add rows. A partitioned folder names its columns. The
    names of the touched files reach the driver, a line per file, as the list of files does for any scan.
    """
    finish_rewrites(spark, path)
    table = spark.read.parquet(path)
    named = table.select("*", F.col("_metadata.file_path").alias("_file"))
    # ``_metadata`` tells paths as URIs, readers take them as they are.
    files = [unquote(row["_file"]) for row in hits(named).select("_file").distinct().collect()]
    reader = spark.read.schema(table.schema).option("basePath", path)
    rows = reader.parquet(*files) if files else table.limit(0)
    folder = _Folder(spark, path)
    before = len(folder.data_files(folder.path))
    stage = f"{path}/{STAGE}{uuid.uuid4().hex}"
    new = change(rows).write
    (new.partitionBy(*partition_by) if partition_by else new).parquet(f"{stage}/new")
    # Once this list is complete the change is decided.
    spark.createDataFrame([(f,) for f in files], "value string").coalesce(1).write.text(f"{stage}/old")
    moved, _ = folder.finish(folder._path(stage))
    spark.catalog.refreshByPath(path)
    return Rewrite(len(files), moved, before - len(files))


def update_files(spark: SparkSession, path: str, changes: Mapping[str, Column], condition: Column, partition_by: Sequence[str] = ()) -> Rewrite:
    """``update_where`` on a folder."""
    return rewrite_files(spark, path, lambda t: t.where(condition), lambda t: update_where(t, changes, condition), partition_by)


def delete_files(spark: SparkSession, path: str, condition: Column, partition_by: Sequence[str] = ()) -> Rewrite:
    """``delete_where`` on a folder."""
    return rewrite_files(spark, path, lambda t: t.where(condition), lambda t: delete_where(t, condition), partition_by)


def upsert_files(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
) -> Rewrite:
    """``merge_upsert`` on a folder: files without a key of ``source`` stay, new rows come in new files.

    ``source`` is read more than once, and must give the same rows each time.
    """
    wanted = source.select(*keys)
    return rewrite_files(
        spark,
        path,
        lambda t: t.join(wanted, list(keys), "left_semi"),
        # All matches lie in the touched files, so a key that is not there is nowhere in the table.
        lambda t: merge_upsert(t, source, keys, update, insert),
        partition_by,
    )
