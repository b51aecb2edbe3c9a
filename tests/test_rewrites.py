import hashlib
import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.operators import tables
from tidemark.sources import rewrites

COLUMNS = ["k", "v", "city"]


@pytest.fixture
def path(spark, folder):
    there = f"{folder}/table"
    city = F.when(F.col("id") % 3 == 0, "New York/50%").otherwise("Oulu")
    spark.range(0, 800, numPartitions=8).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), city.alias("city")).write.parquet(there)
    return there


def digests(path):
    found = {}
    for top, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(top, name), "rb") as file:
                    found[os.path.relpath(os.path.join(top, name), path)] = hashlib.sha256(file.read()).hexdigest()
    return found


def table(spark, path):
    return spark.read.parquet(path).select(*COLUMNS)


def test_an_update_replaces_the_files_it_touches(spark, path):
    before, want = digests(path), tables.update_where(table(spark, path), {"v": F.lit(-1)}, F.col("k").between(150, 250))
    want = rows(want)
    done = rewrites.update_files(spark, path, {"v": F.lit(-1)}, F.col("k").between(150, 250))
    after = digests(path)
    assert (done.replaced, done.kept) == (2, 6) and len(after) == 6 + done.written
    assert len(set(before.items()) & set(after.items())) == 6
    assert rows(table(spark, path)) == want
    assert not [name for name in os.listdir(path) if name.startswith("_rewrite")]


def test_a_delete_leaves_unknown_rows_and_other_files(spark, path):
    before = digests(path)
    done = rewrites.delete_files(spark, path, F.when(F.col("k") != 5, F.col("k") < 10))
    assert (done.replaced, done.kept) == (1, 7) and len(set(before.items()) & set(digests(path).items())) == 7
    assert [r[0] for r in rows(table(spark, path).where("k < 12"))] == [10, 11, 5]
    assert table(spark, path).count() == 800 - 9


def test_an_upsert_touches_only_files_with_its_keys(spark, path):
    source = spark.createDataFrame([(k, -k, "x") for k in (3, 777, 5000, 5001)], "k long, v long, city string")
    want = rows(tables.merge_upsert(table(spark, path), source, ["k"]))
    before = digests(path)
    done = rewrites.upsert_files(spark, path, source, ["k"])
    assert (done.replaced, done.kept) == (2, 6) and len(set(before.items()) & set(digests(path).items())) == 6
    assert rows(table(spark, path)) == want
    # Keys that are nowhere: only new files.
    more = source.select((F.col("k") + 10_000).alias("k"), "v", "city")
    before = digests(path)
    assert rewrites.upsert_files(spark, path, more, ["k"]).replaced == 0
    assert before.items() <= digests(path).items() and table(spark, path).count() == 806


def test_a_change_that_fails_changes_nothing(spark, path):
    before = digests(path)
    twice = spark.createDataFrame([(3, 1, "a"), (3, 2, "b")], "k long, v long, city string")
    with pytest.raises(Exception, match=tables.DUPLICATE_MATCH):
        rewrites.upsert_files(spark, path, twice, ["k"])
    assert digests(path).items() >= before.items() and table(spark, path).count() == 800
    # What it left out of sight goes with the next change.
    assert rewrites.finish_rewrites(spark, path) == 1
    assert digests(path) == before


def test_no_match_changes_no_row(spark, path):
    want, before = rows(table(spark, path)), digests(path)
    done = rewrites.delete_files(spark, path, F.col("k") < 0)
    assert done.replaced == 0 and rows(table(spark, path)) == want and before.items() <= digests(path).items()


def test_partitioned_folders_with_awkward_names(spark, path, folder):
    there = f"{folder}/by city"
    table(spark, path).write.partitionBy("city").parquet(there)
    want = rows(tables.update_where(table(spark, there), {"city": F.lit("Oulu")}, F.col("k") == 3))
    done = rewrites.update_files(spark, there, {"city": F.lit("Oulu")}, F.col("k") == 3, ["city"])
    assert done.replaced == 1 and rows(table(spark, there)) == want
    assert table(spark, there).where("city = 'Oulu' AND k = 3").count() == 1


def test_a_change_cut_off_while_moving_is_completed(spark, path, monkeypatch):
    condition, change = F.col("k").between(150, 250), {"v": F.lit(-1)}
    want = rows(tables.update_where(table(spark, path), change, condition))
    finish = rewrites._Folder.finish

    def cut(self, stage):
        new = self.data_files(self._path(stage, "new"))
        self.fs.rename(new[0], self._path(self.path, new[0].getName()))
        raise OSError("driver lost")

    monkeypatch.setattr(rewrites._Folder, "finish", cut)
    with pytest.raises(OSError):
        rewrites.update_files(spark, path, change, condition)
    monkeypatch.setattr(rewrites._Folder, "finish", finish)
    assert rewrites.finish_rewrites(spark, path) == 1 and rewrites.finish_rewrites(spark, path) == 0
    spark.catalog.refreshByPath(path)
    assert rows(table(spark, path)) == want
