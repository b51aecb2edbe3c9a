import math
import random

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from helpers import rows
from tidemark.functions import keyed_random as R
from tidemark.functions.colors import color_histogram, tiff_file
from tidemark.operators import bayes, ml
from tidemark.sources.readers import read_images
from tidemark.sources.writers import write_binary_files


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(4)
    data = []
    for i in range(1200):
        k = rng.randrange(4)
        x = rng.gauss(k, 1.2) if rng.random() > 0.02 else None
        data.append((i, float(k), x, rng.gauss(-2 * k, 3.0), 5.0))
    return spark.createDataFrame(data, "id int, label double, x double, y double, flat double").repartition(5)


def test_moments_agree_with_the_built_in_classifier(points):
    inputs = ["x", "y"]
    train, test = ml.key_split(points, ["id"], 0.7)
    ours = bayes.fit_gaussian_bayes(train, inputs, "label").scored(test, 4)
    clean = ml.with_features(train, inputs).select("features", "label")
    theirs = NaiveBayes(modelType="gaussian").fit(clean).transform(ml.with_features(test, inputs))
    assert rows(ours.select("id", "prediction")) == rows(theirs.select("id", "prediction"))
    a = {r[0]: r[1] for r in ours.select("id", vector_to_array("probability")).collect()}
    b = {r[0]: r[1] for r in theirs.select("id", vector_to_array("probability")).collect()}
    assert all(abs(p - q) < 1e-9 for i in a for p, q in zip(a[i], b[i]))
    figures = ml.cyclic_evaluation(ours, "label", 4, probability="probability").first()
    assert abs(100 * ml.accuracy_value(ours, "label") - figures["within_0"]) < 1e-9
    table = bayes.confusion(ours, "label", 4)
    assert table.where("away = 0").agg(F.sum("rows")).first()[0] == round(figures["within_0"] * figures["predictions"] / 100)


def test_classes_that_are_absent_and_inputs_that_do_not_vary(points):
    model = bayes.fit_gaussian_bayes(points.where("label in (1, 3)"), ["x", "flat"], "label")
    scored = model.scored(points, 6)
    assert {r[0] for r in scored.select("prediction").distinct().collect()} == {1.0, 3.0}
    chances = [r[0] for r in scored.select(vector_to_array("probability")).collect()]
    assert all(len(c) == 6 and c[0] == c[2] == c[4] == c[5] == 0 and abs(sum(c) - 1) < 1e-12 for c in chances)
    assert scored.count() == points.where("x IS NOT NULL").count()
    alone = bayes.fit_gaussian_bayes(points.where("label = 2"), ["x"], "label").scored(points, 4)
    assert [r[0] for r in alone.select("prediction").distinct().collect()] == [2.0]
    with pytest.raises(ValueError):
        bayes.fit_gaussian_bayes(points.limit(0), ["x"], "label")


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(500).withColumn("u", F.lit(0))
    one, seven = (rows(df.repartition(k).withColumn("u", R.keyed_uniform(["id"], 3))) for k in (1, 7))
    assert one == seven and len({u for _, u in one}) == 500


def test_draws_are_uniform_and_independent(spark):
    n, bins = 20_000, 20
    draws = spark.range(n).select(*[R.keyed_uniform(["id"], seed, draw).alias(f"u{seed}{draw}") for seed, draw in ((0, 0), (0, 1), (1, 0))])
    for name in draws.columns:
        counts = [r["count"] for r in draws.groupBy(F.floor(F.col(name) * bins)).count().collect()]
        # 99.9 per cent of chi-square with 19 degrees of freedom.
        assert len(counts) == bins and sum((c - n / bins) ** 2 / (n / bins) for c in counts) < 43.8
    for a, b in (("u00", "u01"), ("u00", "u10")):
        assert abs(draws.agg(F.corr(a, b)).first()[0]) < 0.03
    low, high = draws.agg(F.min("u00"), F.max("u00")).first()
    assert 0 <= low < 0.001 and 0.999 < high < 1
    mean, spread = spark.range(n).select(R.keyed_normal(["id"]).alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(mean) < 0.03 and abs(spread - 1) < 0.03


def test_nulls_are_keys_of_their_own(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None), ("a", "")], "x string, y string")
    assert df.select(R.keyed_uniform(["x", "y"]).alias("u")).distinct().count() == 4
    assert df.select(R.keyed_value(["x", "y"], 1, top=7, digits=2).alias("v")).where("v BETWEEN 0 AND 7").count() == 4


def test_parts_are_disjoint_and_whole(spark):
    df = spark.range(3000).withColumn("k", F.col("id") % 1000)
    parts = R.keyed_split(df, ["k"], [2, 1, 1], seed=4)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 3000 and abs(sizes[0] - 1500) < 150 and parts[0].columns == df.columns
    assert parts[0].join(parts[1], "k").count() == 0
    again = R.keyed_split(df.repartition(9), ["k"], [2, 1, 1], seed=4)
    assert rows(again[2]) == rows(parts[2])
    for wrong in ([], [1, 0]):
        with pytest.raises(ValueError):
            R.keyed_split(df, ["k"], wrong)


def test_written_images_are_scanned_as_they_were(spark, folder):
    rng = random.Random(2)
    data = {f"{k:X}": rng.randbytes(n) for k, n in enumerate((4, 5, 7, 8, 400, 4003), 1)}
    data["AA"] = b"\n\r\0\xff" * 3
    df = spark.createDataFrame([(c, bytearray(d)) for c, d in data.items()], "code string, data binary")
    files = df.select("code", tiff_file("data").alias("content"))
    junk = spark.createDataFrame([("1", bytearray(b"no image")), ("B", bytearray(b""))], "code string, content binary")
    write_binary_files(files.unionByName(junk), "content", f"{folder}/images", "code")
    scanned = read_images(spark, f"{folder}/images")
    code = F.regexp_extract("image.origin", "code=([0-9A-F]+)/", 1)
    got = {r["code"]: r for r in scanned.select(code.alias("code"), "image.*").collect()}
    assert set(got) == set(data)
    for c, d in data.items():
        assert bytes(got[c]["data"]) == d + b"\0" * (-len(d) % 4) and got[c]["nChannels"] == 4 and got[c]["height"] == 1
    by_file = color_histogram(scanned.select("image"), "image.data", "image.nChannels", ["image"]).select(code.alias("code"), "total_pixels", "colors")
    by_bytes = color_histogram(df.withColumn("n", F.lit(4)), "data", "n", ["code"])
    assert rows(by_file) == rows(by_bytes)
    assert all(r["total_pixels"] == math.ceil(len(data[r["code"]]) / 4) for r in by_file.collect())
