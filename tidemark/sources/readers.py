"""Scans: CSV, Parquet, table formats, JSON lines, images, text, rows and streams."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

Schema = StructType | str

#: What a CSV file needs so that values come back as they were: quotes doubled inside quotes, so that
#: backslashes stand for themselves, spaces at the edges kept, and times with all six digits.
CSV_FORM = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
#: Faithful files also tell NULL from the empty text and keep line breaks, which would cut a row in two.
FAITHFUL_FORM = {**CSV_FORM, "nullValue": "%N", "emptyValue": ""}
LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
BREAKS = {"\r": "%0D", "\n": "%0A"}


def decoded_texts(df: DataFrame) -> DataFrame:
    """Texts of a faithful CSV file as they were before writing."""

    def plain(name: str) -> Column:
        value = F.col(f"`{name}`")
        for sign, code in BREAKS.items():
            value = F.replace(value, F.lit(code), F.lit(sign))
        return F.replace(value, F.lit("%25"), F.lit("%")).alias(name)

    return df.select(*[plain(n) if kind == "string" else F.col(f"`{n}`") for n, kind in df.dtypes])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    sep: str = ",",
    header: bool = True,
    infer: bool = False,
    faithful: bool = False,
) -> DataFrame:
    """CSV scan. A schema saves the extra pass over the files that ``infer`` costs.

    ``faithful`` is for files written so: texts are decoded, and a row that does not fit raises.
    """
    if schema is None and not infer:
        raise ValueError("give a schema, or ask for infer=True")
    reader = spark.read.options(header=header, sep=sep, **(FAITHFUL_FORM if faithful else CSV_FORM))
    if faithful:
        reader = reader.option("mode", "FAILFAST")
    rows = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
    return decoded_texts(rows) if faithful else rows


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet scan. ``merge_schema`` gives the union of the columns of all files."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_format(spark: SparkSession, path: str, fmt: str, **options: object) -> DataFrame:
    """Scan of any installed format by name, ``delta`` among them."""
    return spark.read.format(fmt).options(**options).load(path)


def read_json_lines(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """One JSON object per line; without a schema Spark infers one in an extra pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_images(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """Decoded images as an ``image`` struct; files that are no images are left out.

    For many folders of few files each: ``tasks`` tasks list them and at most so many read them, where Spark would
    take one for each folder (up to 10,000) or each 32 files. The names of the folders are not read as columns then.
    """
    reader = spark.read.format("image").option("dropInvalid", True)
    if tasks is None:
        return reader.load(path)
    before = spark.conf.get(LISTING_KEY, None)
    spark.conf.set(LISTING_KEY, tasks)
    try:  # the folders are listed here, not when the images are read
        images = reader.option("recursiveFileLookup", True).load(path)
    finally:
        spark.conf.unset(LISTING_KEY) if before is None else spark.conf.set(LISTING_KEY, before)
    return images.coalesce(tasks)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines of all text files that match ``path``."""
    return spark.read.text(path).where(F.length("value") > 0)


def frame_of(spark: SparkSession, rows: Iterable[Sequence], schema: Schema | list[str]) -> DataFrame:
    """In-memory rows as a DataFrame, for small literal inputs."""
    return spark.createDataFrame(list(rows), schema)


def typed(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a declared schema in its types; a value that does not fit raises."""
    fields = df.sparkSession.createDataFrame([], schema).schema
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in fields])


def stream_csv(
    spark: SparkSession,
    folder: str,
    schema: Schema,
    sep: str = ";",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Unbounded CSV folder without header rows. Streams cannot infer, so the schema is required."""
    reader = spark.readStream.schema(schema).option("sep", sep)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def view_of(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temp view and scan it again through SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(f"SELECT * FROM `{name}`")
