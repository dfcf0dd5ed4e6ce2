"""Labelled and unlabelled posts from files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillstream import schemas
from quillstream.functions.dates import now_stamp
from quillstream.functions.keys import content_id


def read_csv(spark: SparkSession, path: str, schema: StructType = schemas.TRAIN,
             delimiter: str = ",", infer: bool = False, multi_line: bool = False) -> DataFrame:
    """CSV with a header line: the columns of ``schema``, found by name in any order.

    A missing column is an error, but for ``id``, which is then derived from the content.
    Rows with a value that does not fit its type are left to ``csv_misfits``.
    ``infer=True`` returns all columns with guessed types, for one more pass.  Files whose
    fields hold line breaks need ``multi_line``; they cannot be split, so one file is
    one task.
    """
    if infer:
        return _csv_reader(spark, delimiter, multi_line).option("inferSchema", True).csv(path)
    raw, typed = _by_header(spark, path, schema, delimiter, multi_line)
    return raw.filter(~_misfit(typed)).select(*[c.alias(n) for n, (_, c) in typed.items()])


def csv_misfits(spark: SparkSession, path: str, schema: StructType = schemas.TRAIN,
                delimiter: str = ",", multi_line: bool = False) -> DataFrame:
    """The rows that ``read_csv`` leaves out, as text: for a quarantine table."""
    raw, typed = _by_header(spark, path, schema, delimiter, multi_line)
    return raw.filter(_misfit(typed))


def _misfit(typed: dict) -> Column:
    lost = [source.isNotNull() & value.isNull() for source, value in typed.values()]
    return reduce(lambda a, b: a | b, lost)


def _by_header(spark, path, schema, delimiter, multi_line):
    """All columns as text, and (source, typed value) of each wanted column."""
    raw = _csv_reader(spark, delimiter, multi_line).csv(path)
    missing = [f.name for f in schema if f.name not in raw.columns and f.name != "id"]
    if missing:
        raise ValueError(f"{path} has no column {missing}; it has {raw.columns}")
    typed = {}
    for field in schema:
        if field.name in raw.columns:
            source = F.col(f"`{field.name}`")
            typed[field.name] = (source, source.try_cast(field.dataType))
        else:
            others = [F.col(f"`{f.name}`") for f in schema if f.name != "id"]
            typed[field.name] = (content_id(*others),) * 2
    return raw, typed


def _csv_reader(spark, delimiter, multi_line):
    return (
        spark.read.option("header", True)
        .option("delimiter", delimiter)
        .option("multiLine", multi_line)
        .option("escape", '"')
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line; blanks at field edges are kept."""
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_sample_map(spark: SparkSession, path: str) -> DataFrame:
    """Key/text pairs from JSON objects ``{key: text, ...}``, one object per line.

    A sample set of any size is a set of such lines, so no task holds it whole.
    """
    return sample_pairs(spark.read.text(path))


def sample_pairs(lines: DataFrame) -> DataFrame:
    """Key/text pairs from a ``value`` column of JSON objects."""
    return lines.select(
        F.explode(F.from_json("value", "map<string,string>")).alias("key", "text")
    )


def sample(pairs: DataFrame, k: int = 100, seed: str = "") -> DataFrame:
    """``k`` pairs without replacement, the same ones for the same seed (a top-k by hash)."""
    return pairs.orderBy(F.md5(F.concat("key", F.lit(seed))), "key").limit(k)


def demo_posts(pairs: DataFrame, k: int = 100, seed: str = "") -> DataFrame:
    """Sampled texts as posts with a stable id and the current time."""
    return sample(pairs, k, seed).select(
        content_id(F.col("key"), F.col("text")).alias("id"),
        F.col("text").alias("tweet"),
        now_stamp().alias("time_stamp"),
    )


def with_demo(posts: DataFrame, demo: DataFrame) -> DataFrame:
    """Batch of posts followed by demo posts."""
    return posts.unionByName(demo)
