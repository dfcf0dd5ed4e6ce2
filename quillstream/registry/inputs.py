"""Posts, labels and scores derived from the given tables.

The given tables hold documents rather than short posts; each whole text gets a
hashtag for its source and language, a mention, a link and an HTML entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream import schemas
from quillstream.functions.dates import format_stamp, parse_stamp
from quillstream.operators.layout import spread
from quillstream.plans import scoring


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_tweets(documents: DataFrame) -> DataFrame:
    key = F.col("doc_id").cast("string")
    tweet = F.concat(
        F.col("text"), F.lit(" #"), F.col("source"), F.lit(" #"), F.col("lang"),
        F.lit(" @user"), (F.col("doc_id") % 10).cast("string"),
        F.lit(" http://t.co/"), key, F.lit(" &amp;"),
    )
    stamp = format_stamp(F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60))
    return documents.select(
        key.alias("id"), tweet.alias("tweet"), stamp.alias("created_at"), "lang", "source"
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id``, ``tweet``, ``created_at``, ``lang``, ``source``: one row per document."""
    return _as_tweets(documents(spark, sf_dir))


def stream_tweets(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The same rows as a stream over the documents table."""
    stream = (
        spark.readStream.schema(schemas.DOCUMENTS)
        .options(**options)
        .parquet(f"{sf_dir}/[d]ocuments.parquet")
    )
    return _as_tweets(stream)


def posts(tweet_rows: DataFrame) -> DataFrame:
    return tweet_rows.select("id", "tweet", F.col("created_at").alias("time_stamp"))


def timed(tweet_rows: DataFrame) -> DataFrame:
    return tweet_rows.withColumn("ts", parse_stamp(F.col("created_at")))


def messages(tweet_rows: DataFrame) -> DataFrame:
    """Rows in the shape a producer holds them."""
    return tweet_rows.select("id", F.col("tweet").alias("text"), "source", "created_at")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id``, ``label`` (toxic) and ``quality`` per labelled document."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"), F.col("toxic").alias("label"), "quality"
    )


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with a label."""
    return tweets(spark, sf_dir).join(
        annotations(spark, sf_dir).select("id", "label"), "id"
    )


def labeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``text``, ``label``: every document, label null where none was given."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return documents(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id", "left")


def _chance(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def scored(tweet_rows: DataFrame) -> DataFrame:
    """Posts with a stand-in probability taken from a hash of the id.

    It has the shape of classifier output, and SQL can compute the same values,
    so everything after the classifier can be checked exactly.
    """
    cleaned = scoring.clean_posts(posts(tweet_rows))
    chance = _chance(F.col("id"))
    return cleaned.withColumn("probability", F.array(1.0 - chance, chance)).withColumn(
        "prediction", F.when(chance > 0.5, 1.0).otherwise(0.0)
    )


def results(tweet_rows: DataFrame) -> DataFrame:
    """``scored`` rows in result form, with the parsed time."""
    return scoring.results(scored(tweet_rows))
