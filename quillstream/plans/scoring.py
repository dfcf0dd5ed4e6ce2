"""Scoring: posts to results, word rows and low-confidence posts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import text as T
from quillstream.functions.dates import parse_stamp
from quillstream.operators import features as feats
from quillstream.operators import frequency, predictions
from quillstream.sources import tables


def clean_posts(posts: DataFrame) -> DataFrame:
    """Posts with both cleaned texts; the raw text stays in ``raw_tweet``.

    Most posts carry no hashtag, and their second cleaned text is the first one.
    """
    raw = F.col("raw_tweet")
    return (
        posts.filter("tweet IS NOT NULL")
        .select("id", F.col("tweet").alias("raw_tweet"), "time_stamp")
        .withColumn("tweet", T.clean(raw))
        .select(
            "id", "raw_tweet",
            F.when(raw.contains("#"), T.clean_no_hashtag(raw)).otherwise(F.col("tweet"))
            .alias("tweet_wo_hashtag"),
            "tweet", "time_stamp",
        )
    )


def score(cleaned: DataFrame, model: PipelineModel, idf: str = "saved") -> DataFrame:
    """Apply a fitted pipeline.

    ``idf="refit"`` takes document frequencies from this batch instead of the
    training rows; it needs a bounded batch and makes scores depend on it.
    """
    if idf == "saved":
        return model.transform(cleaned)
    if idf != "refit":
        raise ValueError("idf must be 'saved' or 'refit'")
    tokenizer, counts, _, classifier = model.stages
    counted = counts.transform(tokenizer.transform(cleaned))
    return classifier.transform(feats.idf().fit(counted).transform(counted))


def results(scored: DataFrame) -> DataFrame:
    """Result rows, with the raw text and the parsed time beside them."""
    keep = (*predictions.RESULT_COLUMNS, "raw_tweet")
    return predictions.format_predictions(scored, keep).withColumn(
        "ts", parse_stamp(F.col("time_stamp"))
    )


def predict(posts: DataFrame, model: PipelineModel, idf: str = "saved") -> DataFrame:
    """Posts to result rows: clean, score, format."""
    return results(score(clean_posts(posts), model, idf))


def clean_table(result: DataFrame) -> DataFrame:
    return result.filter("ts IS NOT NULL").select(
        "id", "tweet", "tweet_wo_hashtag", F.col("ts").alias("time_stamp"),
        "prediction", "confidence_score",
    )


def word_table(result: DataFrame) -> DataFrame:
    return frequency.word_rows(result.filter("ts IS NOT NULL"))


def failed_table(result: DataFrame) -> DataFrame:
    return predictions.low_confidence(result.drop("ts"))


def write_results(result: DataFrame, root: str, batch_id: int) -> None:
    """Write the three result tables and set aside rows with an unreadable time.

    Scoring is kept while the tables are written, so it runs once per batch.
    """
    result = result.persist()
    try:
        tables.write_batch(clean_table(result), root, tables.CLEAN, batch_id)
        tables.write_batch(word_table(result), root, tables.WORDS, batch_id)
        tables.write_batch(failed_table(result), root, tables.FAILED, batch_id)
        tables.write_batch(
            result.filter("ts IS NULL").select("id", "raw_tweet", "time_stamp"),
            root, f"{tables.QUARANTINE}_time", batch_id,
        )
    finally:
        result.unpersist()
