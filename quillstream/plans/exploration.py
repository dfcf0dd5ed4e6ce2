"""Exploratory report over labelled posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import text as T
from quillstream.operators import frequency, profile


def describe_posts(df: DataFrame, text: str = "tweet") -> DataFrame:
    """Adds hashtags, cleaned text and their counts.

    The counts as first defined are 1 for empty text; ``n_hashtags`` and
    ``n_words`` are the true ones.
    """
    return (
        df.withColumn("Hashtags", T.hashtag_text(text))
        .withColumn("CleanTweet", T.clean_eda(text))
        .withColumn("HashtagsCount", T.split_count("Hashtags"))
        .withColumn("TweetWordCount", T.split_count("CleanTweet"))
        .withColumn("n_hashtags", F.size(T.hashtags(text)))
        .withColumn("n_words", T.word_count("CleanTweet"))
    )


def report(train: DataFrame, test: DataFrame, n_words: int = 20,
           n_tags: int = 5) -> dict[str, DataFrame]:
    """The exploratory tables by name; each is lazy."""
    train_rows = profile.drop_nulls(
        profile.drop_duplicates(train, ["tweet", "label"], "id"), ["tweet", "label"]
    )
    test_rows = profile.drop_nulls(profile.drop_duplicates(test, ["tweet"], "id"), ["tweet"])
    words = frequency.word_frequency(train_rows, "tweet", ("label",))
    tags = frequency.hashtag_frequency(
        train_rows, "tweet", ("label",), need_words=F.col("label") == 1
    )
    return {
        "shape": profile.shapes({"train": train, "test": test}),
        "shape_distinct": profile.shapes({"train": train_rows, "test": test_rows}),
        "duplicates_train": profile.duplicate_total(train, ["tweet", "label"]),
        "duplicates_test": profile.duplicate_total(test, ["tweet"]),
        "class_share": profile.class_share(train_rows),
        "top_words": frequency.top_per_group(words, "word", n_words, "label"),
        "top_hashtags": frequency.top_per_group(tags, "hashtag", n_tags, "label"),
    }
