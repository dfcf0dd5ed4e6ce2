"""Word and hashtag frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions import text as T


def explode_words(df: DataFrame, words: Column, carry: Sequence[str] = (),
                  name: str = "word") -> DataFrame:
    """One row per kept token of an unfiltered token array.

    Stop words are filtered after the explode, where the test is compiled with
    the rest of the stage; a filter inside the array would be interpreted.
    """
    return df.select(*carry, F.explode(words).alias(name)).filter(T.is_kept(F.col(name)))


def unigrams(df: DataFrame, cleaned: Column | str, carry: Sequence[str] = ()) -> DataFrame:
    """Cleaned text split on blanks.  Empty text gives one empty token."""
    return df.select(*carry, F.explode(F.split(cleaned, r"\s+")).alias("unigram"))


def vocabulary_size(df: DataFrame, cleaned: Column | str) -> DataFrame:
    """Total and distinct token counts from one grouped pass.

    Grouping by token first keeps the shuffle at one row per token per task; a
    plain distinct count beside a total would shuffle the same rows twice.
    """
    per_token = unigrams(df, cleaned).groupBy("unigram").agg(F.count(F.lit(1)).alias("n"))
    return per_token.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"),
        F.count(F.lit(1)).alias("distinct_words"),
    )


def frequencies(words: DataFrame, name: str, by: Sequence[str] = (),
                ordered: bool = False) -> DataFrame:
    """Counts per value (and per ``by``), optionally most frequent first.

    Counting merges inside each task first, so one hot word costs one row per task.
    """
    counted = words.groupBy(*by, name).agg(F.count(F.lit(1)).alias("frequency"))
    if ordered:
        counted = counted.orderBy(*by, F.desc("frequency"), F.asc(name))
    return counted


def word_frequency(df: DataFrame, text: Column | str, by: Sequence[str] = (),
                   ordered: bool = False) -> DataFrame:
    """Word counts over the exploratory cleaning of ``text``, all classes in one pass."""
    words = explode_words(df, T.eda_split_words(text), by)
    return frequencies(words, "word", by, ordered)


def model_word_frequency(df: DataFrame, text: Column | str, by: Sequence[str] = (),
                         ordered: bool = False) -> DataFrame:
    """Word counts over the model cleaning of ``text``."""
    return frequencies(explode_words(df, T.split_words(text), by), "word", by, ordered)


def hashtag_frequency(df: DataFrame, text: Column | str, by: Sequence[str] = (),
                      need_words: bool | Column = False, ordered: bool = False) -> DataFrame:
    """Hashtag counts.

    ``need_words`` skips posts whose cleaned text is empty: all of them, or
    those for which a condition holds.
    """
    if need_words is not False:
        has_words = F.exists(T.eda_split_words(text), T.is_kept)
        df = df.filter(has_words if need_words is True else ~need_words | has_words)
    tags = df.select(*by, F.explode(T.hashtags(text)).alias("hashtag"))
    return frequencies(tags, "hashtag", by, ordered)


def top(counted: DataFrame, name: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties go to the smaller value."""
    return counted.orderBy(F.desc("frequency"), F.asc(name)).limit(k)


def top_per_group(counted: DataFrame, name: str, k: int, by: str) -> DataFrame:
    """The ``k`` most frequent values of each group, from one pass over the counts.

    Spark applies the limit inside each task before it shuffles, so no task
    receives a whole group.
    """
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("frequency"), F.asc(name)))
    return counted.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def word_rows(scored: DataFrame) -> DataFrame:
    """One row per word of a scored post, with day key and predicted class.

    Expects ``tweet_wo_hashtag`` (cleaned), ``ts`` and ``prediction``.
    """
    from quillstream.functions.dates import day_key

    return scored.select(
        F.explode(F.split("tweet_wo_hashtag", r"\s+")).alias("word"),
        day_key(F.col("ts")).alias("time"),
        F.to_date("ts").alias("day"),
        "prediction",
    ).filter("word <> ''")


def daily_word_frequency(words: DataFrame) -> DataFrame:
    """Counts per day, class and word, from word rows."""
    return words.groupBy("day", "prediction", "word").agg(
        F.count(F.lit(1)).alias("frequency")
    )
