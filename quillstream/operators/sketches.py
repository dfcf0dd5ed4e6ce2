"""Stored summaries of words per day and class that can be merged over any range.

A row holds two sketches of bounded size: distinct words (HLL, 2**14 registers, standard error
0.8 %), and frequent words (at most ``TRACKED`` words; an estimated count is at most
``words * 3.5 / TRACKED`` above the true one, so every word above that is found).  Days,
classes and batches are united later without reading a word again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 14
TRACKED = 20_000


def word_sketches(words: DataFrame, by: Sequence[str] = ("day", "prediction")) -> DataFrame:
    """One row per group of word rows (``word``): ``n_words`` and both sketches.

    Sketches are built inside the tasks and merged by the grouping, so a hot group moves one
    row of bounded size for each task.
    """
    return words.groupBy(*by).agg(
        F.count("word").alias("n_words"),
        F.hll_sketch_agg("word", LG_REGISTERS).alias("distinct_sketch"),
        F.expr(f"approx_top_k_accumulate(word, {TRACKED})").alias("top_sketch"))


def _grouped(sketches: DataFrame, by: Sequence[str]):
    """Groups for uniting; without a key, one group of all rows: a task that has no rows must not
    send an empty sketch, which the union of frequent words cannot read."""
    return sketches.groupBy(*by) if by else sketches.groupBy(F.lit(0).alias("_all"))


def distinct_words(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Estimated number of different words over the stored rows of each group."""
    return _grouped(sketches, by).agg(
        F.sum("n_words").alias("n_words"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_words")).drop("_all")


def top_words(sketches: DataFrame, k: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` words with the largest estimated counts of each group, equal ones in the order of
    words, with ``max_error`` of any count."""
    # Twice as many, so that words of equal count are settled here.
    united = _grouped(sketches, by).agg(F.sum("n_words").alias("_n"), F.expr(
        f"approx_top_k_estimate(approx_top_k_combine(top_sketch, {TRACKED}), {2 * k})").alias("_top"))
    listed = F.transform("_top", lambda x: F.struct((-x["count"]).alias("minus"), x["item"].alias("word")))
    return united.select(
        *by, F.explode(F.slice(F.array_sort(listed), 1, k)).alias("_x"), F.ceil(F.col("_n") * 3.5 / TRACKED).alias("max_error"),
    ).select(*by, F.col("_x.word").alias("word"), (-F.col("_x.minus")).alias("frequency"), "max_error")
