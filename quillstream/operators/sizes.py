"""Joins that broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.scratch import scratch_dir

# Most rows a broadcast side may have, and the longest key among them: at most
# some 150 MB in every executor.
MAX_ROWS = 500_000
MAX_KEY_LENGTH = 256


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    The work behind it is done once, its size is known from here on, and a lost
    executor costs no recomputation.  ``options`` go to the writer.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_by_word(rows: DataFrame, words: DataFrame, key: str, weight: str,
                 max_rows: int = MAX_ROWS) -> DataFrame:
    """Inner join of many rows with a stored table of one row per key.

    ``weight`` counts the ``rows`` of each key.  If the weights sum to ``s``, at
    most ``max_rows`` keys can weigh ``s / max_rows`` or more: those frequent
    keys are broadcast, which keeps most rows (and every hot key of ordinary
    length) out of the shuffle.  The remaining rows are few per key and are
    joined by shuffling.
    """
    total, n = words.agg(F.coalesce(F.sum(weight), F.lit(0)), F.count(F.lit(1))).first()
    least = 0 if n <= max_rows else -(-total // max_rows)
    is_hot = (F.col(weight) >= least) & (F.length(key) <= MAX_KEY_LENGTH)
    hot = rows.join(F.broadcast(words.filter(is_hot)), key)
    if words.filter(~is_hot).isEmpty():
        return hot
    left_over = rows.join(F.broadcast(words.filter(is_hot).select(key)), key, "left_anti")
    return hot.unionByName(left_over.join(words.filter(~is_hot), key))
