"""Input layout."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame


# Largest input that may be dealt out anew.
MAX_BYTES = 1 << 30


# Estimated bytes of files behind one task, and most tasks that an estimate may ask for.
TASK_BYTES = 8 << 20
MAX_TASKS = 20_000
# Spark's estimate for rows of which it knows nothing lies far above this.
UNKNOWN_BYTES = 1 << 60


def parts_for(df: DataFrame, task_bytes: int = TASK_BYTES) -> int | None:
    """Number of tasks with ``task_bytes`` of input each, as Spark estimates it; None without an estimate."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return None if size >= UNKNOWN_BYTES else max(1, min(MAX_TASKS, ceil(size / task_bytes)))


def dealt(df: DataFrame, *keys: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``df`` dealt out by ``keys`` to as many tasks as its size needs.

    What one task holds then does not grow with the input, where a fixed number of partitions
    or merged ones would.  A small or unknown input keeps the usual number.
    """
    parts = parts_for(df, task_bytes)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if parts is None or parts <= cores:
        return df.repartition(*keys)
    return df.repartition(parts, *keys)


def dealt_batch(batch: DataFrame) -> DataFrame:
    """A micro-batch in tasks of bounded size, over all cores.

    Partitions say little about a batch of files: a file may be one row group, and then one of
    its splits holds all rows and the others none.  So a batch of known size is always
    dealt out; one of unknown size (a queue) only when it has few partitions.
    """
    parts = parts_for(batch)
    if parts is None:
        return spread(batch)
    return batch.repartition(max(parts, batch.sparkSession.sparkContext.defaultParallelism))


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over idle cores before costly per-row work.

    A single-file, single-row-group table or a queue with few partitions reads as
    few tasks.  An input that already has a partition per core is returned
    untouched, and so is one estimated above ``MAX_BYTES``: a large table is never
    shuffled here.  Meant for scans and micro-batches: asking a plan with shuffles for
    its partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > MAX_BYTES or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
