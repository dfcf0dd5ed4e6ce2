"""Streams from the queue to the result tables.

Every job runs once over the backlog (``availableNow``) and resumes from its
checkpoint, so a scheduler can start it as often as it likes.  Batches are
delivered at least once; sinks overwrite by batch id.  A checkpoint and the
tables it feeds belong together: a new checkpoint needs a new table root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillstream.operators.layout import dealt, dealt_batch
from quillstream.plans import scoring
from quillstream.sources import files, queue, segments, tables

DAILY = ("day", "prediction", "word")
# Bytes of stored counts that one task sums.
SEGMENT_TASK_BYTES = 4 << 20
DAILY_SCHEMA = "day date, prediction string, word string, frequency bigint"


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
           mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest(messages: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Decode messages into a ``posts`` table; broken ones go to quarantine."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            tables.write_batch(
                queue.to_posts(batch.filter(queue.is_usable())), root, "posts", batch_id
            )
            tables.write_batch(
                batch.filter(~queue.is_usable()), root, tables.QUARANTINE, batch_id
            )
        finally:
            batch.unpersist()

    return _start(queue.decode(messages), handle, checkpoint)


def score_stream(posts: DataFrame, model: PipelineModel, root: str, checkpoint: str,
                 idf: str = "saved") -> StreamingQuery:
    """Clean and score posts, then write scored posts, word rows and low-confidence posts.

    Posts without a text go to ``quarantine_text``, those without a readable time to
    ``quarantine_time``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(
            batch.filter("tweet IS NULL"), root, f"{tables.QUARANTINE}_text", batch_id
        )
        scoring.write_results(scoring.predict(dealt_batch(batch), model, idf), root, batch_id)

    return _start(posts, handle, checkpoint)


def score_queue(messages: DataFrame, model: PipelineModel, root: str, checkpoint: str,
                demo: Callable[[], DataFrame] | None = None, idf: str = "saved") -> StreamingQuery:
    """From queue messages to the result tables in one job.

    Messages are decoded once; broken ones go to quarantine, the others are cleaned and scored.
    ``demo`` gives posts that join every batch, such as ``files.demo_posts`` of a sample.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = dealt_batch(batch).persist()
        try:
            tables.write_batch(batch.filter(~queue.is_usable()), root, tables.QUARANTINE, batch_id)
            posts = queue.to_posts(batch.filter(queue.is_usable()))
            if demo is not None:
                posts = files.with_demo(posts, demo())
            scoring.write_results(scoring.predict(posts, model, idf), root, batch_id)
        finally:
            batch.unpersist()

    return _start(queue.decode(messages), handle, checkpoint)


def keep_once(posts: DataFrame, root: str, table: str, checkpoint: str,
              remember: str | None = None) -> StreamingQuery:
    """Write every post once, however often and in whatever order it is delivered.

    Posts (``id``, ...) are compared by id alone, so a redelivered post may carry another time
    or none.  The ids seen so far are keyed state: a batch looks up its own ids and reads
    nothing that is already stored, so its cost does not grow with the table, and an empty
    batch is a batch like any other.  State holds one key for each id and lies in RocksDB (see
    ``session``).  With ``remember``, such as "30 days", an id is forgotten that long after
    its arrival and state stays bounded; arrival is the clock, so no post is ever too late.
    Posts without an id cannot be told apart and are all kept.  The number of shuffle
    partitions at the first start is the number of state partitions for good.
    """
    keyed = posts.withColumn("_apart", F.when(F.col("id").isNull(), F.uuid()))
    if remember is None:
        once = keyed.dropDuplicates(["id", "_apart"])
    else:
        once = keyed.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", remember) \
            .dropDuplicatesWithinWatermark(["id", "_apart"]).drop("_arrival")
    return append(once.drop("_apart"), root, table, checkpoint)


def read_once(spark, root: str, table: str) -> DataFrame:
    """The posts that ``keep_once`` has stored."""
    return tables.read_table(spark, root, table)


def daily_words(posts: DataFrame, root: str, checkpoint: str,
                results: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Word counts per day and class, from a stream of scored posts (``ts`` parsed).

    ``results`` turns a batch of posts into scored ones, where the stream is not scored yet; it
    then runs once, on a batch spread over idle cores.  Each batch stores the counts of its
    own posts as a segment, and segments are merged as they add up (``segments``): exact in
    any order of arrival, and a replay overwrites itself.  Posts without a readable time go
    to ``quarantine_time``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        scored = (results(dealt_batch(batch)) if results else batch).select(
            "id", "raw_tweet", "time_stamp", "ts", "prediction", "tweet_wo_hashtag").persist()
        try:
            words = scored.filter("ts IS NOT NULL").select(
                F.to_date("ts").alias("day"), "prediction",
                F.explode(F.split("tweet_wo_hashtag", r"\s+")).alias("word"),
            ).filter("word <> ''")
            counts = words.groupBy(*DAILY).agg(F.count(F.lit(1)).alias("frequency"))
            segments.write(counts, f"{root}/daily_words", batch_id, _summed)
            tables.write_batch(
                scored.filter("ts IS NULL").select("id", "raw_tweet", "time_stamp"),
                root, f"{tables.QUARANTINE}_time", batch_id)
        finally:
            scored.unpersist()

    return _start(posts, handle, checkpoint)


def _summed(counts: DataFrame) -> DataFrame:
    # Stored counts are small in files and large in a hash table, and few of them merge inside a
    # split: they are placed by key first, in tasks of bounded size.
    return dealt(counts, *DAILY, task_bytes=SEGMENT_TASK_BYTES).groupBy(*DAILY).agg(F.sum("frequency").alias("frequency"))


def read_daily_words(spark, root: str) -> DataFrame:
    """Total of every group over all batches."""
    rows = segments.read(spark, f"{root}/daily_words", DAILY_SCHEMA)
    # One segment is summed already.
    return rows if segments.count(spark, f"{root}/daily_words") == 1 else _summed(rows)


def append(stream: DataFrame, root: str, table: str, checkpoint: str) -> StreamingQuery:
    """Write a stream to a table, one folder per batch."""
    return _start(
        stream, lambda batch, batch_id: tables.write_batch(batch, root, table, batch_id), checkpoint
    )

