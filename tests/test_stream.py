import time

import pytest
from pyspark.sql import functions as F

from quillstream import schemas
from quillstream.operators import frequency
from quillstream.plans import scoring, training
from quillstream.registry import inputs
from quillstream.scratch import scratch_dir
from quillstream.sources import queue, segments, tables
from quillstream.streaming import jobs

PARTS = 4


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    """The documents table in several files, so that a stream has several batches."""
    path = scratch_dir(spark, "split") + "/documents.parquet"
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartitionByRange(PARTS, "doc_id") \
        .write.parquet(path)
    return path.rsplit("/", 1)[0]


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return training.fit(training.prepare(inputs.labeled(spark, sf_dir)), num_features=2**10)


def stream(spark, source):
    return inputs.stream_tweets(spark, source, maxFilesPerTrigger=1)


def rows(df):
    return sorted(map(str, df.collect()))


def test_scored_stream_equals_batch_and_rerun_adds_nothing(spark, source, model):
    root = scratch_dir(spark, "scores")
    for _ in range(2):
        query = jobs.score_stream(inputs.posts(stream(spark, source)), model, root, f"{root}/cp")
        query.awaitTermination()
    result = scoring.predict(inputs.posts(inputs.tweets(spark, source)), model)
    assert rows(tables.read_table(spark, root, tables.CLEAN)) == rows(scoring.clean_table(result))
    assert rows(tables.read_table(spark, root, tables.WORDS)) == rows(scoring.word_table(result))
    assert rows(tables.read_table(spark, root, tables.FAILED)) == rows(scoring.failed_table(result))
    batches = spark.read.parquet(f"{root}/{tables.CLEAN}").select("batch").distinct().count()
    assert batches == PARTS


def test_replayed_batch_does_not_double(spark, source, model):
    root = scratch_dir(spark, "scores")
    result = scoring.predict(inputs.posts(inputs.tweets(spark, source)), model)
    for _ in range(2):
        scoring.write_results(result, root, 3)
    assert tables.read_table(spark, root, tables.CLEAN).count() == result.count()


def test_unreadable_time_is_set_aside(spark, model):
    posts = spark.createDataFrame(
        [("1", "fine words", "2024-01-01T00:00:00.000Z"), ("2", "other words", "2024-01-01"),
         ("3", None, "2024-01-01T00:00:00.000Z")], "id string, tweet string, time_stamp string")
    root = scratch_dir(spark, "scores")
    scoring.write_results(scoring.predict(posts, model), root, 0)
    assert [r.id for r in tables.read_table(spark, root, tables.CLEAN).collect()] == ["1"]
    assert [r.id for r in tables.read_table(spark, root, f"{tables.QUARANTINE}_time").collect()] == ["2"]


def test_ingest_sends_broken_messages_to_quarantine(spark, source):
    encoded = queue.encode(inputs.messages(inputs.tweets(spark, source)))
    path = scratch_dir(spark, "queue")
    encoded.repartition(PARTS).write.text(path)
    spark.createDataFrame([('{"text": "cut',), ("",)], "value string").write.mode("append").text(path)
    root = scratch_dir(spark, "ingest")
    for _ in range(2):
        messages = queue.read_stream(spark, fmt="text", path=path, maxFilesPerTrigger=2)
        jobs.ingest(messages, root, f"{root}/cp").awaitTermination()
    posts = tables.read_table(spark, root, "posts")
    assert rows(posts) == rows(inputs.posts(inputs.tweets(spark, source)))
    assert tables.read_table(spark, root, tables.QUARANTINE).count() == 2


def test_daily_words_over_several_batches_equal_batch(spark, source):
    root = scratch_dir(spark, "daily")
    for _ in range(2):
        query = jobs.daily_words(inputs.results(stream(spark, source)), root, f"{root}/cp")
        query.awaitTermination()
    batch = frequency.daily_word_frequency(
        scoring.word_table(inputs.results(inputs.tweets(spark, source))))
    assert rows(jobs.read_daily_words(spark, root)) == rows(batch)


def newest_first(spark, documents):
    """One file for each row, the newest in the first batch."""
    path = scratch_dir(spark, "backwards") + "/documents.parquet"
    for row in sorted(documents, key=lambda r: -r[0]):
        spark.createDataFrame([row], schemas.DOCUMENTS).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.1)
    return path.rsplit("/", 1)[0]


def test_rows_far_behind_are_kept(spark):
    documents = [(i, f"word{i} here", "en", "web", 10) for i in (9000, 1, 2)]
    source = newest_first(spark, documents)
    root = scratch_dir(spark, "late")
    jobs.daily_words(inputs.results(stream(spark, source)), root, f"{root}/cp").awaitTermination()
    batch = frequency.daily_word_frequency(scoring.word_table(inputs.results(inputs.tweets(spark, source))))
    assert rows(jobs.read_daily_words(spark, root)) == rows(batch)
    posts = inputs.timed(stream(spark, source)).select("id", "tweet", "ts")
    jobs.keep_once(posts, root, "posts", f"{root}/cp2").awaitTermination()
    assert sorted(r.id for r in jobs.read_once(spark, root, "posts").collect()) == ["1", "2", "9000"]


def test_redelivered_posts_are_kept_once_across_batches(spark, sf_dir):
    path = scratch_dir(spark, "twice") + "/documents.parquet"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _ in range(2):
        documents.coalesce(1).write.mode("append").parquet(path)
    source = path.rsplit("/", 1)[0]
    root = scratch_dir(spark, "once")
    posts = inputs.timed(stream(spark, source)).select("id", "tweet", "ts")
    jobs.keep_once(posts, root, "posts", f"{root}/cp").awaitTermination()
    got = jobs.read_once(spark, root, "posts")
    assert got.count() == documents.count()
    assert got.agg(F.count_distinct("id")).first()[0] == documents.count()


@pytest.mark.parametrize("files_at_once", [1, 4])
def test_redelivered_posts_with_another_time_are_kept_once(spark, files_at_once):
    path, root = scratch_dir(spark, "times"), scratch_dir(spark, "once")
    fields = "id string, tweet string, ts timestamp"
    one, two = "2024-01-01 10:00:00", "2024-02-02 10:00:00"
    for part in ([("a", one)], [("a", two), ("b", None)], [("b", one), ("c", two)], [("c", None), (None, one)]):
        spark.createDataFrame([(i, "post", t) for i, t in part], "id string, tweet string, ts string") \
            .withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(path)
    posts = spark.readStream.schema(fields).option("maxFilesPerTrigger", files_at_once).parquet(path)
    jobs.keep_once(posts, root, "posts", f"{root}/cp").awaitTermination()
    assert sorted(str(r.id) for r in jobs.read_once(spark, root, "posts").collect()) == ["None", "a", "b", "c"]


def test_unusable_rows_are_set_aside(spark, model):
    path = scratch_dir(spark, "bad")
    spark.createDataFrame(
        [("1", "fine", "2024-01-01T00:00:00.000Z"), ("2", None, "2024-01-01T00:00:00.000Z"),
         ("3", "no time", "soon")], "id string, tweet string, time_stamp string").write.parquet(path)
    posts = spark.readStream.schema("id string, tweet string, time_stamp string").parquet(path)
    root = scratch_dir(spark, "scores")
    jobs.score_stream(posts, model, root, f"{root}/cp").awaitTermination()
    ids = {t: [r.id for r in tables.read_table(spark, root, t).collect()]
           for t in (tables.CLEAN, f"{tables.QUARANTINE}_text", f"{tables.QUARANTINE}_time")}
    assert ids == {tables.CLEAN: ["1"], f"{tables.QUARANTINE}_text": ["2"], f"{tables.QUARANTINE}_time": ["3"]}


def test_an_empty_first_batch_and_history_that_is_never_read(spark):
    path, root = scratch_dir(spark, "empty"), scratch_dir(spark, "once")
    fields = "id string, tweet string"
    for part in ([("a", "left out")], [("a", "post"), (None, "post")], [("b", "post"), ("a", "post")], [(None, "post"), ("b", "post")]):
        spark.createDataFrame(part, fields).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.1)
    for _ in range(2):
        posts = spark.readStream.schema(fields).option("maxFilesPerTrigger", 1).parquet(path).filter("tweet <> 'left out'")
        query = jobs.keep_once(posts, root, "posts", f"{root}/cp")
        query.awaitTermination()
        last = query.lastProgress
    assert sorted(str(r.id) for r in jobs.read_once(spark, root, "posts").collect()) == ["None", "None", "a", "b"]
    # A later run finds what earlier ones have seen in its state, whatever happened to the table.
    spark.createDataFrame([("a", "post"), ("c", "post")], fields).coalesce(1).write.mode("append").parquet(path)
    posts = spark.readStream.schema(fields).parquet(path).filter("tweet <> 'left out'")
    query = jobs.keep_once(posts, f"{root}/elsewhere", "posts", f"{root}/cp")
    query.awaitTermination()
    assert [r.id for r in jobs.read_once(spark, f"{root}/elsewhere", "posts").collect()] == ["c"]
    assert query.lastProgress.stateOperators[0].numRowsTotal >= 3 and last is None or last.numInputRows <= 2


def test_bounded_memory_of_ids(spark):
    path, root = scratch_dir(spark, "bounded"), scratch_dir(spark, "once")
    for part in (["a", "b"], ["b", None], ["a", "c", None]):
        spark.createDataFrame([(i, "post") for i in part], "id string, tweet string").coalesce(1).write.mode("append").parquet(path)
    posts = spark.readStream.schema("id string, tweet string").option("maxFilesPerTrigger", 1).parquet(path)
    jobs.keep_once(posts, root, "posts", f"{root}/cp", remember="1 day").awaitTermination()
    assert sorted(str(r.id) for r in jobs.read_once(spark, root, "posts").collect()) == ["None", "None", "a", "b", "c"]


def test_segments_stay_few_and_survive_crashes(spark):
    root = scratch_dir(spark, "segments")
    total, crashes = {}, 0

    def merge(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"))

    def crash(rows):
        raise RuntimeError("lost between two steps")

    for batch in range(13):
        part = spark.createDataFrame([(batch % 3, batch + 1), (7, 1)], "k int, n bigint").coalesce(1)
        for key, n in ((batch % 3, batch + 1), (7, 1)):
            total[key] = total.get(key, 0) + n
        if batch in (3, 7, 8):
            try:
                segments.write(part, root, batch, crash)
            except RuntimeError:
                crashes += 1
            assert dict(merge(segments.read(spark, root, "k int, n bigint")).collect()) == total
        # The batch is delivered again after a crash, and sometimes without one.
        for _ in range(1 + batch % 2):
            segments.write(part, root, batch, merge)
        assert dict(merge(segments.read(spark, root, "k int, n bigint")).collect()) == total
        spans = segments.chosen(segments.complete(spark, root))
        assert len(spans) <= batch.bit_length() + 1 and spans[-1][1] == batch
    assert crashes == 2
    # Parts of merged segments are gone but for those of the last batch.
    assert len(segments.complete(spark, root)) <= len(spans) + 4
    assert segments.read(spark, scratch_dir(spark, "none"), "k int, n bigint").count() == 0


def test_longest_segments_are_chosen():
    assert segments.chosen([(0, 3), (0, 1), (0, 0), (1, 1), (2, 3), (4, 4), (6, 7), (6, 6)]) == [(0, 3), (4, 4), (6, 7)]


def test_scoring_inside_the_batch_equals_scoring_before(spark, source):
    root = scratch_dir(spark, "daily")
    jobs.daily_words(stream(spark, source), root, f"{root}/cp", inputs.results).awaitTermination()
    batch = frequency.daily_word_frequency(scoring.word_table(inputs.results(inputs.tweets(spark, source))))
    assert rows(jobs.read_daily_words(spark, root)) == rows(batch)
