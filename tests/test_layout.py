"""What one task holds does not grow with the input."""

from collections import Counter

from pyspark.sql import functions as F

from quillstream.operators import layout
from quillstream.registry import queries as queries_module
from quillstream.streaming import jobs


def rows_of_tasks(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


def written(spark, path, rows):
    spark.range(0, rows, 1, 1).select("id", *[F.sha2(F.concat("id", F.lit(i)), 512).alias(f"t{i}") for i in range(8)]) \
        .write.parquet(path)
    return spark.read.parquet(path)


def test_a_batch_of_one_row_group_is_dealt_out(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        rows = written(spark, str(tmp_path / "rows"), 8000)
        # Many splits, one of which holds all rows.
        assert rows.rdd.getNumPartitions() >= 8 and rows_of_tasks(rows) == [8000]
        assert max(rows_of_tasks(layout.dealt_batch(rows))) < 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tasks_follow_the_size(spark, tmp_path):
    for name, rows in (("small", 4000), ("large", 16000)):
        df = written(spark, str(tmp_path / name), rows)
        placed = layout.dealt(df, "id", task_bytes=200_000)
        assert max(rows_of_tasks(placed)) < 600 and placed.count() == rows
    unknown = spark.createDataFrame(df.limit(5).rdd)
    assert layout.parts_for(unknown) is None and layout.dealt_batch(unknown).count() == 5


def test_files_of_a_stream_stay_small(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(queries_module, "FILE_BYTES", 20_000)
    path, files_per_batch = queries_module._shuffled_source(spark, sf_dir, copies=2)
    stored = spark.read.parquet(f"{path}/documents.parquet")
    n_files = len(stored.inputFiles())
    assert 8 < n_files <= 4 * files_per_batch
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert Counter(stored.collect()) == Counter({r: 2 * n for r, n in Counter(given.collect()).items()})


def test_daily_counts_of_any_number_of_segments(spark, tmp_path):
    counts = spark.createDataFrame([("2024-01-01", "hate", "a", 1), ("2024-01-01", "hate", "b", 2)], "day string, prediction string, word string, frequency bigint") \
        .withColumn("day", F.to_date("day"))
    for batch in range(4):
        jobs.segments.write(counts, f"{tmp_path}/daily_words", batch, jobs._summed)
        got = {r.word: r.frequency for r in jobs.read_daily_words(spark, str(tmp_path)).collect()}
        assert got == {"a": batch + 1, "b": 2 * (batch + 1)}
