from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quillstream.functions.keys import content_id
from quillstream.plans import exploration
from quillstream.registry import inputs
from quillstream.scratch import scratch_dir, scratch_root
from quillstream.sources import files, queue, tables


def test_csv_keeps_quotes_delimiters_blanks_and_line_breaks(spark):
    rows = [("1", 'say "hi", ok\\', 0), ("2", "  edges  ", 1), ("3", "two\nlines", None)]
    path = scratch_dir(spark, "csv")
    files.write_csv(spark.createDataFrame(rows, "id string, tweet string, label int"), path)
    got = files.read_csv(spark, path, multi_line=True).collect()
    assert sorted(map(tuple, got)) == rows
    inferred = files.read_csv(spark, path, infer=True, multi_line=True)
    assert dict(inferred.dtypes)["label"] == "int"


def test_csv_columns_are_found_by_name(spark):
    path = scratch_dir(spark, "csv")
    rows = [("0", "fine", "7"), ("x", "misfit", "8"), (None, "no label", "9")]
    files.write_csv(spark.createDataFrame(rows, "label string, tweet string, extra string"), path)
    got = {r.tweet: (r.label, len(r.id)) for r in files.read_csv(spark, path).collect()}
    assert got == {"fine": (0, 64), "no label": (None, 64)}
    assert [(r.label, r.tweet) for r in files.csv_misfits(spark, path).collect()] == [("x", "misfit")]
    other = scratch_dir(spark, "csv")
    files.write_csv(spark.createDataFrame([("1", "t")], "id string, text string"), other)
    with pytest.raises(ValueError, match="tweet"):
        files.read_csv(spark, other)


def test_content_ids_do_not_run_together(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a|b|c", None), ("", "a|b|c"), (None, "a|b|c")]
    df = spark.createDataFrame(rows, "x string, y string").select(content_id("x", "y").alias("id"))
    assert df.distinct().count() == len(rows)


def test_messages_round_trip_through_a_queue_of_text_files(spark):
    posts = spark.createDataFrame(
        [("7", 'q "uote"\nline', "web", "2024-01-01T00:00:00.000Z")],
        "id string, text string, source string, created_at string")
    path = scratch_dir(spark, "queue")
    queue.publish(posts, fmt="text", path=path)
    queue.publish(posts.drop("id"), fmt="text", path=path)
    got = queue.to_posts(queue.decode(queue.read(spark, fmt="text", path=path))).collect()
    assert {r.tweet for r in got} == {'q "uote"\nline'}
    assert sorted(len(r.id) for r in got) == [1, 64]


def test_broken_messages_are_told_apart(spark):
    values = ['{"text":"ok","created_at":"t"}', '{"text":"cut', "", "null", "[1]", '{"id":"9"}', None]
    got = queue.decode(spark.createDataFrame([(v,) for v in values], "value string"))
    usable = got.filter(queue.is_usable()).collect()
    assert [(r.text, r.id) for r in usable] == [("ok", None)]
    assert got.count() == len(values)
    assert got.filter(~queue.is_usable()).count() == len(values) - 1


def test_kafka_options():
    options = queue.kafka_options("h:1", "posts", "u", "p")
    assert options["subscribe"] == "posts" and options["startingOffsets"] == "earliest"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert "topic" in queue.kafka_options("h:1", "posts", writing=True)


def test_recent_window_is_half_open(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          ('a', TIMESTAMP '2024-01-01 00:00:00', 'en', 'New York CITY'),
          ('b', TIMESTAMP '2024-01-01 00:15:00', 'en', 'new york city'),
          ('c', TIMESTAMP '2024-01-01 00:05:00', 'de', 'new york city'),
          ('d', TIMESTAMP '2023-12-31 23:59:59', 'en', 'new york city'),
          ('e', TIMESTAMP '2024-01-01 00:14:59', 'en', 'elsewhere') AS t(id, ts, lang, tweet)""")
    got = queue.select_recent(df, F.lit("2024-01-01 00:15:00").cast("timestamp"), "new york city")
    assert [r.id for r in got.collect()] == ["a"]
    assert [r.id for r in queue.cap_recent(df, 2).collect()] == ["b", "e"]
    lag = spark.range(1).select((F.current_timestamp() - queue.search_window_end()).cast("string"))
    assert "00:01:00" in lag.first()[0]


def test_sample_is_repeatable_and_seeded(spark):
    lines = spark.createDataFrame([('{"k%d": "t%d", "x%d": "y"}' % (i, i, i),) for i in range(50)],
                                  "value string").repartition(3)
    pairs = files.sample_pairs(lines)
    assert pairs.count() == 100
    first = [r.key for r in files.sample(pairs, 10, "s").collect()]
    assert first == [r.key for r in files.sample(pairs.repartition(7), 10, "s").collect()]
    assert first != [r.key for r in files.sample(pairs, 10, "other").collect()]
    path = scratch_dir(spark, "map")
    lines.write.text(path)
    assert files.read_sample_map(spark, path).count() == 100


def test_batch_overwrites_itself(spark):
    root = scratch_dir(spark, "t")
    df = spark.range(5)
    for _ in range(2):
        tables.write_batch(df, root, "x", 0)
    tables.write_batch(df, root, "x", 1)
    assert tables.read_table(spark, root, "x").count() == 10


def test_scratch_follows_the_session(spark):
    def session(master, **conf):
        context = SimpleNamespace(master=master, applicationId="x")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: conf.get(k, d)),
                               sparkContext=context)

    named = {"spark.checkpoint.dir": "/shared/work/"}
    assert scratch_root(session("yarn", **named)) == "/shared/work"
    with pytest.raises(RuntimeError):
        scratch_root(session("yarn"))
    assert scratch_root(spark) == scratch_root(spark)


@pytest.mark.parametrize("name,size", [("top_words", 40), ("top_hashtags", 10)])
def test_exploration_report(spark, sf_dir, name, size):
    train = inputs.labeled(spark, sf_dir).select("id", "tweet", "label")
    report = exploration.report(train, inputs.tweets(spark, sf_dir).select("id", "tweet"))
    assert 0 < report[name].count() <= size
    assert {r.table_name for r in report["shape_distinct"].collect()} == {"train", "test"}
    assert sum(r.percent for r in report["class_share"].collect()) == pytest.approx(100)
