from collections import Counter

from pyspark.sql import functions as F

from quillstream.functions import text as T
from quillstream.operators import frequency

POSTS = [
    (0, "good good day #sun #sun"), (0, "#sun"), (1, "bad day #rain"), (1, "#rain #sun the"),
    (1, None), (0, ""),
]


def test_words_and_tags_by_class(spark):
    df = spark.createDataFrame(POSTS, "label int, t string")
    words = {(r.label, r.word): r.frequency
             for r in frequency.word_frequency(df, "t", ("label",)).collect()}
    assert words == {(0, "good"): 2, (0, "day"): 1, (1, "bad"): 1, (1, "day"): 1}
    tags = {(r.label, r.hashtag): r.frequency
            for r in frequency.hashtag_frequency(df, "t", ("label",)).collect()}
    assert tags == {(0, "sun"): 3, (1, "rain"): 2, (1, "sun"): 1}
    worded = {r.hashtag: r.frequency
              for r in frequency.hashtag_frequency(df, "t", need_words=True).collect()}
    assert worded == {"sun": 2, "rain": 1}


def test_ties_go_to_the_smaller_word(spark):
    df = spark.createDataFrame([("pear fig apple",)], "t string")
    top = frequency.top(frequency.word_frequency(df, "t"), "word", 2).collect()
    assert [r.word for r in top] == ["apple", "fig"]


def test_order_is_by_count_then_word(spark):
    df = spark.createDataFrame([("b b a a c c c d",)], "t string").select(F.lit(1).alias("k"), "t")
    got = frequency.word_frequency(df, "t", ("k",), ordered=True).collect()
    assert [(r.word, r.frequency) for r in got] == [("c", 3), ("b", 2)]  # a and d are stop words


def test_vocabulary_counts_empty_text_once_per_post(spark):
    df = spark.createDataFrame([("x y x",), ("",), ("the",)], "t string")
    row = frequency.vocabulary_size(df, T.clean("t")).first()
    assert (row.total_words, row.distinct_words) == (4 if "y" in T.STOP_WORDS else 5, 2)


def test_word_rows_and_daily_counts(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          ('one two one', TIMESTAMP '2022-01-11 05:00:00', 'hate'),
          ('one', TIMESTAMP '2022-11-01 05:00:00', 'hate'),
          ('', TIMESTAMP '2022-11-01 05:00:00', 'hate') AS t(tweet_wo_hashtag, ts, prediction)""")
    words = frequency.word_rows(df)
    # The unpadded key mixes both days; the real date keeps them apart.
    assert {r.time for r in words.collect()} == {"2022111"}
    daily = Counter({(str(r.day), r.word): r.frequency
                     for r in frequency.daily_word_frequency(words).collect()})
    assert daily == {("2022-01-11", "one"): 2, ("2022-01-11", "two"): 1, ("2022-11-01", "one"): 1}


def test_top_per_group_breaks_ties_by_word(spark):
    rows = [(g, f"w{i}", i % 4) for g in (0, 1) for i in range(200)]
    counted = spark.createDataFrame(rows, "label int, word string, frequency long").repartition(6)
    got = frequency.top_per_group(counted, "word", 3, "label").collect()
    best = sorted(f"w{i}" for i in range(200) if i % 4 == 3)[:3]
    for label in (0, 1):
        assert sorted(r.word for r in got if r.label == label) == best
