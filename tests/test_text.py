import random
import re

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from quillstream.functions import text as T

EDGE = [
    None, "", " ", "plain words here", "3.14 and 1,000", "abc123def 45", "A.B@C.com",
    "HTTP://Up.case", "don't you're &amp; amp AMP", "x#http://q w", "Hello World",
    "a http://x b", "http://x\x1cy z", "http://x\x85y", "http\x0bq w", "tab\tnew\nline",
    "\U0001f600 smile \U0001f600", "٣٤ digits", "me@b.c9x@d.ee rest", "a@b.c@d.ee",
    "#tag#other text #", "#" + "x" * 60, "@me@you hi", "@#tag", "#@me", "a#t@b.c",
    "@@double", "x@y", "one  two   one", "KK İ", "under_score-dash",
    "a" * 3000 + " tail", "a.b-c+d_e@f.g-h.ij next",
]


def small_clean(text):
    text = re.sub(r"http\S+", "", text)
    text = re.sub(r"[a-z0-9.\-+_]+@[a-z0-9.\-+_]+\.[a-z]+", "", text)
    words = [re.sub("[0-9]+", "[num]", w).lower() for w in re.findall("[A-Za-z0-9]+", text)]
    return " ".join(w for w in words if w not in T.STOP_WORDS)


def small_eda(text):
    bare = re.sub("#[A-Za-z0-9_]+", "", re.sub("@[A-Za-z0-9_]+", "", text))
    return " ".join(w for w in re.findall("[a-z]+", bare) if w not in T.STOP_WORDS)


def random_texts(n, seed):
    rng = random.Random(seed)
    pieces = ["http", "https://a.b/c", "x@y.zz", "a.b@c.d9e@f.gh", "#tag_1", "@me", "the", "THE", "don't",
              "12", "3.5", "ab12cd", "amp", "&amp;", "Word", "é", " ", "\x1d", "\t", "\n", ".", "-",
              "_", "+", "@", "#", " ", "  ", "z", "Q", "\U0001f600", "٥"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def run(spark, texts, **columns):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(4)
    return {r.i: r for r in df.select("i", *[c.alias(n) for n, c in columns.items()]).collect()}


def test_cleaners_equal_small_versions(spark):
    texts = EDGE + random_texts(4000, 11)
    got = run(spark, texts, clean=T.clean("t"), bare=T.clean_no_hashtag("t"), eda=T.clean_eda("t"),
              tags=T.hashtag_text("t"))
    for i, text in enumerate(texts):
        if text is None:
            assert (got[i].clean, got[i].bare, got[i].eda) == (None, None, None)
            continue
        assert got[i].clean == small_clean(text), repr(text)
        assert got[i].bare == small_clean(re.sub("#[A-Za-z0-9_]+", "", text)), repr(text)
        assert got[i].eda == small_eda(text), repr(text)
        assert got[i].tags == " ".join(re.findall("#([a-zA-Z0-9_]{1,50})", text)), repr(text)


def test_golden(spark):
    golden = {
        "3.14 and 1,000": "[num] [num] [num] [num]",
        "abc123def 45": "abc[num]def [num]",
        "A.B@C.com": "b c com",
        "HTTP://Up.case": "http case",
        "don't you're &amp; amp AMP": "",
        "x#http://q w": "x w",
    }
    got = run(spark, list(golden), clean=T.clean("t"))
    assert [got[i].clean for i in range(len(golden))] == list(golden.values())
    got = run(spark, ["Hello World"], eda=T.clean_eda("t"), low=T.clean_eda("t", lower_first=True))
    assert (got[0].eda, got[0].low) == ("ello orld", "hello world")


def test_no_stop_word_or_double_blank_remains(spark):
    got = run(spark, random_texts(1000, 5), clean=T.clean("t"))
    for row in got.values():
        assert "  " not in row.clean and row.clean == row.clean.strip()
        assert not set(row.clean.split(" ")) & (set(T.STOP_WORDS))


def test_cleaning_twice_differs(spark):
    df = spark.createDataFrame([("7 cats",)], "t string").select(T.clean("t").alias("t"))
    assert df.select(T.clean("t")).first()[0] == "num cats"


def test_counts(spark):
    got = run(spark, ["", "a b", None], old=T.split_count("t"), new=T.word_count("t"))
    assert [(got[i].old, got[i].new) for i in range(3)] == [(1, 0), (2, 2), (None, None)]


def test_stop_words_against_spark_list(spark):
    listed = set(T.STOP_WORDS)
    assert len(T.STOP_WORDS) == len(listed) == 180
    default = set(StopWordsRemover.loadDefaultStopWords("english"))
    assert "amp" in listed - default and "would" in default - listed


def test_predefined_classes_equal_bracketed_ones(spark):
    every = "".join(chr(c) for c in range(1, 0x250))
    df = spark.createDataFrame([(every,)], "t string")
    for short, long in ((T.NOT_ALNUM, "[^a-zA-Z0-9]+"), (T.NOT_LOWER, "[^a-z]+"),
                        (T.HASHTAG, "#[A-Za-z0-9_]+"), (T.DIGITS, "[0-9]+")):
        row = df.select(F.regexp_replace("t", short, "-"), F.regexp_replace("t", long, "-")).first()
        assert row[0] == row[1]
