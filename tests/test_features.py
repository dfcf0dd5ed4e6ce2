import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillstream.functions import text as T
from quillstream.operators import features as feats
from quillstream.registry import inputs

TEXTS = ["red blue red", "blue green", "red", "", "green green green blue 7", "hot " * 50]


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(str(i), t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id string, tweet string").repartition(3)


def test_tfidf_terms_against_brute_force(spark, posts):
    docs = {str(i): [w for w in t.replace("7", "[num]").split()] for i, t in enumerate(TEXTS)}
    df = Counter(w for words in docs.values() for w in set(words))
    got = {(r.id, r.word): (r.tf, r.tfidf)
           for r in feats.tfidf_terms(posts, T.tokens("tweet")).collect()}
    want_keys = {(i, w) for i, words in docs.items() for w in words}
    assert set(got) == want_keys
    for (i, w), (tf, weight) in got.items():
        assert tf == docs[i].count(w)
        assert math.isclose(weight, tf * math.log((len(docs) + 1) / (df[w] + 1)))


def test_hashed_features_equal_terms_when_no_bucket_is_shared(spark, posts):
    cleaned = posts.select("id", T.clean("tweet").alias("tweet")).filter("tweet <> ''")
    vectors = feats.fit_features(cleaned).transform(cleaned)
    hashed = {r.id: sorted(round(float(v), 9) for v in r.features.values)
              for r in vectors.select("id", "features").collect()}
    terms = {}
    for r in feats.tfidf_terms(cleaned, F.split("tweet", " ")).collect():
        terms.setdefault(r.id, []).append(round(r.tfidf, 9))
    assert hashed == {k: sorted(v) for k, v in terms.items()}


def test_hot_word_and_rare_words_give_the_same_weights(spark):
    """One word is in every row; with a tiny broadcast bound the rest is shuffled."""
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("id"),
        F.concat(F.lit("hot w"), (F.col("id") % 97 + 100).cast("string"),
                 F.when(F.col("id") % 3 == 0, F.repeat(F.lit("x"), 300)).otherwise("")).alias("tweet"),
    )
    tokens = F.split("tweet", " ")
    plain = sorted(map(tuple, feats.tfidf_terms(rows, tokens).collect()))
    split = sorted(map(tuple, feats.tfidf_terms(rows, tokens, max_broadcast=3).collect()))
    assert len(plain) == 6000 and split == plain
    assert {t[3] for t in plain if t[1] == "hot"} == {0.0}


def test_split_is_disjoint_complete_and_stable(spark, sf_dir):
    rows = inputs.tweets(spark, sf_dir).select("id")
    train, test = feats.split(rows)
    train_ids = {r.id for r in train.collect()}
    test_ids = {r.id for r in test.collect()}
    assert not train_ids & test_ids
    assert len(train_ids) + len(test_ids) == rows.count()
    again, _ = feats.split(rows.repartition(5))
    assert {r.id for r in again.collect()} == train_ids


def test_weights_balance_classes(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,)], "label int")
    weighted = feats.class_weights(df).collect()
    assert {(r.label, round(r.weight, 6), r.no_weight) for r in weighted} == {
        (1, 0.8, 1.0), (0, 0.2, 1.0), (None, 0.2, 1.0)}
    two = feats.class_weights(df.na.drop()).groupBy("label").agg(F.sum("weight").alias("w"))
    sums = [r.w for r in two.collect()]
    assert math.isclose(sums[0], sums[1])


def test_ratio_comes_without_a_join(spark, posts):
    labelled = posts.withColumn("label", F.lit(1))
    plan = feats.class_weights(labelled)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_tasks_of_a_fit_do_not_grow_with_the_tokens():
    from quillstream.plans import training

    assert [training.tasks_of(n, 12) for n in (0, 600_000, 8_000_000, 400_000_000)] == [1, 2, 12, 12]
    # Very many tokens need more tasks to fit into memory.
    assert training.tasks_of(5_000_000_000, 12) == 100
