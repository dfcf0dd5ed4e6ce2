import random
from collections import Counter

from quillstream.operators import sketches


def word_table(spark):
    rng = random.Random(4)
    rows = [(f"2024-01-{1 + rng.randrange(5):02d}", rng.choice(["hate", "not_hate"]), f"w{int(rng.paretovariate(0.7)) % 9000}") for _ in range(60_000)]
    rows += [("2024-01-03", "hate", "hot")] * 30_000
    return rows, spark.createDataFrame(rows, "day string, prediction string, word string").repartition(7)


def test_united_sketches_are_near_the_exact_figures(spark):
    rows, words = word_table(spark)
    kept = sketches.word_sketches(words).cache()
    assert kept.count() == 10
    exact = {c: {w for _, p, w in rows if p == c} for c in ("hate", "not_hate")}
    for row in sketches.distinct_words(kept, ("prediction",)).collect():
        assert abs(row.distinct_words - len(exact[row.prediction])) <= 0.02 * len(exact[row.prediction])
    whole = sketches.distinct_words(kept).first()
    assert whole.n_words == len(rows) and abs(whole.distinct_words - len(exact["hate"] | exact["not_hate"])) <= 0.02 * whole.distinct_words
    counts = Counter(w for *_, w in rows)
    top = sketches.top_words(kept, 20).collect()
    assert [r.word for r in top] == sorted(counts, key=lambda w: (-counts[w], w))[:20]
    assert all(abs(r.frequency - counts[r.word]) <= r.max_error for r in top)
    by_day = sketches.top_words(kept, 1, ("day",)).collect()
    assert {r.day: r.word for r in by_day}["2024-01-03"] == "hot" and len(by_day) == 5


def test_counts_stay_within_their_bound_when_words_outnumber_the_sketch(spark, monkeypatch):
    monkeypatch.setattr(sketches, "TRACKED", 500)
    rows, words = word_table(spark)
    counts = Counter(w for *_, w in rows)
    top = sketches.top_words(sketches.word_sketches(words), 20).collect()
    assert top[0].word == "hot" and all(abs(r.frequency - counts[r.word]) <= r.max_error for r in top)
    found = {r.word for r in top}
    assert all(w in found for w, n in counts.items() if n > top[-1].frequency + top[0].max_error)


def test_sketches_of_nothing(spark):
    kept = sketches.word_sketches(spark.createDataFrame([], "day string, prediction string, word string"))
    assert kept.count() == 0 and sketches.distinct_words(kept, ("prediction",)).count() == 0
