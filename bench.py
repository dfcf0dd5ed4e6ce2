"""Headline timings: prints one JSON line.

Tables come from $BENCH_SF_DIR, cores from $BENCH_CPUS.  Every query writes its
whole result to a sink that discards it; the best of the repeats is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.ml import PipelineModel  # noqa: E402

from quillstream.functions import text as T  # noqa: E402
from quillstream.operators import features as feats  # noqa: E402
from quillstream.operators import frequency, profile  # noqa: E402
from quillstream.plans import scoring, training  # noqa: E402
from quillstream.registry import inputs  # noqa: E402
from quillstream.registry.queries import QUERIES  # noqa: E402
from quillstream.scratch import scratch_dir  # noqa: E402
from quillstream.session import local_session  # noqa: E402
from quillstream.streaming import jobs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

RELATIONAL = [
    "clean_model", "clean_no_hashtag", "clean_eda", "top_words", "word_freq", "top_hashtags",
    "vocab_size", "idf_terms", "tfidf_terms", "dup_groups_unlabeled", "dup_total", "dedup",
    "class_share", "eval_overall", "low_confidence", "daily_word_freq", "stream_ingest",
    "stream_daily_words", "stream_dedup",
]


def timed(action, repeats: int) -> float:
    best = float("inf")
    for _ in range(repeats):
        begin = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - begin)
    return round(best, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session("bench", cores=CPUS, memory="16g", shuffle_partitions=int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    for name in RELATIONAL:
        repeats = 1 if name.startswith("stream") else 3
        seconds[name] = timed(lambda: drain(QUERIES[name](spark, SF_DIR)), repeats)

    # The same steps over cached documents, without the read.
    documents = inputs.documents(spark, SF_DIR).select("doc_id", "text").persist()
    documents.count()
    cached = {
        "clean_cached": lambda: documents.select(T.clean("text").alias("text")),
        "top_words_cached": lambda: frequency.top(
            frequency.model_word_frequency(documents, "text"), "word", 20),
        "dup_total_cached": lambda: profile.duplicate_total(documents, ["text"]),
    }
    for name, build in cached.items():
        seconds[name] = timed(lambda: drain(build()), 3)
    documents.unpersist()

    prepared = training.prepare(inputs.labeled(spark, SF_DIR)).persist()
    prepared.count()
    seconds["fit_features"] = timed(lambda: feats.fit_features(prepared), 3)
    models = []
    seconds["fit_model"] = timed(lambda: models.append(training.fit(prepared)), 1)
    model = models[-1]

    cleaned = prepared.select("id", "tweet", "label")
    output = ["id", "prediction", "probability"]
    seconds["score"] = timed(lambda: drain(model.transform(cleaned).select(output)), 3)
    # The classifier alone, over cached features.
    vectors = PipelineModel(model.stages[:-1]).transform(cleaned).select("id", "features").persist()
    vectors.count()
    seconds["score_features"] = timed(lambda: drain(model.stages[-1].transform(vectors).select(output)), 3)
    vectors.unpersist()
    seconds["evaluate"] = timed(lambda: drain(training.evaluate(model, prepared)), 2)
    prepared.unpersist()

    posts = inputs.posts(inputs.tweets(spark, SF_DIR))
    seconds["clean_score_format"] = timed(lambda: drain(scoring.predict(posts, model)), 3)

    def stream() -> None:
        root = scratch_dir(spark, "bench")
        jobs.score_stream(
            inputs.posts(inputs.stream_tweets(spark, SF_DIR)), model, root, f"{root}/checkpoint"
        ).awaitTermination()

    seconds["stream_score"] = timed(stream, 1)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(Path(SF_DIR).name.removeprefix("sf") or 0),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
