"""Queries that return what the fitted models give, without SQL."""

import pytest

import __spark_entry__ as entry_module
from quillstream.plans import scoring
from quillstream.registry import inputs
from quillstream.registry import queries as queries_module


def test_scores_come_with_class_and_probability(spark, sf_dir):
    queries = entry_module.queries()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("score", "score_refit"):
        got = queries[name](spark, sf_dir).toPandas()
        assert len(got) == docs and got["probability"].between(0, 1).all()
        assert ((got["probability"] > 0.5) == (got["prediction"] == 1)).all()
    got = queries["format_predictions"](spark, sf_dir).toPandas()
    assert len(got) == docs and set(got["prediction"]) <= {"hate", "not_hate"}
    assert got["confidence_score"].astype(float).between(0.5, 1).all()


def test_fits_come_with_their_metrics(spark, sf_dir):
    queries = entry_module.queries()
    for name in ("train", "train_baseline", "retrain"):
        got = queries[f"{name}_metrics"](spark, sf_dir).toPandas()
        assert {"class", "precision", "recall", "f1", "n_true"} <= set(got.columns)
        assert set(got["class"]) >= {"0", "1"}
        assert got[["precision", "recall", "f1"]].apply(lambda x: x.between(0, 1).all()).all()


@pytest.mark.parametrize("name, idf", [("score", "saved"), ("score_refit", "refit")])
def test_full_rows_equal_scores_by_single_buckets(spark, sf_dir, name, idf):
    got = entry_module.queries()[name](spark, sf_dir)
    cleaned = scoring.clean_posts(inputs.posts(inputs.tweets(spark, sf_dir)))
    wanted = queries_module._recomputed(cleaned, queries_module.chosen_model(spark, sf_dir), idf)
    both = got.join(wanted, "id").toPandas()
    assert len(both) == got.count() and (both["probability"] - both["expected"]).abs().max() < 1e-6


def test_stream_rows_equal_batch_rows(spark, sf_dir):
    assert entry_module.queries()["stream_score"](spark, sf_dir).filter("disagrees <> 0").count() == 0


def test_full_rows_are_compared_too(spark, sf_dir):
    queries = entry_module.queries()
    for name in ("score", "score_refit", "format_predictions"):
        rows = queries[name](spark, sf_dir)
        checked = queries[f"{name}_check"](spark, sf_dir)
        assert "disagrees" in rows.columns and rows.filter("disagrees <> 0").isEmpty()
        assert rows.select(checked.columns).exceptAll(checked).isEmpty()


def test_recomputed_scores_shuffle_one_row_for_each_id(spark, sf_dir):
    cleaned = scoring.clean_posts(inputs.posts(inputs.tweets(spark, sf_dir)))
    for idf in ("saved", "refit"):
        # Without estimates and adaptive changes only the hint decides.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            rows = queries_module._recomputed(cleaned, queries_module.chosen_model(spark, sf_dir), idf)
            plan = rows._jdf.queryExecution().sparkPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
