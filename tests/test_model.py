import math

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quillstream.operators import features as feats
from quillstream.operators import metrics, predictions
from quillstream.plans import retraining, scoring, training
from quillstream.registry import inputs
from quillstream.scratch import scratch_dir
from quillstream.sources.tables import ModelStore

WIDTH = 2**10


@pytest.fixture(scope="module")
def prepared(spark, sf_dir):
    return training.prepare(inputs.labeled(spark, sf_dir)).persist()


@pytest.fixture(scope="module")
def model(prepared):
    return training.fit(prepared, num_features=WIDTH)


def test_chosen_and_grid_settings():
    assert len(training.settings_grid()) == 120
    chosen = training.CHOSEN
    assert (chosen.regParam, chosen.elasticNetParam, chosen.family, chosen.weightCol,
            chosen.maxIter, chosen.tol) == (0.1, 0.015, "binomial", "weight", 1000, 1e-6)
    assert chosen in training.settings_grid()


def test_metrics_equal_library_evaluators(spark):
    rows = [(float(i % 2), int(i % 3 == 0)) for i in range(50)] + [(1.0, 0)] * 7
    df = spark.createDataFrame(rows, "prediction double, label int")
    mine = metrics.overall(df).first()
    for name, value in (("f1", mine.f1), ("weightedPrecision", mine.weighted_precision),
                        ("weightedRecall", mine.weighted_recall)):
        assert math.isclose(value, MulticlassClassificationEvaluator(metricName=name).evaluate(df))
    for row in metrics.by_class(df).collect():
        for name, value in (("fMeasureByLabel", row.f1), ("precisionByLabel", row.precision),
                            ("recallByLabel", row.recall)):
            library = MulticlassClassificationEvaluator(
                metricName=name, metricLabel=float(row["class"])).evaluate(df)
            assert math.isclose(value, library)
    report = {r["class"]: r for r in metrics.report(df).collect()}
    assert set(report) == {"all", "0", "1"}
    assert math.isclose(report["all"].f1, mine.f1)
    one = metrics.wide(df).first()
    for name in ("f1", "weighted_precision", "weighted_recall"):
        assert math.isclose(one[name], mine[name])
    for c in (0, 1):
        for name in ("precision", "recall", "f1"):
            assert math.isclose(one[f"{name}_{c}"], report[str(c)][name])
    empty = metrics.wide(df.limit(0)).first()
    assert empty.f1 is None and empty.f1_1 == 0.0 and empty.n_0_0 == 0
    matrix = {r.label: (r.predicted_0, r.predicted_1) for r in metrics.confusion(df).collect()}
    assert sum(map(sum, matrix.values())) == len(rows)


def test_class_never_predicted_scores_zero(spark):
    df = spark.createDataFrame([(0.0, 0), (0.0, 1)], "prediction double, label int")
    row = {r["class"]: r for r in metrics.by_class(df).collect()}[1]
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_fit_does_not_depend_on_partitioning(prepared, model):
    other = training.fit(prepared.repartition(3), num_features=WIDTH)
    np.testing.assert_allclose(
        other.stages[-1].coefficients.toArray(), model.stages[-1].coefficients.toArray(), atol=1e-6)


def test_evaluate_covers_the_test_part(prepared, model):
    rows = {r["class"]: r for r in training.evaluate(model, prepared).collect()}
    assert rows["all"].n_true == rows["0"].n_true + rows["1"].n_true


def test_saved_model_predicts_the_same(spark, prepared, model):
    store = ModelStore(spark, scratch_dir(spark, "store"))
    assert store.latest() is None
    with pytest.raises(FileNotFoundError):
        store.load()
    assert [store.save(model), store.save(model)] == [1, 2]
    again = store.load(1).transform(prepared).select("id", vector_to_array("probability").alias("p"))
    first = model.transform(prepared).select("id", vector_to_array("probability").alias("p"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect()))


def test_grid_search_gives_every_setting_and_a_best(prepared):
    grid = training.settings_grid(regParam=(0.01, 0.3), family=("binomial", "multinomial"))
    results = training.grid_search(prepared, grid, num_features=WIDTH)
    assert results.count() == 4
    best = training.best_settings(results)
    top = results.agg(F.max("f1")).first()[0]
    assert best in grid
    assert results.filter((F.col("regParam") == best.regParam) & (F.col("family") == best.family)) \
        .first().f1 == top


def test_search_choose_fit_and_save(spark, prepared):
    store = ModelStore(spark, scratch_dir(spark, "store"))
    grid = training.settings_grid(regParam=(0.01, 0.3))
    version = training.search_and_save(prepared, store, grid, num_features=WIDTH)
    model = store.load(version)
    assert model.stages[-1].getRegParam() in (0.01, 0.3)
    rows = training.confusion(model, prepared).collect()
    assert sum(r.predicted_0 + r.predicted_1 for r in rows) == feats.split(prepared)[1].count()


def test_tasks_and_depth_grow_with_the_tokens(prepared):
    assert training.deep_enough(training.CHOSEN, 1) == training.CHOSEN
    assert training.deep_enough(training.CHOSEN, 40_000).aggregationDepth == 4
    kept = prepared.coalesce(2)
    assert training.in_tasks(kept, 1).rdd.getNumPartitions() == 1
    assert training.in_tasks(kept, 7).rdd.getNumPartitions() == 7


def test_refit_idf_depends_on_the_batch(spark, sf_dir, model):
    posts = inputs.posts(inputs.tweets(spark, sf_dir))
    cleaned = scoring.clean_posts(posts)
    assert scoring.score(cleaned, model, idf="refit").count() == posts.count()
    with pytest.raises(ValueError):
        scoring.score(cleaned, model, idf="other")


def test_confidence_is_of_the_predicted_class(spark):
    rows = [("a", 1.0, [0.31, 0.69]), ("b", 1.0, [0.3, 0.7]), ("c", 0.0, [0.9, 0.1]), ("d", 1.0, None)]
    df = spark.createDataFrame(rows, "id string, prediction double, probability array<double>")
    got = {r.id: (r.prediction, r.confidence_score)
           for r in predictions.format_predictions(df, ("id",)).collect()}
    assert got["a"] == ("hate", float(np.float32(0.69)))
    assert got["c"] == ("not_hate", float(np.float32(0.9)))
    assert got["d"] == ("hate", None)
    flagged = predictions.format_predictions(df, ("id",))
    flagged = flagged.filter(F.col("confidence_score") < F.lit(0.7).cast("double"))
    # float32(0.7) is below 0.7 and is flagged.
    assert {r.id for r in flagged.collect()} == {"a", "b"}


def test_vectors_and_named_labels(spark):
    df = spark.createDataFrame([(1, 0.0, [0.8, 0.2])], "label int, prediction double, p array<double>")
    row = predictions.format_predictions(
        df.withColumn("probability", array_to_vector("p")), (), also_name=("label",)).first()
    assert (row.label, row.prediction) == ("hate", "not_hate")


def test_relabel_and_retrain(spark, sf_dir, model):
    failed = scoring.failed_table(inputs.results(inputs.tweets(spark, sf_dir)))
    notes = inputs.annotations(spark, sf_dir)
    joined = retraining.relabel(failed, "join", notes)
    wanted = failed.join(notes, "id").count()
    assert joined.count() == wanted and joined.columns == ["id", "tweet", "label"]
    flipped = retraining.relabel(failed, "flip").join(failed.select("id", "prediction"), "id")
    assert flipped.filter("(label = 1) = (prediction = 'hate')").count() == 0
    coin = {r.id: r.label for r in retraining.relabel(failed, "coin").collect()}
    assert coin == {r.id: r.label for r in retraining.relabel(failed.repartition(5), "coin").collect()}
    assert set(coin.values()) == {0, 1}
    with pytest.raises(ValueError):
        retraining.relabel(failed, "join")
    store = ModelStore(spark, scratch_dir(spark, "store"))
    store.save(model)
    assert retraining.retrain(failed, store, "flip", num_features=WIDTH) == 2
    assert store.load().stages[0].getInputCol() == "tweet"
