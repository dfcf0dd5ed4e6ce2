"""The grid query is the whole search: every term, and as many steps as the settings allow."""

import numpy as np
from pyspark.ml.linalg import Vectors

import __spark_entry__ as entry_module
from quillstream.operators import features as feats
from quillstream.plans import stacked, training


def test_query_searches_all_settings_at_full_width(spark, sf_dir, monkeypatch):
    asked = []
    monkeypatch.setattr(stacked, "grid_search", lambda prepared, grid=None, num_features=feats.NUM_FEATURES: asked.append((grid, num_features)))
    entry_module.queries()["grid_search"](spark, sf_dir)
    assert asked == [(None, 262_144)]


def test_only_the_settings_end_a_descent():
    column = stacked.Column(0.0, 0.0, np.zeros(2), 0.0, 900)
    ended = []
    for n in range(902):
        column.receive(-10.0 * n, np.ones(2))
        ended.append(column.done)
        if column.done:
            break
    assert len(ended) == 901 and column.steps == 900


def test_fits_take_the_steps_of_their_settings(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = spark.createDataFrame([(int(rng.random() < 0.4), Vectors.sparse(20, sorted(rng.choice(20, 5, replace=False).tolist()), [1.0] * 5), 1.0, 1.0)
                                  for _ in range(60)], ["label", "features", "weight", "no_weight"]).coalesce(1).cache()
    widths, real = [], stacked._gradients
    monkeypatch.setattr(stacked, "_gradients", lambda *a: widths.append(a[2].shape[1]) or real(*a))
    grid = [training.replace(training.CHOSEN, maxIter=n, tol=0.0) for n in (1, 4)]
    stacked.fit_all(rows, grid)
    assert widths[:2] == [2, 2] and 2 < len(widths) < 15 and widths[-1] == 1
