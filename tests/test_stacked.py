"""Fits that share their passes equal single fits."""

import numpy as np
import pytest

from quillstream.plans import stacked, training
from quillstream.registry import inputs

TERMS = 2**10


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    from quillstream.operators import features as feats
    counted = training.counted_terms(training.prepare(inputs.labeled(spark, sf_dir)), TERMS)
    weighted = feats.class_weights(feats.idf().fit(counted).transform(counted), over=counted)
    return weighted.select("label", "features", "weight", "no_weight").repartition(3).cache()


CHOSEN = training.settings_grid(weightCol=("no_weight", "weight"), regParam=(0.03, 0.3), family=("binomial", "multinomial"))


@pytest.mark.parametrize("cells", [4_000_000, 3 * TERMS])
def test_columns_equal_single_fits(spark, rows, monkeypatch, cells):
    monkeypatch.setattr(stacked, "MAX_CELLS", cells)
    used, coefficients, intercepts = stacked.fit_all(rows, [training.replace(s, tol=1e-9) for s in CHOSEN])
    assert len(used) <= TERMS and coefficients.shape == (len(used), len(CHOSEN))
    picked = range(len(CHOSEN)) if cells > 10**6 else (0, 7)
    for i in picked:
        s = CHOSEN[i]
        single = training.logistic(training.replace(s, tol=1e-10)).fit(rows)
        if s.family == "multinomial":
            wanted = single.coefficientMatrix.toArray()[1] - single.coefficientMatrix.toArray()[0]
            intercept = single.interceptVector[1] - single.interceptVector[0]
        else:
            wanted, intercept = single.coefficients.toArray(), single.intercept
        full = np.zeros(TERMS)
        full[used] = coefficients[:, i]
        assert np.abs(full - wanted).max() < 1e-4 and abs(intercepts[i] - intercept) < 1e-3, s


def test_grid_has_a_row_for_every_setting(spark, sf_dir):
    prepared = training.prepare(inputs.labeled(spark, sf_dir))
    grid = CHOSEN[:2]
    got = stacked.grid_search(prepared, grid, TERMS).toPandas()
    single = training.grid_search(prepared, grid, TERMS).toPandas()
    assert list(got.columns) == list(single.columns)
    keys, counts = ["weightCol", "regParam"], ["n_0_0", "n_0_1", "n_1_0", "n_1_1"]
    got, single = (x.sort_values(keys, ignore_index=True)[counts] for x in (got, single))
    # Both stop early, so a post near even odds may fall on the other side.
    assert (got - single).abs().max().max() <= 1 and (got.sum(axis=1) == single.sum(axis=1)).all()
