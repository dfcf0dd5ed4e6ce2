"""Recall of the hashed search on rows unlike the given tables."""

import numpy as np
import pytest

from quillstream.llm import cross_polytope

VECTORS = "vec_id bigint, embedding array<float>, label int"


def recall_of(spark, x):
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    got = cross_polytope.nearest(spark.createDataFrame(rows, VECTORS)).toPandas()
    x = x.astype(float)
    unit, hits = x / np.linalg.norm(x, axis=1)[:, None], 0
    for q in range(0, len(x), 50):
        scores = unit @ unit[q]
        scores[q] = -2
        hits += len(set(np.argsort(-scores, kind="stable")[:5]) & set(got[got["query_id"] == q]["vec_id"]))
    return hits / (5 * len(range(0, len(x), 50)))


@pytest.mark.parametrize("kind", ["random", "positive", "wide", "clusters", "few strong axes"])
def test_nearest_recall_on_other_vectors(spark, kind):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((3000, 256 if kind == "wide" else 64))
    if kind == "positive":
        x = np.abs(x)
    if kind == "clusters":
        x = rng.standard_normal((30, 64))[rng.integers(0, 30, 3000)] + 0.7 * x
    if kind == "few strong axes":
        x *= np.geomspace(1, 0.01, 64)
    assert recall_of(spark, x.astype(np.float32)) >= 0.95
