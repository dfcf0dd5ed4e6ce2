"""Exact top-k on rows unlike the given tables."""

import math

import numpy as np
import pytest

from quillstream.llm import topk

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_top(rows, k=20, every=20):
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    out = []
    for q, (i, v) in enumerate(whole):
        if i is not None and i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j) for r, (j, w) in enumerate(whole) if r != q)
            out += [(i, n + 1, j, -s) for n, (s, _, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("size", [1e3, 2e5, 4e6])
def test_top_k_of_large_components_is_exact(spark, monkeypatch, size):
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((120, 64)) * size).astype(np.float32)
    # Rows whose scores differ by little, some with very large ids and one without.
    x[60:] = x[3]
    x[60:, 7] += np.linspace(0, 1, 60, dtype=np.float32)
    ids = [*range(80), *(2**60 + 2 * i + 1 for i in range(39)), None]
    rows = [(i, [float(c) for c in v]) for i, v in zip(ids, x)]
    for block in (8192, 50):
        monkeypatch.setattr(topk, "ROW_BLOCK", block)
        got = topk.top_k(spark.createDataFrame([(*r, 0) for r in rows], VECTORS)).collect()
        assert sorted(map(tuple, got)) == brute_top(rows)


def test_scores_beyond_all_longs(spark):
    rows = [(0, [3e38, 1.0]), (1, [0.0, 5.0]), (2, [3e38, 2.0]), (3, [-3e38, 1.0])]
    got = topk.top_k(spark.createDataFrame([(*r, 0) for r in rows], VECTORS)).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 2, 2**63 - 1), (0, 2, 1, 64 * 320), (0, 3, 3, -2**63)]
