"""The quality classifier on held-out rows, for several seeds, and its calibration."""

import zlib

import duckdb
import numpy as np
import pytest

from quillstream.llm import quality

WHERE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled():
    rows = duckdb.connect().execute(
        f"SELECT doc_id, coalesce(text, '') AS text, quality FROM '{WHERE}/labels.parquet' JOIN '{WHERE}/documents.parquet' USING (doc_id)").df()
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in rows["doc_id"]])
    texts, labels = [t.encode() for t in rows["text"]], rows["quality"].to_numpy(np.float32)
    pick = lambda at: ([texts[i] for i in np.flatnonzero(at)], labels[at])
    return pick(~held), pick(held)


@pytest.mark.parametrize("seed", [3, 20, 40])
def test_both_classes_are_found_whatever_the_seed(labelled, seed):
    (texts, labels), (unseen, truth) = labelled
    scores = quality.train_folds(texts, labels, seed=seed).score(unseen)
    for value in (0, 1):
        assert ((scores >= quality.THRESHOLD) == value)[truth == value].mean() >= 0.92
    assert ((scores >= quality.THRESHOLD) == truth).mean() > 0.97


def test_calibration_weighs_both_classes_alike():
    rng = np.random.default_rng(1)
    labels = (rng.random(5_000) < 0.9).astype(float)
    odds = 3 * rng.standard_normal(5_000) + 8 * labels + 5
    slope, shift = quality.calibrate(odds, labels)
    # The classes' middles are 5 and 13: even odds lie half way, and the slope is 8 / 9.
    assert abs(-shift / slope - 9) < 0.3 and abs(slope - 8 / 9) < 0.1
    assert quality.calibrate(odds[:3], np.ones(3)) == (1.0, 0.0)
    assert quality.balanced(labels).sum() == pytest.approx(1)


def test_conflicting_labels_are_settled_alike_in_any_order(spark):
    docs = spark.createDataFrame([(i, f"some text {i} " * 3) for i in range(1, 60)], "doc_id bigint, text string")
    pairs = [(i, i % 2) for i in range(1, 60)] + [(i, 1 - i % 2) for i in range(1, 30)]
    found = []
    for order in (pairs, pairs[::-1]):
        model = quality.fit(docs, spark.createDataFrame(order, "doc_id bigint, quality int").coalesce(1))
        found.append(model.score([b"some text", b"other"]))
    assert np.array_equal(*found)
