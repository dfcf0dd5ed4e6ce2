"""Retraining from low-confidence posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions.keys import hash_bucket
from quillstream.functions.labels import class_label
from quillstream.operators import features as feats
from quillstream.plans import training
from quillstream.sources.tables import ModelStore


def relabel(failed: DataFrame, how: str = "join", annotations: DataFrame | None = None,
            seed: str = "") -> DataFrame:
    """Training rows (``id``, raw ``tweet``, ``label``) from low-confidence posts.

    ``join``: labels given by annotators (``id``, ``label``); posts without one
    are left out.  ``flip``: the opposite of the prediction.  ``coin``: a seeded
    fair coin per id.  The text is the raw one, because cleaning twice would
    change it.
    """
    posts = failed.select("id", F.col("raw_tweet").alias("tweet"), "prediction")
    if how == "join":
        if annotations is None:
            raise ValueError("annotations are needed to join labels")
        return posts.join(annotations.select("id", "label"), "id").select("id", "tweet", "label")
    if how == "flip":
        label = 1 - class_label(F.col("prediction"))
    elif how == "coin":
        label = hash_bucket(F.concat("id", F.lit(seed)), 2).cast("int")
    else:
        raise ValueError("how must be 'join', 'flip' or 'coin'")
    return posts.select("id", "tweet", label.alias("label"))


def retrain(failed: DataFrame, store: ModelStore, how: str = "join",
            annotations: DataFrame | None = None,
            settings: training.FitSettings = training.CHOSEN, keep_test: bool = True,
            **fit_options) -> int:
    """Fit on relabelled posts and publish the model as the next version.

    ``keep_test`` leaves posts of the test part out, so the new version can be judged on it.
    """
    rows = training.prepare(relabel(failed, how, annotations))
    if keep_test:
        rows, _ = feats.split(rows)
    model = training.fit(rows, settings, hold_out=False, **fit_options)
    return store.save(model)
