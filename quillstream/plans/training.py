"""Training: clean, features, weights, split, fit, evaluate, search."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace
from itertools import product
from math import ceil, log
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import text as T
from quillstream.operators import features as feats
from quillstream.operators import metrics, profile
from quillstream.sources.tables import ModelStore


@dataclass(frozen=True)
class FitSettings:
    """Logistic regression settings; the defaults are the chosen model."""

    regParam: float = 0.1
    elasticNetParam: float = 0.015
    family: str = "binomial"
    weightCol: str = "weight"
    maxIter: int = 1000
    tol: float = 1e-6
    # Least levels of the gradient sum; ``fit`` raises them with the number of tasks.
    aggregationDepth: int = 2


# The chosen settings (with the defaults above) and the baseline.
CHOSEN = FitSettings()
BASELINE = FitSettings(regParam=1.0, elasticNetParam=0.0, family="auto", weightCol="no_weight")

# The full search space (120 fits).
GRID = {
    "weightCol": ("no_weight", "weight"),
    "regParam": (0.001, 0.003, 0.01, 0.03, 0.1, 0.3),
    "family": ("binomial", "multinomial"),
    "elasticNetParam": (0.001, 0.003, 0.01, 0.015, 0.02),
}


# Tokens one task of a fit should hold: some 6 MB of index/value pairs, three times
# the gradient vector (8 bytes per hashed term) it sends in every round.
TOKENS_PER_TASK = 500_000
# Above one task for each core, only tasks of this size are added (some 400 MB of pairs): every
# task sends its gradient in every round, so their number is what a fit costs the network.
MAX_TOKENS_PER_TASK = 50_000_000
# Most gradients that one step of a gradient sum takes in.
GRADIENTS_PER_STEP = 32


def prepare(raw: DataFrame) -> DataFrame:
    """Usable, distinct labelled posts (``id``, ``raw_tweet``, ``tweet``, ``label``).

    The raw text stays beside the cleaned one, so a later run never cleans twice.
    """
    usable = profile.drop_nulls(raw.select("id", "tweet", "label"), ["tweet", "label"])
    distinct = profile.drop_duplicates(usable, ["tweet", "label"], "id")
    return distinct.select(
        "id",
        F.col("tweet").alias("raw_tweet"),
        T.clean("tweet").alias("tweet"),
        "label",
    )


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` for the passes inside the block; lost pieces are recomputed."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def logistic(settings: FitSettings) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", **asdict(settings))


def counted_terms(prepared: DataFrame, num_features: int) -> DataFrame:
    """Hashed counts of prepared rows, with the number of tokens beside them."""
    return feats.term_counts(prepared, num_features).select(
        "id", "label", "rawFeatures", F.size("words").alias("n_words")
    )


def tasks_for(counted: DataFrame) -> int:
    """Number of tasks that fits the data; more would only send more gradients."""
    tokens = counted.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    return tasks_of(tokens, counted.sparkSession.sparkContext.defaultParallelism)


def tasks_of(tokens: int, cores: int) -> int:
    """One task for ``TOKENS_PER_TASK`` up to the number of cores, more only for very many tokens."""
    return max(1, min(ceil(tokens / TOKENS_PER_TASK), cores), ceil(tokens / MAX_TOKENS_PER_TASK))


def in_tasks(rows: DataFrame, tasks: int) -> DataFrame:
    """Kept ``rows`` in that many partitions, shuffled only when there are fewer now."""
    if rows.rdd.getNumPartitions() >= tasks:
        return rows.coalesce(tasks)
    return rows.repartition(tasks)


def deep_enough(settings: FitSettings, tasks: int) -> FitSettings:
    """Settings whose gradient sum has a level for every ``GRADIENTS_PER_STEP``-fold of tasks."""
    depth = max(settings.aggregationDepth, ceil(log(max(tasks, 2), GRADIENTS_PER_STEP)))
    return replace(settings, aggregationDepth=depth)


def fit(prepared: DataFrame, settings: FitSettings = CHOSEN,
        num_features: int = feats.NUM_FEATURES, hold_out: bool = True) -> PipelineModel:
    """Fit the whole pipeline: tokenizer, hashed counts, document frequencies, classifier.

    Document frequencies and class ratio come from all prepared rows, the
    classifier from the training part (or from all rows without ``hold_out``).
    Text is cleaned and hashed once; only hashed counts are kept for the passes.
    """
    with kept(counted_terms(prepared, num_features)) as counted:
        tasks = tasks_for(counted)
        idf_model = feats.idf().fit(counted)
        rows = feats.class_weights(idf_model.transform(counted), over=counted)
        if hold_out:
            rows, _ = feats.split(rows)
        rows = in_tasks(rows.select("label", "features", settings.weightCol), tasks)
        classifier = logistic(deep_enough(settings, tasks)).fit(rows)
    return PipelineModel(
        [feats.tokenizer(), feats.hashing_tf(num_features), idf_model, classifier]
    )


def evaluate(model: PipelineModel, prepared: DataFrame) -> DataFrame:
    """Overall and per-class metrics on the held-out part."""
    _, test = feats.split(prepared)
    return metrics.report(model.transform(test))


def confusion(model: PipelineModel, prepared: DataFrame) -> DataFrame:
    """Confusion counts on the held-out part."""
    _, test = feats.split(prepared)
    return metrics.confusion(model.transform(test))


def settings_grid(base: FitSettings = CHOSEN, **choices: Iterable) -> list[FitSettings]:
    """All combinations of the given settings; the full search space by default."""
    choices = choices or GRID
    return [replace(base, **dict(zip(choices, values))) for values in product(*choices.values())]


def is_validation(key):
    """A fifth of the training ids, decided by another slice of the same hash."""
    return F.conv(F.substring(F.md5(key), 9, 8), 16, 10).cast("bigint") % 5 == 0


def grid_search(prepared: DataFrame, grid: list[FitSettings] | None = None,
                num_features: int = feats.NUM_FEATURES, parallelism: int = 4) -> DataFrame:
    """Overall and per-class metrics of every setting on a validation part of the training rows.

    The test part plays no role in the choice.  Features are computed once and
    kept; fits run ``parallelism`` at a time and share the cluster.
    """
    grid = grid or settings_grid()
    spark = prepared.sparkSession
    train, _ = feats.split(counted_terms(prepared, num_features))
    with kept(train) as train:
        tasks = tasks_for(train)
        fit_part = train.filter(~is_validation(F.col("id")))
        idf_model = feats.idf().fit(fit_part)
        weighted = feats.class_weights(idf_model.transform(fit_part), over=fit_part)
        weighted = in_tasks(weighted.select("label", "features", "weight", "no_weight"), tasks)
        held = idf_model.transform(train.filter(is_validation(F.col("id")))).select("label", "features")
        with kept(weighted) as fit_rows, kept(held) as held:

            def run(settings: FitSettings) -> tuple:
                model = logistic(deep_enough(settings, tasks)).fit(fit_rows)
                figures = metrics.wide(model.transform(held)).first()
                return (*asdict(settings).values(), *figures)

            with ThreadPool(min(parallelism, len(grid))) as pool:
                rows = pool.map(inheritable_thread_target(spark)(run), grid)
    schema = (
        "regParam double, elasticNetParam double, family string, weightCol string, "
        "maxIter int, tol double, aggregationDepth int, "
        + ", ".join(f"{c} {'bigint' if c.startswith('n_') else 'double'}" for c in metrics.WIDE)
    )
    return spark.createDataFrame(rows, schema)


def search_and_save(prepared: DataFrame, store: ModelStore, grid: list[FitSettings] | None = None,
                    metric: str = "f1_1", **options) -> int:
    """Search, choose by ``metric``, fit the choice on the whole training part, save it."""
    options_of_fit = {k: v for k, v in options.items() if k == "num_features"}
    with kept(prepared) as prepared:
        chosen = best_settings(grid_search(prepared, grid, **options), metric)
        return store.save(fit(prepared, chosen, **options_of_fit))


def best_settings(results: DataFrame, metric: str = "f1") -> FitSettings:
    """The setting with the best metric; ties go to the stronger, simpler penalty.

    ``metric="f1_1"`` chooses by class 1, which the weighted figures hide when it is rare.
    """
    row = results.orderBy(
        F.desc(metric), F.desc("regParam"), F.desc("elasticNetParam"), "family", "weightCol"
    ).first()
    return FitSettings(**{name: row[name] for name in asdict(CHOSEN)})
