"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Learned from a bounded sample of labelled rows (``TRAIN_ROWS``, smallest hashes first), in
three parts that share no document: a lexicon of words and word beginnings that toxic texts
hold and others do not, the trees, and the isotonic curve from the trees' probability to
the calibrated score.  Features of a text are rates per word or per character, so they mean
the same at any length: lexicon and beginning densities, hits near a second-person word,
capitals, exclamation and other punctuation, obfuscated words and hits behind obfuscation.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm.common import Written, held_out, set_aside

# Bound of the sample that the model learns from.
TRAIN_ROWS = 12_000
# Bytes of the longest text that is learned from: half of the sample goes to the driver for the
# lexicon, at most 300 MB.
TRAIN_BYTES = 50_000
LEXICON = 3_000
BEGINNINGS = range(4, 9)
# Words this near to a second-person word count as aimed at somebody.
NEAR = 4
THRESHOLD = 0.5
FEATURES = ("words", "lexicon", "beginnings", "hits", "aimed", "capitals", "shouted", "exclaimed",
            "punctuation", "obfuscated", "hidden")

# Second-person words of the four languages, and look-alike characters.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes "
                          "vous votre vos usted ustedes ti tus su vosotros vuestro".split())
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")

_WORD = re.compile(r"[^\W\d_]+")
# Letters around look-alikes, dots or stars within one token.
_ODD = re.compile(r"[^\W\d_][\d@$!*._-]+[^\W\d_]")
# Distinct tokens remembered by a task, and the longest of them.
MEMO = 400_000
MEMO_LENGTH = 64


def _in_lexicon(word: str, lexicon: frozenset[str]) -> int:
    """2 for a word of the lexicon, 1 for one that begins like it, else 0."""
    if word in lexicon:
        return 2
    return int(any(word[:k] in lexicon for k in BEGINNINGS if k < len(word)))


def _token_counts(token: str, lexicon: frozenset[str]) -> tuple[int, ...]:
    """What one token adds: words, lexicon words, beginnings, second persons, letters,
    capitals, shouted, exclamation marks, marks, obfuscated, hidden hits."""
    if token.isalpha():
        low = token.lower()
        kind = _in_lexicon(low, lexicon)
        capitals = 0 if low == token else sum(map(str.isupper, token))
        return (1, int(kind == 2), int(kind == 1), int(low in SECOND_PERSON), len(token), capitals,
                int(capitals == len(token) > 2), 0, 0, 0, 0)
    words = _WORD.findall(token.lower())
    kinds = [_in_lexicon(w, lexicon) for w in words]
    letters = sum(map(str.isalpha, token))
    capitals = sum(map(str.isupper, token))
    marks = sum(not c.isalnum() for c in token)
    odd = letters < len(token) and _ODD.search(token) is not None
    hidden = odd and _in_lexicon(re.sub(r"[\W_]+", "", token.lower().translate(LOOKALIKE)), lexicon) > 0
    return (len(words), kinds.count(2), kinds.count(1), sum(w in SECOND_PERSON for w in words), letters, capitals,
            int(len(token) > 2 and token.isupper()), token.count("!"), marks, int(odd), int(hidden))


class _Counts:
    """Counts of tokens, each distinct one looked at once as long as the memory lasts."""

    def __init__(self, lexicon: frozenset[str]):
        self.lexicon, self.place, self.rows = lexicon, {}, []
        self.table, self.filled = np.zeros((0, 11), np.float32), 0

    def of(self, tokens: list[str]) -> np.ndarray:
        """One row for each token of a text."""
        place, rows = self.place, self.rows
        try:
            at = [place[t] for t in tokens]
        except KeyError:
            if len(rows) > MEMO:
                place.clear()
                rows.clear()
                self.filled = 0
            at = []
            for t in tokens:
                k = place.get(t)
                if k is None:
                    k = len(rows)
                    rows.append(_token_counts(t, self.lexicon))
                    if len(t) <= MEMO_LENGTH:
                        place[t] = k
                at.append(k)
            self._fill()
        return self.table[at]

    def _fill(self) -> None:
        """Bring the table up to the remembered rows."""
        rows = self.rows
        if len(rows) > len(self.table):
            self.table = np.zeros((2 * len(rows) + 4096, 11), np.float32)
            self.filled = 0
        self.table[self.filled:len(rows)] = rows[self.filled:]
        self.filled = len(rows)


def features(text: str | None, counts: _Counts) -> list[float]:
    """The dense features of one text; null and empty texts give zeros."""
    tokens = (text or "").split()
    if not tokens:
        return [0.0] * len(FEATURES)
    each = counts.of(tokens)
    words, whole, begun, _, letters, capitals, shouted, exclaimed, marks, odd, hidden = each.sum(axis=0, dtype=float).tolist()
    n, chars = max(words, 1), len(text)
    aimed = 0
    if whole + begun:
        hits = np.flatnonzero(each[:, 1] + each[:, 2])
        persons = np.cumsum(np.concatenate([[0], each[:, 3]]))
        around = persons[np.minimum(hits + NEAR + 1, len(tokens))] - persons[np.maximum(hits - NEAR, 0)]
        aimed = int((around > 0).sum())
    return [math.log1p(words), whole / n, begun / n, math.log1p(whole + begun), aimed / n, capitals / max(letters, 1),
            shouted / n, exclaimed / chars, marks / chars, odd / n, hidden / n]


def with_features(docs: DataFrame, lexicon: frozenset[str]) -> DataFrame:
    """``docs`` without its text, with ``features``.  The lexicon is broadcast: its size is
    bounded by ``LEXICON``."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kept = [c for c in docs.columns if c != "text"]
    place = docs.columns.index("text")

    def run(batches):
        counts = _Counts(shared.value)
        for batch in batches:
            found = pa.array([features(x.as_py(), counts) for x in batch.column(place)], pa.list_(pa.float64()))
            own = [c for i, c in enumerate(batch.columns) if i != place]
            yield pa.RecordBatch.from_arrays([*own, found], [*kept, "features"])

    return docs.mapInArrow(run, docs.select(*kept).schema.add("features", T.ArrayType(T.DoubleType())))


def _stems(text: str | None) -> set[str]:
    """The distinct words of a text and their beginnings."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {w[:k] for w in words for k in BEGINNINGS if k < len(w)}


def learn_lexicon(rows: pd.DataFrame) -> frozenset[str]:
    """Words and beginnings in at least 3 % (and 4) of the toxic texts, and there at
    least 30 times as likely as in the others; the ``LEXICON`` most frequent of them."""
    rows = rows.drop_duplicates("text")
    bad, good = (rows["text"][rows["label"] == k] for k in (1, 0))
    toxic: Counter[str] = Counter()
    for text in bad:
        toxic.update(_stems(text))
    least = max(4, 0.03 * len(bad))
    wanted = {w: c for w, c in toxic.items() if c >= least and len(w) >= BEGINNINGS.start}
    # Only what may enter the lexicon is counted in the many other texts.
    clean: Counter[str] = Counter()
    for text in good:
        clean.update(_stems(text) & wanted.keys())
    ranked = sorted((-c, w) for w, c in wanted.items()
                    if c / (len(bad) + 1) > 30 * (clean[w] + 0.5) / (len(good) + 1))
    return frozenset(w for _, w in ranked[:LEXICON])


class Model:
    """Lexicon, trees and curve.  Without both classes in the sample the score is constant."""

    def __init__(self, lexicon: frozenset[str], trees: GBTClassificationModel | None = None,
                 curve: IsotonicRegressionModel | None = None, constant: float = 0.0):
        self.lexicon, self.trees, self.curve, self.constant = lexicon, trees, curve, constant

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` without its text, with ``score``."""
        if self.trees is None:
            return docs.drop("text").withColumn("score", F.lit(self.constant))
        rows = with_features(docs, self.lexicon).withColumn("features", array_to_vector("features"))
        raw = _probabilities(self.trees, rows)
        return self.curve.transform(raw).withColumn(
            "score", F.least(F.greatest(F.col("curve"), F.lit(0.0)), F.lit(1.0))).drop("features", "raw", "curve")


def _probabilities(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    out = trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])
    return out.drop("rawPrediction", "probability", "prediction")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int = TRAIN_ROWS) -> DataFrame:
    """(text, label, part) of at most ``most`` labelled rows that may be learned from, their
    texts of at most ``TRAIN_BYTES`` bytes.

    An id that several rows share gives one of their texts: the one with the smallest hash.
    An id with several labels has the largest of them.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("label")) \
        .filter("label in (0, 1)").filter(~held_out("_id")).groupBy("_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("_id", F.lit(label))
    known = Written(known.orderBy(order, "_id").limit(most), "labels").df
    short = docs.select("doc_id", "text").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAIN_BYTES)
    picked = short.join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    picked = picked.groupBy("_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return picked.select("text", "label", F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(10)).alias("part"))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """Learn from ``labels.toxic``: half of the sample for the lexicon, three tenths for the
    trees, two for the curve."""
    rows = Written(training_rows(docs, labels, "toxic", most), "train").df
    known = rows.filter("part < 5").select("text", "label").toPandas()
    lexicon = learn_lexicon(known)
    dense = with_features(rows.filter("part >= 5").repartition(8), lexicon)
    dense = Written(dense, "dense").df.coalesce(1).withColumn("features", array_to_vector("features"))
    tree_rows, curve_rows = dense.filter("part < 8").cache(), dense.filter("part >= 8")
    classes = {r["label"] for r in tree_rows.select("label").distinct().collect()}
    if len(classes) < 2 or curve_rows.isEmpty():
        share = rows.agg(F.avg("label")).first()[0]
        return Model(lexicon, constant=share or 0.0)
    trees = GBTClassifier(maxIter=15, maxDepth=3, stepSize=0.3, seed=1, maxBins=32).fit(tree_rows)
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="curve") \
        .fit(_probabilities(trees, curve_rows))
    tree_rows.unpersist()
    return Model(lexicon, trees, curve)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts are scored like any text without words.  A null id is not held
    out.  Labels other than 0 and 1 and labels of unknown ids are left out of the
    sample; without labels of both kinds the score is the share of toxic labels, or 0.
    """
    model = fit(docs, labels)
    return model.score(docs.select("doc_id", "text")).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not scored as toxic, with their columns."""
    model = fit(docs, labels)
    apart, back = set_aside(docs, "text")
    back[docs.columns.index("text")] = F.col("_text").alias("text")
    return model.score(apart.withColumn("_text", F.col("text"))).filter(F.col("score") < THRESHOLD).select(*back)
