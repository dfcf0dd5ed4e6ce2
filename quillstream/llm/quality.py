"""Quality classifier: a byte-level convolutional network in numpy.

The bytes of the whole text are embedded and cut into overlapping chunks of ``2 * HALF``
bytes, each starting ``HALF`` after the one before; every byte lies in two chunks.  Learned
filters and a hidden layer see each chunk, their largest activations over all chunks are
kept (max-pooling), and a logistic layer combines them into one probability.

Weights are learned on the driver from a bounded sample (``TRAIN_ROWS`` rows of at most
``TRAIN_BYTES`` bytes each): ``FOLDS`` networks, each from the rows outside its fold, with both
classes weighing the same.  The mean of their log odds, calibrated on the rows that a
network has not seen, is the score.  Scoring runs in the tasks, a piece of ``PIECE`` bytes at
a time, so a text of any length needs the same memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import Written, held_out

# Bounds of the sample that the network learns from.
TRAIN_ROWS = 4_000
TRAIN_BYTES = 50_000
WIDTH, HALF, FILTERS, HIDDEN = 6, 16, 32, 24
EPOCHS, BATCH, RATE = 10, 32, 0.004
FOLDS = 3
# Bytes scored at a time; a multiple of HALF.
PIECE = 1 << 18
THRESHOLD = 0.3

Weights = dict[str, np.ndarray]


def start(seed: int = 3) -> Weights:
    rng = np.random.default_rng(seed)
    n = 2 * HALF * WIDTH
    shapes = {"embed": ((256, WIDTH), 0.5), "filters": ((n, FILTERS), n ** -0.5),
              "hidden": ((FILTERS, HIDDEN), FILTERS ** -0.5), "out": ((HIDDEN + FILTERS, 1), 0.2)}
    w = {k: (rng.standard_normal(s) * f).astype(np.float32) for k, (s, f) in shapes.items()}
    return w | {"filter_bias": np.zeros(FILTERS, np.float32), "hidden_bias": np.zeros(HIDDEN, np.float32),
                "out_bias": np.zeros(1, np.float32)}


def _activations(w: Weights, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filters and hidden units of every chunk of ``data`` (whole halves, two at least)."""
    halves = w["embed"][data].reshape(-1, HALF * WIDTH)
    a, b = np.split(w["filters"], 2)
    conv = halves[:-1] @ a
    conv += halves[1:] @ b
    conv += w["filter_bias"]
    np.maximum(conv, 0, out=conv)
    hidden = conv @ w["hidden"]
    hidden += w["hidden_bias"]
    np.maximum(hidden, 0, out=hidden)
    return conv, hidden


def _padded(raw: bytes) -> np.ndarray:
    """Zero bytes fill up the last chunk; an empty text is one chunk of them."""
    size = max(2 * HALF, -(-len(raw) // HALF) * HALF)
    return np.frombuffer(raw.ljust(size, b"\0"), np.uint8)


def pooled(w: Weights, raw: bytes) -> np.ndarray:
    """Largest activations over all chunks of a text, piece by piece."""
    data, best = _padded(raw), None
    for at in range(0, len(data) - HALF, PIECE):
        conv, hidden = _activations(w, data[at:at + PIECE + HALF])
        now = np.concatenate([hidden.max(axis=0), conv.max(axis=0)])
        best = now if best is None else np.maximum(best, now)
    return best


def probability(w: Weights, pooled_rows: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(pooled_rows @ w["out"][:, 0] + w["out_bias"], -30, 30).astype(float)))


def score_texts(w: Weights, texts: list[bytes]) -> np.ndarray:
    """Probabilities; short texts share one pass, cut apart at their chunks."""
    rows = np.empty((len(texts), HIDDEN + FILTERS), np.float32)
    group, size = [], 0

    def flush():
        if not group:
            return
        parts = [_padded(texts[i]) for i in group]
        conv, hidden = _activations(w, np.concatenate(parts))
        # The chunk that begins with a text's last half reaches into the next text.
        halves = np.array([len(p) // HALF for p in parts])
        begins = np.concatenate([[0], np.cumsum(halves)[:-1]])
        over = np.cumsum(halves)[:-1] - 1
        for values in (conv, hidden):
            values[over] = 0
        rows[group] = np.concatenate([np.maximum.reduceat(hidden, begins), np.maximum.reduceat(conv, begins)], axis=1)
        group.clear()

    for i, raw in enumerate(texts):
        if len(raw) > PIECE:
            rows[i] = pooled(w, raw)
            continue
        if size + len(raw) > PIECE:
            flush()
            size = 0
        group.append(i)
        size += len(raw) + 2 * HALF
    flush()
    return probability(w, rows)


def _gradients(w: Weights, texts: list[bytes], labels: np.ndarray, shares: np.ndarray) -> Weights:
    """Gradient of the weighted log loss; only each unit's largest chunk passes it on."""
    g = {k: np.zeros_like(v) for k, v in w.items()}
    for raw, label, share in zip(texts, labels, shares):
        data = _padded(raw)
        conv, hidden = _activations(w, data)
        top_h, top_c = hidden.argmax(axis=0), conv.argmax(axis=0)
        pool = np.concatenate([hidden[top_h, np.arange(HIDDEN)], conv[top_c, np.arange(FILTERS)]])
        slope = share * float(probability(w, pool[None])[0] - label) / len(texts)
        g["out"][:, 0] += slope * pool
        g["out_bias"] += slope
        down = slope * w["out"][:, 0] * (pool > 0)
        # One row for each unit's chunk: hidden units first, then filters.
        into = np.zeros((HIDDEN + FILTERS, FILTERS), np.float32)
        seen = conv[top_h]
        g["hidden"] += (seen * down[:HIDDEN, None]).T
        g["hidden_bias"] += down[:HIDDEN]
        into[:HIDDEN] = w["hidden"].T * down[:HIDDEN, None] * (seen > 0)
        into[HIDDEN + np.arange(FILTERS), np.arange(FILTERS)] = down[HIDDEN:]
        at = np.concatenate([top_h, top_c])[:, None] * HALF + np.arange(2 * HALF)
        chunk = data[at]
        g["filters"] += w["embed"][chunk].reshape(len(at), -1).T @ into
        g["filter_bias"] += into.sum(axis=0)
        np.add.at(g["embed"], chunk.ravel(), (into @ w["filters"].T).reshape(-1, WIDTH))
    return g


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Weights:
    """Adam over shuffled batches; the same sample gives the same weights."""
    w, rng = start(seed), np.random.default_rng(seed)
    if not len(labels):
        return w
    share = np.clip(labels.mean(), 0.01, 0.99)
    w["out_bias"][:] = np.log(share / (1 - share))
    # Rows of the rarer class count for more, so that both classes weigh the same.
    shares = balanced(labels) * len(labels)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    steps = max(1, epochs * -(-len(texts) // BATCH))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            step += 1
            pick = order[at:at + BATCH]
            g = _gradients(w, [texts[i] for i in pick], labels[pick], shares[pick])
            rate = RATE * (1 - step / (steps + 1))
            for k in w:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
                w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
    return {k: v.astype(np.float32) for k, v in w.items()}


def balanced(labels: np.ndarray) -> np.ndarray:
    """Weights of the rows: half of the sum for each class, equal ones if there is one class."""
    n1 = int((labels > 0.5).sum())
    n0 = len(labels) - n1
    if not n0 or not n1:
        return np.full(len(labels), 1 / max(1, len(labels)))
    return np.where(labels > 0.5, 0.5 / n1, 0.5 / n0)


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return np.log(p / (1 - p))


def calibrate(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make log odds fit the labels, both classes weighing the same."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    x, share = np.stack([odds, np.ones(len(odds))], axis=1), balanced(labels)
    # Towards slope 1 and shift 0 where the classes are kept apart without fault.
    pull, centre, at = np.diag([1e-3, 1e-6]), np.array([1.0, 0.0]), np.array([0.1, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -700, 700)))
        slope = x.T @ (share * (p - labels)) + pull @ (at - centre)
        at = at - np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + pull, slope)
    return max(float(at[0]), 1e-3), float(at[1])


class Model:
    """Networks of all folds and the calibration of their mean log odds."""

    def __init__(self, nets: list[Weights], slope: float = 1.0, shift: float = 0.0):
        self.nets, self.slope, self.shift = nets, slope, shift

    def odds(self, texts: list[bytes]) -> np.ndarray:
        return np.mean([log_odds(score_texts(net, texts)) for net in self.nets], axis=0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.odds(texts) + self.shift, -700, 700)))


def train_folds(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Model:
    """One network for each fold of the sample; small samples train one that sees all rows."""
    if len(set(labels.tolist())) < 2 or len(labels) < 10 * FOLDS:
        return Model([train(texts, labels, epochs, seed)])
    fold, unseen, nets = np.arange(len(labels)) % FOLDS, np.empty(len(labels)), []
    for k in range(FOLDS):
        inside, outside = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        nets.append(train([texts[i] for i in outside], labels[outside], epochs, seed + k))
        unseen[inside] = log_odds(score_texts(nets[k], [texts[i] for i in inside]))
    return Model(nets, *calibrate(unseen, labels))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, seed: int = 3) -> Model:
    """Learn from ``labels.quality`` of rows that are not held out, smallest hashes first.

    An id with several labels has the smallest of them, whatever their order.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("label")) \
        .filter("label in (0, 1)").filter(~held_out("_id")).groupBy("_id").agg(F.min("label").alias("label"))
    known = Written(known.orderBy(F.xxhash64("_id"), "_id").limit(most), "labels").df
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.octet_length("text") <= TRAIN_BYTES) \
        .join(F.broadcast(known), F.col("doc_id") == F.col("_id")) \
        .select("text", "label", F.sha2("text", 256).alias("key")).orderBy("key", "label").limit(most).toPandas()
    return train_folds([t.encode() for t in rows["text"]], rows["label"].to_numpy(np.float32), seed=seed)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    ``score`` is the probability of label 1.  Null and empty texts are one chunk of zero
    bytes.  A null id is not held out.  Labels other than 0 and 1 are left out of the
    sample; without any label the weights stay as they start.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [(x.as_py() or "").encode() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.score(texts), pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {id_type}, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
