"""Approximate nearest neighbours by cross-polytope hashing.

Each of ``TABLES`` tables turns a unit vector by a pseudo-rotation, three rounds of random
signs and a fast Hadamard transform, and names the nearest signed axis: the largest
component by size, with its sign.  A query probes at least the ``PROBES`` nearest signed axes of
every table; the union of those buckets is reranked by exact cosines.

How many probes find the nearest rows depends on the vectors: few where near rows are very
near, most of them where all rows are nearly random.  So every task first searches its rows
in full for ``SAMPLE`` of its queries, and probes as many axes for all of them as find a
share ``RECALL`` of those true neighbours.

The index is sharded: every row is indexed, within its row block, by one task, and a
block of queries visits every row block.  A bucket that holds a large part of all rows (copies
of one vector) is thus spread over all shards, and no bucket needs a cap.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.common import Written
from quillstream.llm.topk import _matrix, asks, blocks_of, entries_of, identified, usable

TABLES = 8
PROBES = 12
SEED = 7
ROW_BLOCK = 16384
QUERY_BLOCK = 2048
# Queries whose probed rows are marked at a time.
SLICE = 128
# Queries of a task that are searched in full, and the share of their neighbours that the probes must find.
SAMPLE = 256
RECALL = 0.99
# Scores this near to the last kept one are computed again, one by one, before the cut.
ROUNDING = 1e-9


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotations(x: np.ndarray, tables: int, seed: int = SEED):
    """The turned rows, table by table."""
    width = 1 << max(0, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rng = np.random.default_rng(seed)
    for _ in range(tables):
        y = x
        for _ in range(3):
            y = hadamard(y * rng.choice([-1.0, 1.0], width))
        yield y


def nearest_axes(y: np.ndarray, probes: int) -> np.ndarray:
    """For each row its nearest signed axes, nearest first: 2 * axis + (1 if negative)."""
    signed = np.concatenate([-y, y], axis=1)
    probes = min(probes, signed.shape[1])
    if probes == 1:
        axis = np.argmin(signed, axis=1)[:, None]
    else:
        axis = np.argpartition(signed, probes - 1, axis=1)[:, :probes]
    width = y.shape[1]
    return np.where(axis < width, 2 * axis, 2 * (axis - width) + 1)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows, pair by pair, so equal rows get equal scores."""
    return (x * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(axis=1)))


def enough_probes(turned_q: list[np.ndarray], buckets: list[np.ndarray], cosines: np.ndarray, near: int, recall: float) -> int:
    """Probes in every table that find a share ``recall`` of the ``near`` rows nearest to each query.

    ``cosines`` (queries x rows) is -inf where a row is no candidate.
    """
    near = min(near, cosines.shape[1])
    best = np.argpartition(-cosines, near - 1, axis=1)[:, :near]
    needed = np.full(best.shape, np.iinfo(np.int64).max)
    for y, bucket in zip(turned_q, buckets):
        # Place of every signed axis in the order of nearness.
        place = np.argsort(np.argsort(-np.stack([y, -y], axis=2).reshape(len(y), -1), axis=1, kind="stable"), axis=1)
        needed = np.minimum(needed, np.take_along_axis(place, bucket[best], axis=1) + 1)
    needed = np.sort(needed[np.isfinite(np.take_along_axis(cosines, best, axis=1))])
    return int(needed[int(np.ceil(recall * len(needed))) - 1]) if len(needed) else 0


def _searcher(k: int, tables: int, probes: int, near: int):
    def search(_, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names = ["q", "ids", "nameless", "scores"]
        if queries.empty or rows.empty:
            return pd.DataFrame([], columns=names)
        rows = rows.sort_values(["vec_id", "no_id"], ignore_index=True)
        width = max(queries["v"].map(len).max(), rows["v"].map(len).max())
        q, x = _matrix(queries["v"], width), _matrix(rows["v"], width)
        # Scaled by the largest component first, so that no square overflows or vanishes.
        unit = lambda a: (b := a / np.abs(a).max(axis=1, keepdims=True)) / np.linalg.norm(b, axis=1, keepdims=True)
        uq, ux = unit(q), unit(x)
        turned, buckets = list(rotations(uq, tables)), [nearest_axes(y, 1)[:, 0] for y in rotations(ux, tables)]
        ids, nameless = rows["vec_id"].to_numpy(), rows["no_id"].to_numpy()
        own, asking, out = rows["uid"].to_numpy(), queries["uid"].to_numpy(), []
        tried = np.random.default_rng(SEED).permutation(len(q))[:SAMPLE]
        cosines = np.where(asking[tried, None] == own, -np.inf, uq[tried] @ ux.T)
        wide = max(probes, enough_probes([y[tried] for y in turned], buckets, cosines, near, RECALL))
        for begin in range(0, len(q), SLICE):
            at = slice(begin, begin + SLICE)
            wanted = np.zeros((len(uq[at]), len(x)), bool)
            for y, bucket in zip(turned, buckets):
                probed = np.zeros((len(wanted), 2 * y.shape[1]), bool)
                np.put_along_axis(probed, nearest_axes(y[at], wide), True, axis=1)
                wanted |= probed[:, bucket]
            wanted &= asking[at, None] != own
            for i, uid in enumerate(asking[at], begin):
                near_rows = np.flatnonzero(wanted[i - begin])
                if not len(near_rows):
                    continue
                rough = ux[near_rows] @ uq[i]
                if len(near_rows) > k:
                    near_rows = near_rows[rough >= np.partition(rough, -k)[-k] - ROUNDING]
                scores = exact(q[i], x[near_rows])
                order = np.argsort(-scores, kind="stable")[:k]
                best = near_rows[order]
                out.append((uid, ids[best], nameless[best], scores[order]))
        return pd.DataFrame(out, columns=names)

    return search


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, tables: int = TABLES, probes: int = PROBES,
            vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows but
    the query's own, so a repeated row is a candidate for its copy.  ``score`` is the cosine
    of the original vectors in double precision; ties go to the smaller vec_id, null
    ids come last and are no queries.  Null, empty and zero vectors and those with null or
    non-finite components take no part; different lengths are compared as if filled with
    zeros.  ``probes`` is the least number of probes; tasks raise it to what their vectors
    need.  Queries with fewer than k found candidates are searched in full.
    """
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    nonzero = F.exists(F.col(vector), lambda x: x != 0)
    written = Written(identified(vectors.filter(usable(vector) & nonzero), values), "vectors")
    base = written.df
    is_query = asks(every)
    n, n_queries = base.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    n_rows, n_q = blocks_of(n, ROW_BLOCK), blocks_of(n_queries, QUERY_BLOCK)
    mixed = F.xxhash64("uid")
    rows = written.fresh().withColumns({"rb": F.pmod(mixed, F.lit(n_rows)), "qb": F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))})

    def searched(queries: DataFrame, probed: int) -> DataFrame:
        dealt = queries.withColumns({"qb": F.pmod(mixed, F.lit(n_q)), "rb": F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))})
        # A row block holds its share of the k nearest.
        return entries_of(dealt.groupBy("qb", "rb").cogroup(rows.groupBy("qb", "rb")).applyInPandas(
            _searcher(k, tables, probed, blocks_of(k, n_rows)),
            "q bigint, ids array<bigint>, nameless array<boolean>, scores array<double>"))

    queries = base.filter(is_query)
    found = Written(searched(queries, probes), "found").df
    least = min(k, max(n - 1, 0))
    full = found.groupBy("q").count().filter(F.col("count") >= least)
    # Every signed axis of one table holds all rows: an exact search for the few left over.
    short = queries.withColumn("q", F.col("uid")).join(full.select("q"), "q", "left_anti").select(base.columns)
    found = found.join(full.select("q"), "q", "left_semi").unionByName(searched(short, 2**30))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = written.fresh().select(F.col("uid").alias("q"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "q").select("query_id", "rank", "vec_id", "score")
