"""Exact top-k inner products by three phases with a uniform threshold.

The components of all vectors are split into ``LISTS`` ranges: each gives every candidate a
partial score, and the score is their sum.  Candidates lie in row blocks; a task holds one
row block (with its local lists) and one block of queries.

1. Every task gathers the ``k`` best entries of each local list and resolves their scores.
   The k-th best score over all tasks is a safe cutoff for its query.
2. The cutoff ``t`` is sent back with the queries.  A score of at least ``t`` needs a
   partial score of at least ``t / LISTS`` in some list, so each list's entries from there
   on suffice.  An entry whose known partial scores plus ``t / LISTS`` for the others stay
   below ``t`` is dropped.
3. The missing partial scores of the rest are looked up, and what reaches the cutoff goes
   into the task's best ``k``, which are merged per query.

Partial scores are products in floating point, exact below 2**53; beyond, a bound of their
rounding widens every comparison.  Scores that are compared with the cutoff, ranked or returned
are integers, computed exactly for the few entries that come so far.

Queries and candidates meet in blocks of bounded size; nothing is broadcast or collected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.common import Written

LISTS = 2
SCALE = 64
# Vectors in a block of candidates and of queries, and queries scored at a time.
ROW_BLOCK = 8192
QUERY_BLOCK = 2048
SLICE = 128
# Up to here every integer is a double.
EXACT = 2.0**53
LONGS = np.iinfo(np.int64)


def finite(vector: str | Column) -> Column:
    """Not null, all components finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return F.coalesce(F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def usable(vector: str | Column) -> Column:
    """Neither null nor empty, all components finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return F.coalesce((F.size(column) > 0) & finite(column), F.lit(False))


def blocks_of(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of a common width; shorter vectors are filled with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def whole(component: Column) -> Column:
    """``floor(64 * x)`` as a double; doubles beyond 2**53 are whole, and may be no longs."""
    scaled = component.cast("double") * SCALE
    return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)


def identified(vectors: DataFrame, values: Column) -> DataFrame:
    """``vec_id``, ``no_id``, ``v``, ``uid`` of every row.

    Tasks would read a column with nulls as doubles and round large ids, so a null id becomes the
    largest long with a mark.
    """
    vec_id = F.col("vec_id").cast("bigint")
    return vectors.select(F.coalesce(vec_id, F.lit(int(LONGS.max))).alias("vec_id"), vec_id.isNull().alias("no_id"),
                          values.alias("v"), F.monotonically_increasing_id().alias("uid"))


def asks(every: int) -> Column:
    """Rows of ``identified`` that are queries."""
    return ~F.col("no_id") & (F.col("vec_id") % every == 0)


def entries_of(found: DataFrame) -> DataFrame:
    """One row (q, vec_id, score) for each entry of the tasks' lists, with null ids as they were."""
    return found.select("q", F.explode(F.arrays_zip("ids", "nameless", "scores")).alias("e")).select(
        "q", F.when(~F.col("e.nameless"), F.col("e.ids")).alias("vec_id"), F.col("e.scores").alias("score"))


def _sides(queries: pd.DataFrame, rows: pd.DataFrame):
    width = max(queries["v"].map(len).max(), rows["v"].map(len).max())
    cuts = np.linspace(0, width, LISTS + 1).astype(int)
    q, x = _matrix(queries["v"], width), _matrix(rows["v"], width)
    return q, x, [(q[:, a:b], x[:, a:b]) for a, b in zip(cuts, cuts[1:])]


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([int(c) for c in x.ravel()], object).reshape(x.shape)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of one vector of whole doubles with rows, as exact integers."""
    if not len(x) or not x.shape[1]:
        return np.zeros(len(x), np.int64)
    most = np.abs(q).max() * np.abs(x).max() * x.shape[1]
    if most < EXACT:
        return (x @ q).astype(np.int64)
    if max(most, np.abs(q).max(), np.abs(x).max()) < 2.0**62:
        return x.astype(np.int64) @ q.astype(np.int64)
    return (_integers(x) * _integers(q)).sum(axis=1)


def _below(scores: np.ndarray) -> list[float]:
    """The largest doubles that are not above the scores."""
    return [f if int(f) <= s else float(np.nextafter(f, -np.inf)) for s in map(int, scores) for f in (float(s),)]


def _rounding(q: np.ndarray, x: np.ndarray) -> np.ndarray | float:
    """Bound of the rounding of every partial score; 0 where none can occur."""
    size = np.sqrt((q * q).sum(axis=1))[:, None] * np.sqrt((x * x).sum(axis=1))
    if not size.size or size.max() < EXACT / 2:
        return 0.0
    return np.where(size < EXACT / 2, 0.0, size * ((x.shape[1] + 8) * 2.0**-52))


def _partial(parts, at: slice, same: np.ndarray) -> list[np.ndarray]:
    """The local lists of a slice of queries; a query's own row scores nothing."""
    lists = [q[at] @ x.T for q, x in parts]
    for scores in lists:
        scores[same] = -np.inf
    return lists


def _lists_of(k: int):
    def best_known(_, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """Phase 1: exact scores of each local list's best entries, best k of them."""
        if queries.empty or rows.empty:
            return pd.DataFrame([], columns=["q", "best"])
        (whole_q, whole_x, parts), own = _sides(queries, rows), rows["uid"].to_numpy()
        out, few = [], min(k, len(rows))
        for begin in range(0, len(queries), SLICE):
            at = slice(begin, begin + SLICE)
            same = queries["uid"].to_numpy()[at, None] == own
            lists = _partial(parts, at, same)
            chosen = [np.argpartition(-scores, few - 1, axis=1)[:, :few] for scores in lists]
            for i, entries in enumerate(np.concatenate(chosen, axis=1)):
                entries = np.unique(entries)
                entries = entries[~same[i, entries]]
                out.append(_below(-np.sort(-products(whole_q[begin + i], whole_x[entries]))[:k]))
        return pd.DataFrame({"q": queries["uid"], "best": out})

    return best_known


def _resolver(k: int):
    def resolve(_, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """Phases 2 and 3 for one row block."""
        names = ["q", "ids", "nameless", "scores"]
        if queries.empty or rows.empty:
            return pd.DataFrame([], columns=names)
        rows = rows.sort_values(["vec_id", "no_id"], ignore_index=True)
        (whole_q, whole_x, parts), own, out = _sides(queries, rows), rows["uid"].to_numpy(), []
        ids, nameless = rows["vec_id"].to_numpy(), rows["no_id"].to_numpy()
        cutoffs = queries["cutoff"].to_numpy(float)
        for begin in range(0, len(queries), SLICE):
            at = slice(begin, begin + SLICE)
            same = queries["uid"].to_numpy()[at, None] == own
            lists, off = _partial(parts, at, same), _rounding(whole_q[at], whole_x)
            cutoff = cutoffs[at, None]
            share = cutoff / LISTS
            # Turned round, so that a partial score beyond all doubles is kept.
            known = [~(s + off < share) for s in lists]
            sure = sum(np.where(h, s + off, share) for h, s in zip(known, lists))
            enough = np.logical_or.reduce(known) & ~(sure < cutoff) & ~same
            for i in range(len(enough)):
                entries = np.flatnonzero(enough[i])
                scores = products(whole_q[begin + i], whole_x[entries])
                # Rows are in the order of ids: a stable sort settles ties.
                order = np.argsort(-scores, kind="stable")[:k]
                if len(order):
                    best = entries[order]
                    out.append((queries["uid"].iat[begin + i], ids[best], nameless[best],
                                np.array([min(max(int(s), LONGS.min), LONGS.max) for s in scores[order]], np.int64)))
        return pd.DataFrame(out, columns=names)

    return resolve


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query.

    Vectors become ``floor(64 * x)``; the score is the exact integer inner product (one that no
    long can hold is stated as the nearest long).
    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows but
    the query's own, so a repeated row is a candidate for its copy.  Ties go to the
    smaller vec_id; a null vec_id is no query and comes last.  Null or empty vectors and
    those with null or non-finite components take no part.  Vectors of different length
    are compared as if filled with zeros.  An empty table gives no rows.
    """
    written = Written(identified(vectors.filter(usable(vector)), F.transform(F.col(vector), whole)), "vectors")
    base = written.df
    is_query = asks(every)
    n, n_queries = base.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    n_rows, n_q = blocks_of(n, ROW_BLOCK), blocks_of(n_queries, QUERY_BLOCK)
    mixed = F.xxhash64("uid")
    rows = written.fresh().withColumns({"rb": F.pmod(mixed, F.lit(n_rows)), "qb": F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))})

    def dealt(queries):
        return queries.withColumns({"qb": F.pmod(mixed, F.lit(n_q)), "rb": F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))})

    def pairs(queries):
        return dealt(queries).groupBy("qb", "rb").cogroup(rows.groupBy("qb", "rb"))

    queries = base.filter(is_query)
    known = pairs(queries).applyInPandas(_lists_of(k), "q bigint, best array<double>")
    # The k-th best of all row blocks; each task first cuts its own scores to k for each query.
    best = Window.partitionBy("q").orderBy(F.desc("score"))
    cutoffs = known.select("q", F.explode("best").alias("score")).withColumn("_n", F.row_number().over(best)) \
        .filter(F.col("_n") <= k).groupBy("q").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("cutoff"))
    cutoffs = Written(cutoffs, "cutoffs").df
    # With fewer than k known scores, every entry is wanted.
    queries = queries.join(cutoffs, F.col("uid") == F.col("q"), "left").withColumn(
        "cutoff", F.coalesce("cutoff", F.lit(float("-inf")))).drop("q")
    found = pairs(queries).applyInPandas(_resolver(k), "q bigint, ids array<bigint>, nameless array<boolean>, scores array<bigint>")
    entries = entries_of(found)
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = entries.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = written.fresh().select(F.col("uid").alias("q"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "q").select("query_id", "rank", "vec_id", "score")
