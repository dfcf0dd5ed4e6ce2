"""Source divergence audit with hash-consed segment trees over term ids.

Within a language every source is a group of term counts.  The kept terms of a language are
dealt into segments; in a segment the terms are numbered by falling frequency, and a group's
counts become a segment tree over these numbers: a leaf for each count, and one node for each
pair of children.  Nodes are hash-consed, so equal subtrees, of one group or of several, are
one node; long stretches of terms that a source never uses cost one node a level.  Two trees
are walked from their roots together; equal node pairs met on a level are merged and carry how
often they were met, so each distinct pair of leaf counts is priced once.

A task holds one segment of at most ``GROUPS`` by ``GROUPS`` sources, and segments hold some
``TERMS`` terms, so no task grows with the corpus; prices of segments are summed by group pair.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.common import Written, small_or_shuffled

MIN_DOCS = 10
TOP = 10
# Terms of a segment (more or less, as they fall) and sources of a group block.
TERMS = 4096
GROUPS = 32
# Counts that a task holds before it passes them on.
HELD = 400_000
ONE = 1_000_000_000
# Bytes that separate terms become spaces, A-Z become a-z; all of UTF-8 above ASCII stays.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs), one row for each group and term, and one row with a
    null term for each group.  Null columns count as ''."""
    def none_as_empty(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    def run(batches):
        held: dict[tuple, Counter] = {}
        size = 0

        def flush():
            nonlocal size
            lang, source, term, n, d = [], [], [], [], []
            for (a, b), (all_, once) in held.items():
                lang += [a] * (len(all_) + 1)
                source += [b] * (len(all_) + 1)
                term += [*all_, None]
                n += [*all_.values(), 0]
                d += [*map(once.__getitem__, all_), 0]
            held.clear()
            size = 0
            step = 50_000
            for at in range(0, len(n), step):
                cut = slice(at, at + step)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array(lang[cut], pa.string()), "source": pa.array(source[cut], pa.string()),
                    "term": pa.array(term[cut], pa.binary()).cast(pa.string()), "n": pa.array(n[cut], pa.int64()),
                    "n_docs": pa.array(d[cut], pa.int64())})

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                own = held.get((lang, source))
                if own is None:
                    own = held[lang, source] = (Counter(), Counter())
                    size += 1
                words = terms_of(raw.as_py())
                before = len(own[0])
                own[0].update(words)
                own[1].update(set(words))
                size += len(own[0]) - before
                if size > HELD:
                    yield from flush()
        yield from flush()

    rows = docs.select(none_as_empty("lang"), none_as_empty("source"), none_as_empty("text"))
    parts = rows.mapInArrow(run, "lang string, source string, term string, n bigint, n_docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


class SegmentTrees:
    """Hash-consed segment trees of the rows of ``counts`` (groups x terms)."""

    def __init__(self, counts: np.ndarray):
        groups, terms = counts.shape
        width = 1 << max(0, terms - 1).bit_length()
        # Leaf 0 stands for no term: it fills the width up to a power of two and costs nothing.
        self.values, leaves = np.unique(counts, return_inverse=True)
        self.leaves = leaves.reshape(counts.shape) + 1
        row = np.zeros((groups, width), np.int64)
        row[:, :terms] = self.leaves
        self.children: list[np.ndarray] = []
        while row.shape[1] > 1:
            pairs = (row[:, 0::2] << 32) | row[:, 1::2]
            nodes, own = np.unique(pairs, return_inverse=True)
            self.children.append(np.stack([nodes >> 32, nodes & 0xFFFFFFFF], axis=1))
            row = own.reshape(pairs.shape)
        self.roots = row[:, 0]

    def leaf_pairs(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of leaves of two groups, as places in ``values``, and how often each
        occurs at one term."""
        pairs, times = np.array([(self.roots[a] << 32) | self.roots[b]]), np.ones(1, np.int64)
        for children in reversed(self.children):
            left, right = children[pairs >> 32], children[pairs & 0xFFFFFFFF]
            below = ((left << 32) | right).T.ravel()
            pairs, place = np.unique(below, return_inverse=True)
            times = np.bincount(place, np.tile(times, 2)).astype(np.int64)
        real = pairs >> 32 > 0
        return (pairs[real] >> 32) - 1, (pairs[real] & 0xFFFFFFFF) - 1, times[real]


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``1 + floor(10**9 * (count + 2) / (total + 2 * kept))``, in whole numbers of any size."""
    if not len(counts) or counts.max() < (1 << 63) // ONE - 2:
        return 1 + ONE * (counts + 2) // (total + 2 * kept)
    return np.array([1 + ONE * (int(c) + 2) // (total + 2 * kept) for c in counts], np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    # Shares are at most 10**9 + 1, so squares fit 63 bits.
    return (p - q) ** 2 // (p + q)


def _audit_cell(rows: pd.DataFrame, block_size: int) -> pd.DataFrame:
    """Prices of one segment: pairs of groups, and the best terms of each group.

    ``rows`` hold (gid, tid, n): gid -1 is the language itself with all terms; tid -1 gives
    a group's total in ``n``.
    """
    out = []
    first, second, v = (int(rows[c].iat[0]) for c in ("gi", "gj", "v"))
    head = rows["tid"] < 0
    totals = dict(zip(rows["gid"][head], rows["n"][head]))
    groups = sorted(g for g in totals if g >= 0)
    body = rows[~head]
    terms = int(body["tid"].max()) + 1
    counts = np.zeros((len(groups) + 1, terms), np.int64)
    counts[np.searchsorted([-1, *groups], body["gid"]), body["tid"]] = body["n"]
    trees = SegmentTrees(counts)
    p = {g: shares(trees.values, int(totals[g]), v) for g in [-1, *groups]}
    block = [g // block_size for g in groups]
    for i, a in enumerate(groups):
        for j in range(i + 1, len(groups)):
            if (block[i], block[j]) == (first, second):
                x, y, times = trees.leaf_pairs(i + 1, j + 1)
                out.append(("pair", a, groups[j], int((price(p[a][x], p[groups[j]][y]) * times).sum())))
        if first != second:
            continue
        # The group against its language: each distinct pair of leaves is priced once.
        own, lang = trees.leaves[i + 1] - 1, trees.leaves[0] - 1
        pairs, place = np.unique(own * (len(trees.values) + 1) + lang, return_inverse=True)
        x, y = pairs // (len(trees.values) + 1), pairs % (len(trees.values) + 1)
        above = (trees.values[x] > 0) & (p[a][x] > p[-1][y])
        value = np.where(above, price(p[a][x], p[-1][y]), -1)[place]
        over = np.flatnonzero(value >= 0)
        if len(over) > TOP:
            # All that tie with the last place go on; terms settle the ties.
            over = over[value[over] >= np.partition(value[over], -TOP)[-TOP]]
        out += [("term", a, int(t), int(value[t])) for t in over]
    return pd.DataFrame(out, columns=["part", "a", "b", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of every language.

    Part ``pair`` compares a source with each other source of its language, part ``term``
    names up to ``TOP`` terms that stand out against the language.  Null columns count as ''; a
    document is a row, also where ids or texts are repeated.  A group without terms is
    compared like any other; a language without kept terms gives pairs of value 0; a language
    of one source gives no pairs.  An empty table gives no rows.  Counts may be of any size.
    """
    counts = Written(term_counts(docs), "term-counts").df
    kept = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")).filter(F.col("n_docs") >= min_docs)
    kept = Written(kept.select("lang", "term", "n"), "kept-terms").df
    langs = Written(kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("v")), "langs").df
    # Terms numbered within their segment, frequent ones first.
    segments = F.ceil(F.col("v") / TERMS).cast("bigint")
    dealt = kept.join(small_or_shuffled(langs), "lang").withColumn("seg", F.pmod(F.xxhash64("term"), segments))
    order = Window.partitionBy("lang", "seg").orderBy(F.desc("n"), "term")
    terms = Written(dealt.select("lang", "term", "seg", "n", "v", "lang_n", (F.row_number().over(order) - 1).alias("tid")), "terms")
    own = counts.filter("term IS NOT NULL").select("lang", "source", "term", "n").join(
        small_or_shuffled(terms.df.select("lang", "term", "seg", "tid")), ["lang", "term"])
    own = Written(own, "group-terms").df
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # Sources of a language, numbered in their order: one narrow row for each.
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = counts.filter("term IS NULL").select("lang", "source").join(sums, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), (F.row_number().over(numbered) - 1).alias("gid"))
    groups = Written(groups, "groups")
    n_groups = groups.fresh().groupBy("lang").agg(F.max("gid").alias("last"))
    per_lang = Written(langs.join(n_groups, "lang").withColumn("blocks", (F.col("last") / GROUPS).cast("int") + 1), "blocks").df
    small = small_or_shuffled(per_lang)

    def cells(rows: DataFrame) -> DataFrame:
        """Each row in every cell of its group's block: (block, x) and (x, block) with gi <= gj."""
        own_block = (F.col("gid") / GROUPS).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_x")
        dealt = rows.select("*", own_block.alias("_own")).select("*", others)
        return dealt.select("lang", "seg", F.least("_own", "_x").alias("gi"), F.greatest("_own", "_x").alias("gj"), "gid", "tid", "n", "v")

    body = own.join(small_or_shuffled(groups.fresh().select("lang", "source", "gid")), ["lang", "source"]).join(small, "lang")
    segs = Written(terms.fresh().select("lang", "seg").distinct(), "segments").df
    heads = groups.fresh().join(small, "lang").join(small_or_shuffled(segs), "lang").withColumns({
        "tid": F.lit(-1), "n": F.col("total")})
    pairs_of_blocks = small.select("lang", "v", "lang_n", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("gi"), "blocks") \
        .select("lang", "v", "lang_n", "gi", F.explode(F.sequence(F.col("gi"), F.col("blocks") - 1)).alias("gj"))
    pairs_of_blocks = small_or_shuffled(Written(pairs_of_blocks, "cells").df)
    whole = terms.fresh().select("lang", "seg", "tid", "n").join(pairs_of_blocks, "lang")
    whole_head = segs.join(pairs_of_blocks, "lang").select(
        "lang", "seg", "gi", "gj", F.lit(-1).alias("gid"), F.lit(-1).alias("tid"), F.col("lang_n").alias("n"), "v")
    whole = whole.select("lang", "seg", "gi", "gj", F.lit(-1).alias("gid"), "tid", "n", "v").unionByName(whole_head)
    cell_rows = cells(body).unionByName(cells(heads)).unionByName(whole)
    block_size = GROUPS
    priced = cell_rows.groupBy("lang", "seg", "gi", "gj").applyInPandas(
        lambda key, rows: _audit_cell(rows, block_size).assign(lang=key[0], seg=key[1]),
        "part string, a int, b int, value bigint, lang string, seg bigint")
    priced = Written(priced, "prices").df
    names = small_or_shuffled(groups.fresh().select("lang", "gid", "source"))
    first, second = (names.select("lang", F.col("gid").alias(c), F.col("source").alias(f"{c}_source")) for c in "ab")

    # Sources of a language without kept terms have pairs as well, all of value 0.
    bare = groups.fresh().join(small_or_shuffled(langs.select("lang")), "lang", "left_anti")
    bare = bare.select("lang", "source", "gid")
    zero = bare.join(bare.select("lang", F.col("source").alias("item"), F.col("gid").alias("_g")), "lang").filter("gid <> _g") \
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("bigint").alias("value"))
    sums = priced.filter("part = 'pair'").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sums = Written(sums.join(first, ["lang", "a"]).join(second, ["lang", "b"]), "pairs").df
    both = sums.select("lang", F.explode(F.array(
        F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")),
        F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")))).alias("x"), "value").select(
        "lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    found = priced.filter("part = 'term'").withColumnRenamed("b", "tid").join(first, ["lang", "a"]).join(
        terms.fresh().select("lang", "seg", "tid", "term"), ["lang", "seg", "tid"]).select(
        "lang", F.col("a_source").alias("source"), F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = both.unionByName(zero).withColumn("rank", F.row_number().over(by_value))
    best = found.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= TOP)
    return ranked.unionByName(best)
