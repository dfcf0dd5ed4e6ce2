"""N-gram Jaccard join by a prefix tree: near-duplicate links and their components.

A document's set holds its distinct five-word shingles as 64-bit hashes.  Two sets link
when ``100 * |a & b| >= 80 * |a | b|``.  Every link is found; nothing is sampled or capped.

1. *Scan.*  Equal sets fall together under a fingerprint.  Of each set the smallest
   hashes are listed: with ``d = n - ceil(0.8 n)`` tolerated misses and ``k`` wanted hits,
   two linked sets have ``k`` common n-grams among their ``d + k`` smallest.  Sets with
   fewer than ``k`` listed n-grams known from another set link with nothing.  Sets with
   ``k`` hot n-grams stay without being counted, and list the others for their partners.
2. *Global order.*  The few remaining texts are read again; n-grams are ordered by their
   document frequency, rarest first, then by hash.  Sets with fewer than ``ceil(0.8 n)``
   n-grams known elsewhere drop out.
3. *Cells.*  The first ``d + 1`` n-grams tie sets into clusters (any link lies inside
   one).  A cluster is joined in one task, or, beyond ``CELL_NGRAMS``, block by block.
4. *Prefix tree.*  A cell stores its ordered sets in a path-compressed trie and walks
   it for every set: overlaps are counted once for all sets below a node, and a
   subtree is left when the remaining lengths cannot reach the threshold.

N-grams found often in a bounded sample (``SAMPLE_DOCS``) count as known and very frequent
without being shuffled, so no hot n-gram meets in one task.  This changes the work, never
the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import Written, small_or_shuffled

WORDS = 5
# A link needs 100 * common >= PERCENT * union.
PERCENT = 80
# N-grams of a cell's block: 16 MB of hashes.
CELL_NGRAMS = 2_000_000
# Documents looked at for hot n-grams, and the part of them that makes one hot.
SAMPLE_DOCS = 20_000
HOT_SHARE = 0.001
# Bytes hashed at a time.
PIECE = 2_000_000

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in UTF-8 bytes, A-Z lowered, and the byte each starts at."""
    inside = np.flatnonzero(~_SPACE[data])
    if not len(inside):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    lengths = np.diff(first, append=len(inside))
    powers = np.cumprod(np.full(lengths.max(), _STEP))
    place = np.arange(len(inside)) - np.repeat(first, lengths)
    return _mixed(np.add.reduceat(_BYTE[data[inside]] * powers[place], first)), inside[first]


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """Cut at a space near every ``PIECE`` bytes."""
    begin = 0
    while begin < len(data):
        end = min(begin + PIECE, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[begin:end]
        begin = end


def _sets_of_words(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's word hashes."""
    if not len(words):
        return np.empty(0, np.int64)
    n = max(len(words) - WORDS + 1, 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(words))):
        total += words[k:k + n] * _PLACE[k]
    return np.unique(_mixed(total + np.uint64(min(len(words), WORDS))).view(np.int64))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The n-gram set of every text of an Arrow column; null texts give an empty set."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:][:len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
        if to == at + 1:
            parts = [_word_hashes(x)[0] for x in _pieces(data[offsets[at]:offsets[to]])]
            yield _sets_of_words(np.concatenate(parts) if parts else np.empty(0, np.uint64))
        else:
            # A space after each text keeps its last word from the next one's first.
            own = np.insert(data[offsets[at]:offsets[to]], offsets[at + 1:to] - offsets[at], 32)
            words, starts = _word_hashes(own)
            ends = offsets[at + 1:to + 1] - offsets[at] + np.arange(1, to - at + 1)
            cuts = [0, *np.searchsorted(starts, ends)]
            for a, b in zip(cuts, cuts[1:]):
                yield _sets_of_words(words[a:b])
        at = to


def _misses(n: int) -> int:
    """Members of a set of ``n`` that a linked set may lack."""
    return n - -(-n * PERCENT // 100)


def _wanted(n: int) -> int:
    return 1 + n // 20


def _fingerprint(ngrams: np.ndarray) -> int:
    h = xxhash.xxh3_64_intdigest(ngrams.tobytes())
    return h - 2**64 if h >= 2**63 else h


def _in_sorted(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _lists(arrays: list) -> pa.Array:
    return pa.array(arrays, pa.list_(pa.int64()))


def _scan(hot: np.ndarray):
    def run(batches):
        seen = set()
        for batch in batches:
            ids, fps, sizes, needs, lists = batch.column(0), [], [], [], []
            for s in shingle_sets(batch.column(1)):
                n = len(s)
                fp = _fingerprint(s)
                fps.append(fp)
                sizes.append(n)
                if not n or fp in seen:
                    needs.append(None)
                    lists.append(None)
                    continue
                seen.add(fp)
                listed = s[:min(n, _misses(n) + _wanted(n))]
                known = _in_sorted(listed, hot)
                # The partner may be smaller, and its list shorter.
                needs.append(_wanted(-(-n * PERCENT // 100)) - int(known.sum()))
                # Listed whatever the need: a partner without hot n-grams counts on them.
                lists.append(listed[~known])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(fps, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(needs, pa.int64()), _lists(lists)],
                ["doc_id", "fp", "n", "need", "listed"])
    return run


def _full(hot: np.ndarray):
    def run(batches):
        seen = set()
        for batch in batches:
            rows = []
            for s in shingle_sets(batch.column(0)):
                fp = _fingerprint(s)
                if len(s) and fp not in seen:
                    seen.add(fp)
                    known = _in_sorted(s, hot)
                    rows.append((fp, len(s), s[~known], s[known]))
            if rows:
                fps, sizes, cold, warm = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps, pa.int64()), pa.array(sizes, pa.int64()), _lists(cold),
                     _lists(warm)], ["fp", "n", "ngrams", "hot"])
    return run


def _sets_only(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [_lists(list(shingle_sets(batch.column(0))))], ["ngrams"])


def hot_ngrams(docs: DataFrame) -> np.ndarray:
    """N-grams in at least ``HOT_SHARE`` of a sample of at most some ``SAMPLE_DOCS`` texts.

    At most (mean set size / HOT_SHARE) of them exist, whatever the size of the table.
    """
    total = docs.count()
    if not total:
        return np.empty(0, np.int64)
    step = max(1, total // SAMPLE_DOCS)
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("text")
    least = max(20, math.ceil(HOT_SHARE * total / step))
    rows = (
        sample.mapInArrow(_sets_only, "ngrams array<bigint>")
        .select(F.explode("ngrams").alias("h")).groupBy("h").count()
        .filter(F.col("count") >= least).select("h").toPandas()
    )
    return np.sort(rows["h"].to_numpy(np.int64))


class _Trie:
    """Path-compressed trie over sorted integer sequences, nodes in breadth-first order."""

    def __init__(self, seqs: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(seqs)), key=lambda i: seqs[i].astype(">i4").tobytes())
        seqs = [seqs[i] for i in order]
        self.order, self.sizes = np.array(order), sizes[order]
        common = np.zeros(len(seqs), np.int64)
        for i in range(1, len(seqs)):
            k = min(len(seqs[i - 1]), len(seqs[i]))
            same = seqs[i - 1][:k] == seqs[i][:k]
            common[i] = k if same.all() else int(np.argmin(same))
        lengths = np.array([len(s) for s in seqs])
        queue, pool, nodes = [(0, len(seqs), 0)], [], []
        at = filled = 0
        while at < len(queue):
            low, high, depth = queue[at]
            at += 1
            end = int(lengths[low]) if high - low == 1 else int(common[low + 1:high].min())
            pool.append(seqs[low][depth:end])
            own = low + int(np.searchsorted(lengths[low:high] > end, True)) \
                if lengths[low] == end else low
            first = len(queue)
            if own < high:
                cuts = own + 1 + np.flatnonzero(common[own + 1:high] == end)
                edges = [own, *cuts.tolist(), high]
                queue.extend((a, b, end) for a, b in zip(edges, edges[1:]))
            nodes.append((filled, end - depth, low, own, first, len(queue),
                          self.sizes[low:high].min(), self.sizes[low:high].max(),
                          int(lengths[low:high].max()) - end,
                          int(seqs[low][end - 1]) if end else -1))
            filled += end - depth
        self.pool = np.concatenate(pool) if pool else np.empty(0, np.int64)
        (self.start, self.length, self.low, self.own, self.first, self.last,
         self.least, self.most, self.rest, self.tail) = np.array(nodes).T

    def linked(self, seq: np.ndarray, size: int, member: np.ndarray) -> np.ndarray:
        """Sets linked with ``seq``; ``member`` is a scratch array of flags."""
        member[seq] = True
        nodes, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(nodes):
            length = self.length[nodes]
            ends = np.cumsum(length)
            at = np.repeat(self.start[nodes] - ends + length, length) + np.arange(ends[-1])
            hits = np.concatenate([[0], np.cumsum(member[self.pool[at]])])
            overlap = overlap + hits[ends] - hits[ends - length]
            left = len(seq) - np.searchsorted(seq, self.tail[nodes], "right")
            best = overlap + np.minimum(left, self.rest[nodes])
            least, most = self.least[nodes], self.most[nodes]
            keep = ((100 + PERCENT) * best >= PERCENT * (size + least)) \
                & (100 * most >= PERCENT * size) & (PERCENT * least <= 100 * size)
            nodes, overlap = nodes[keep], overlap[keep]
            ends_here = self.own[nodes] - self.low[nodes]
            if ends_here.any():
                count = np.cumsum(ends_here)
                sets = np.repeat(self.low[nodes] - count + ends_here, ends_here) \
                    + np.arange(count[-1])
                o = np.repeat(overlap, ends_here)
                found.append(sets[(100 + PERCENT) * o >= PERCENT * (size + self.sizes[sets])])
            below = self.last[nodes] - self.first[nodes]
            count = np.cumsum(below)
            if not len(nodes) or not count[-1]:
                break
            overlap = np.repeat(overlap, below)
            nodes = np.repeat(self.first[nodes] - count + below, below) + np.arange(count[-1])
        member[seq] = False
        return self.order[np.concatenate(found)] if found else np.empty(0, np.int64)


_CELL = "fp bigint, leader bigint, linked bigint"


def _join_cell(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Links of one cell: each linked set with its smallest partner so far, and its links."""
    _, i, j = key
    rows = rows.drop_duplicates(["fp", "block"]).reset_index(drop=True)
    # Local numbers in the global order: rarest first.
    pairs = np.concatenate([
        np.stack([np.asarray(f), np.asarray(h)], 1)
        for f, h in zip(rows["freqs"], rows["ngrams"])])
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    fresh = np.any(np.diff(pairs[order], axis=0, prepend=pairs[order][:1] - 1) != 0, axis=1)
    rank = np.empty(len(pairs), np.int64)
    rank[order] = np.cumsum(fresh) - 1
    cuts = np.cumsum([len(x) for x in rows["ngrams"]])[:-1]
    seqs = [np.sort(x) for x in np.split(rank, cuts)]
    sizes, copies = rows["n"].to_numpy(), rows["copies"].to_numpy()
    fps, block = rows["fp"].to_numpy(), rows["block"].to_numpy()
    right = np.flatnonzero(block == j)
    left = np.flatnonzero(block == i)
    if not len(left) or not len(right):
        return pd.DataFrame({"fp": [], "leader": [], "linked": []}).astype("int64")
    trie = _Trie([seqs[x] for x in right], sizes[right])
    member = np.zeros(int(fresh.sum()) + 1, bool)
    parent = np.arange(len(rows))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    linked = np.zeros(len(rows), np.int64)
    for x in left:
        near = right[trie.linked(seqs[x], sizes[x], member)]
        near = near[near != x]
        linked[x] += copies[near].sum()
        if i != j:
            linked[near] += copies[x]
        for y in near:
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b, key=lambda z: fps[z])] = min(a, b, key=lambda z: fps[z])
    some = np.flatnonzero(linked)
    return pd.DataFrame({"fp": fps[some], "leader": fps[[root(x) for x in some]],
                         "linked": linked[some]})


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node of every component, as (node, root), by large and small stars.

    Every round keeps connectivity and shortens paths, so a component of any shape takes
    about log(size) rounds.  Each round is written to the shared folder.  Nodes with
    a huge number of neighbours are merged inside the tasks first.
    """
    now = Written(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                  .filter("a <> b").distinct(), "edges")
    state = None
    while True:
        both = now.df.union(now.df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .filter("a <> b").union(small).distinct()
        after = Written(stars.toDF("a", "b"), "edges")
        now.drop()
        now = after
        found = now.df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if found == state:
            return now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Component and number of links of every document.

    Returns one row per row of ``docs``: the id, ``n_shingles``, ``component_id`` (smallest
    id reachable by links, itself included) and ``n_links`` (linked documents, copies
    included).  Null and empty texts have no shingles and link with nothing.  Rows with a
    null id take part; their component has the smallest non-null id in it, or null.
    Repeated rows are copies of each other.  Other columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    hot = hot_ngrams(docs)
    scan = Written(docs.mapInArrow(
        _scan(hot), f"doc_id {id_type}, fp bigint, n bigint, need bigint, listed array<bigint>"), "scan")
    listed = scan.df.select("fp", "need", F.explode("listed").alias("h"))
    dealt = listed.repartition("h")
    known = dealt.groupBy("h").agg(F.min("fp").alias("x"), F.max("fp").alias("y")) \
        .filter("x <> y").select("h")
    hits = dealt.join(known.hint("shuffle_hash"), "h").dropDuplicates(["h", "fp"])
    alive = hits.groupBy("fp").agg(F.count(F.lit(1)).alias("hits"), F.min("need").alias("need")) \
        .filter("hits >= need").select("fp") \
        .union(scan.df.filter("need <= 0").select("fp")).distinct()
    groups = scan.df.filter("n > 0").groupBy("fp", "n").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    wanted = Written(groups.join(alive, "fp", "left_semi"), "alive")
    ids = small_or_shuffled(wanted.df.select(F.col("doc_id").alias("id")))
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")
    full = Written(texts.mapInArrow(
        _full(hot), "fp bigint, n bigint, ngrams array<bigint>, hot array<bigint>"), "sets")
    ordered = Written(_ordered(full.df, wanted.df), "ordered")
    full.drop()
    near = Written(_cells(ordered.df).groupBy("cluster", "i", "j")
                   .applyInPandas(_join_cell, _CELL), "links")
    ordered.drop()
    roots = components(near.df.select(F.col("fp").alias("a"), F.col("leader").alias("b")))
    links = near.df.groupBy("fp").agg(F.sum("linked").alias("linked"))
    sets = (
        groups.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", "n", "doc_id", "copies", F.coalesce("root", "fp").alias("root"))
        .join(links, "fp", "left")
    )
    smallest = sets.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    sets = sets.join(smallest, "root").select(
        "fp", "n", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    sets = Written(sets, "components").df
    one = scan.df.select("doc_id", "fp", "n")
    return one.filter("n > 0").join(sets, ["fp", "n"]).select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "n_links",
    ).union(one.filter("n = 0").select("doc_id", "n", "doc_id", F.lit(0).cast("bigint")))


def _ordered(full: DataFrame, wanted: DataFrame) -> DataFrame:
    """Sets whose known n-grams could suffice, in the global order (frequency, hash)."""
    rows = full.select("fp", "n", F.explode("ngrams").alias("h")).repartition("h")
    known = rows.groupBy("h").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 1")
    cold = rows.join(known.hint("shuffle_hash"), "h").select("fp", "n", "freq", "h")
    warm = full.select("fp", "n", F.lit(2**40).alias("freq"), F.explode("hot").alias("h"))
    sets = cold.union(warm).groupBy("fp", "n").agg(
        F.array_sort(F.collect_set(F.struct("freq", "h"))).alias("s")
    ).filter(f"100 * size(s) >= {PERCENT} * n")
    return sets.join(wanted.select("fp", "n", "copies"), ["fp", "n"]).select(
        "fp", "n", "copies", F.col("s.freq").alias("freqs"), F.col("s.h").alias("ngrams"))


def _cells(ordered: DataFrame) -> DataFrame:
    """Every set once for each cell of its cluster, with ``cluster``, ``i``, ``j``, ``block``."""
    # n-grams known nowhere else come first in the order and are not in the list.
    prefix = F.expr(f"cast(n - ceil(n * {PERCENT} / 100) + 1 - (n - size(ngrams)) as int)")
    listed = ordered.select("fp", F.explode(F.slice("ngrams", F.lit(1), F.greatest(prefix, F.lit(0)))).alias("h"))
    leaders = listed.groupBy("h").agg(F.min("fp").alias("lead"), F.max("fp").alias("other")) \
        .filter("lead <> other").select("h", "lead")
    edges = listed.join(leaders, "h").select(F.col("fp").alias("a"), F.col("lead").alias("b"))
    roots = components(edges)
    # A root has no row of its own among the pairs (node, root).
    clusters = roots.union(roots.select("root", "root").distinct())
    members = ordered.join(clusters, F.col("fp") == F.col("node")).drop("node")
    blocks = members.groupBy("root").agg(
        F.ceil(F.sum(F.size("ngrams") + 8) / CELL_NGRAMS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    return (
        members.join(blocks, "root").withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(F.col("root").alias("cluster"), F.least("block", "other").alias("i"),
                F.greatest("block", "other").alias("j"), "block", "fp", "n", "copies", "freqs", "ngrams")
    )
