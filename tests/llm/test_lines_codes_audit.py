"""Line dedup, vector codes and the divergence audit: edge cases and brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import BAD, EDGE, docs_of, vectors_of

from quillstream.llm import common, divergence, line_dedup, vector_codes

BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_by_hand(rows, least=10):
    split = [(t or "").split("\n") for _, t, *_ in rows]
    keys = [[line.strip(BLANKS).translate(UPPER) for line in lines] for lines in split]
    found = Counter(k for own in keys for k in set(own) if k)
    out = []
    for (i, *_), lines, own in zip(rows, split, keys):
        kept = [line for line, k in zip(lines, own) if found[k] < least]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def noisy_documents():
    rng = random.Random(11)
    pool = ["Shared LINE", " shared line\t", "É only", "é only", "", "  ", "x" * 5_000, "Zürich GRÜSST", "zürich grÜsst", "a\rb", "\x0bkeep\x0c"]
    rows = list(EDGE) + [(i, "\n".join(rng.choice(pool + [f"own {i} {k}" for k in range(3)]) for _ in range(rng.randrange(1, 9))), "s")
                         for i in range(100, 160)]
    # Ten documents with nothing else, a line often in few documents, ends without text, copies.
    rows += [(200 + i, "only this\nONLY THIS ", "s") for i in range(10)] + [(300, "often\n" * 50, "s"), (301, "\n\n", "s")]
    return rows + [(400, "copy of copies\nown", "s")] * 12 + [(None, "copy of copies", "s")] * 3


@pytest.mark.parametrize("rows_at_most", [1_000_000, 0])
def test_lines_equal_brute_force(spark, monkeypatch, rows_at_most):
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", rows_at_most)
    rows = noisy_documents()
    docs = docs_of(spark, rows).withColumns({"n_lines": F.lit("old"), "line": F.lit("clash"), "_at": F.lit("clash"), "a.b": F.lit(1)})
    got = line_dedup.drop_frequent_lines(docs.repartition(5))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "line", "_at", "a.b", "n_lines", "n_dropped"]
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in got.collect()) == lines_by_hand(rows)
    digests = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digest(docs).collect())
    assert digests == sorted((i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in lines_by_hand(rows))


def test_lines_of_other_columns_thresholds_and_empty_tables(spark):
    docs = docs_of(spark, EDGE).withColumnRenamed("text", "body").withColumn("text", F.lit("kept"))
    got = line_dedup.drop_frequent_lines(docs, min_docs=2, column="body")
    assert {r.text for r in got.collect()} == {"kept"}
    assert {r.body for r in got.filter("doc_id = 4").collect()} == {""}
    short = line_dedup.drop_frequent_lines(docs_of(spark, [(1, "ab\nabc", "s"), (2, "ab\nabc", "s")]), min_docs=2, min_chars=3)
    assert {r.text for r in short.collect()} == {"ab"}
    assert line_dedup.digest(docs_of(spark, [])).count() == 0


def test_many_dropped_lines_of_a_long_text_are_linear(spark):
    text = "\n".join(x for k in range(60_000) for x in ("hot", f"own {k}"))
    rows = [(1, text, "s")] + [(i, "hot", "s") for i in range(2, 12)]
    got = {r.doc_id: r for r in line_dedup.drop_frequent_lines(docs_of(spark, rows)).collect()}
    assert got[1].n_dropped == 60_000 and got[1].text == "\n".join(f"own {k}" for k in range(60_000)) and got[2].text == ""


def codes_by_hand(rows, entries=256, rounds=4):
    kept = [(i, v, c) for i, v, c in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(4, -(-max(len(v) for _, v, _ in kept) // 4) * 4)
    whole = [[int(np.floor(1024 * float(np.float32(x)))) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    size, first = width // 4, sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    parts = [[w[p * size:(p + 1) * size] for w in whole] for p in range(4)]
    books = [[parts[p][r] for r in first] for p in range(4)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for x in parts[p]:
                groups.setdefault(nearest(p, x)[1], []).append(x)
            books[p] = [[sum(c) // len(c) for c in zip(*groups[e])] if e in groups else entry for e, entry in enumerate(books[p])]
    found = [[nearest(p, parts[p][r]) for p in range(4)] for r in range(len(kept))]
    errors = [sum(d for d, _ in f) for f in found]
    per_label = Counter()
    for (_, _, label), error in zip(kept, errors):
        per_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{e:02x}" for _, e in f), error, per_label[label], digest)
                  for (i, _, label), f, error in zip(kept, found, errors))


@pytest.mark.parametrize("rows", [10, 300])
def test_codes_equal_brute_force(spark, monkeypatch, rows):
    rng = np.random.default_rng(rows)
    good = [(i, [float(np.float32(x)) for x in rng.normal(size=6)], int(rng.integers(3)) if i % 7 else None) for i in range(rows)]
    # Repeated rows and ids, a long vector, shorter ones, an empty one, ties between entries.
    good += [good[3]] * 3 + [(3, [0.5] * 6, 1), (None, [0.25] * 6, None), (9_000, [1.0], 0), (9_001, [], 0), (9_002, [-0.001] * 7, 2)]
    table = vectors_of(spark, good + BAD[:4]).withColumns({"codes": F.lit("clash"), "error": F.lit("clash")})
    wanted = codes_by_hand(good)
    for size in (4096, 7):
        monkeypatch.setattr(vector_codes, "BLOCK", size)
        got = vector_codes.digest(table.repartition(3))
        assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect()) == wanted


def test_codes_decode_to_their_entries_and_edge_tables(spark):
    # Few distinct vectors: every one has an entry of its own and comes back without error.
    table = vectors_of(spark, [(i, [i / 1024, 0.0, -1.0, 0.5], 0) for i in range(20)] * 2)
    found, books = vector_codes.compress(table)
    assert books.shape == (4, 40, 1) and found.filter("error <> 0").count() == 0
    back = vector_codes.decode(found.withColumn("a.b", F.lit(1)).withColumn("vector", F.lit("old")), books)
    assert all(list(r.vector) == [r.vec_id / 1024, 0.0, -1.0, 0.5] for r in back.collect())
    assert vector_codes.decode(found.withColumn("codes", F.lit(None).cast("array<int>")), books).filter("vector is not null").count() == 0
    assert vector_codes.digest(vectors_of(spark, BAD[:4])).count() == 0
    assert vector_codes.digest(vectors_of(spark, [])).count() == 0
    huge = vector_codes.digest(vectors_of(spark, [(1, [3e38, -3e38], 0), (2, [0.0, 0.0], 0)])).collect()
    assert len(huge) == 2 and all(r.error >= 0 for r in huge)


def audit_by_hand(rows):
    texts = [((t or ""), lang or "", source or "") for _, t, lang, source in rows]
    found = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(UPPER))) for t, lang, source in texts]
    out = []
    for lang in sorted({x[0] for x in found}):
        own = [(s, ts) for x, s, ts in found if x == lang]
        seen = Counter(t for _, ts in own for t in set(ts))
        kept = sorted(t for t in seen if seen[t] >= 10)
        sources = sorted({s for s, _ in own})
        counts = {s: Counter(t for x, ts in own if x == s for t in ts) for s in sources}
        whole = sum(counts.values(), Counter())

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: share(counts[s]) for s in sources}, share(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:10]
            out += [(lang, s, part, item.decode(), -v, n + 1) for part, found_ in (("pair", pairs), ("term", terms))
                    for n, (v, item) in enumerate(found_)]
    return sorted(out)


def audit_rows():
    rng = random.Random(13)
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["É", "é", "漢", "🎉x", "Don't", "a1b"]
    rows = [(i, " ".join(rng.choice(words[rng.randrange(4):]) for _ in range(rng.randrange(30))), rng.choice(["en", "EN", None]),
             rng.choice(["s1", "s2", "s3", "é", None])) for i in range(150)]
    # A language whose terms are all rare, one of a single source, a group without terms, copies.
    rows += [(1, "rare", "de", "x"), (2, None, "de", "y"), (3, "", "de", "z"), (4, "12 ...", "en", "numbers only"), (5, "x" * 100_000, "fr", "one")]
    return rows + [(6, "copied words copied", "en", "s1")] * 12 + [(None, "copied", "fr", "one")] * 11


@pytest.mark.parametrize("terms, groups, held", [(4096, 32, 400_000), (5, 2, 20)])
def test_audit_equals_brute_force(spark, monkeypatch, terms, groups, held):
    for name, value in (("TERMS", terms), ("GROUPS", groups), ("HELD", held)):
        monkeypatch.setattr(divergence, name, value)
    rows = audit_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumns(
        {c: F.lit("clash") for c in ("term", "n", "gid", "seg", "value")})
    got = divergence.audit(docs.repartition(4))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audit_by_hand(rows)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_equal_subtrees_are_one_node():
    counts = np.zeros((3, 1024), np.int64)
    counts[1, 512:] = counts[2, :512] = np.arange(512) % 4
    trees = divergence.SegmentTrees(counts)
    # Ten levels: the repeated stretch of four counts has one node on each level above it.
    assert sum(map(len, trees.children)) < 40
    x, y, times = trees.leaf_pairs(1, 2)
    assert times.sum() == 1024 and len(x) == 7
    assert dict(zip(zip(trees.values[x], trees.values[y]), times)) == Counter(zip(counts[1], counts[2]))
    odd = divergence.SegmentTrees(np.array([[5, 0, 7], [5, 2, 7]]))
    x, y, times = odd.leaf_pairs(0, 1)
    assert sorted(zip(odd.values[x], odd.values[y], times)) == [(0, 2, 1), (5, 5, 1), (7, 7, 1)]


def test_shares_of_counts_beyond_a_long():
    big = 10**12
    assert divergence.shares(np.array([big, 0]), 3 * big, 5).tolist() == [1 + 10**9 * (c + 2) // (3 * big + 10) for c in (big, 0)]
