"""The mix on rows that its digest cannot tell apart, beside exact water-filling by hand."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from test_operators import docs_of

from quillstream.llm import mixing


def targets_by_hand(sizes):
    """Exact targets of sources (name to size) in code point order, null last."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: n % 3 + 1 for n, s in enumerate(order)}
    total, clamped = Fraction(sum(sizes.values())), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in clamped)
        free = sum(w for s, w in weight.items() if s not in clamped)
        share = {s: Fraction(3 * sizes[s]) if s in clamped else rest * weight[s] / free for s in sizes}
        new = {s for s in sizes if s not in clamped and share[s] > 3 * sizes[s]}
        if not new:
            return share
        clamped |= new


REPEATED = [(7, "w " * 10, "a")] * 1000 + [(i, "w " * 10, "b") for i in range(500)] + [(i, "w " * 10, "c") for i in range(1000, 1700)]
NO_IDS = [(None, "w " * (1 + i % 9), "a") for i in range(400)] + [(None, "one text", "b")] * 300 + [(None, None, "b")] * 50
MIXED = [(7, "same", None)] * 200 + [(7, f"other {i}", "x") for i in range(200)] + [(i, "w " * (i % 50), "y") for i in range(300)] + [(None, "z z z", "x")] * 100


@pytest.mark.parametrize("rows", [REPEATED, NO_IDS, MIXED])
def test_targets_are_met_whatever_the_ids(spark, rows):
    docs = docs_of(spark, rows)
    out = mixing._decided(docs.repartition(6), 3, mixing.SEED).select(
        "source", F.col("_size").alias("size"), "source_size", "target", "_times").collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    wanted = targets_by_hand(sizes)
    for source, size in sizes.items():
        own = [r for r in out if r.source == source]
        assert all(r.source_size == size and r.target == pytest.approx(float(wanted[source])) for r in own)
        assert abs(sum(r.size * r._times for r in own) - wanted[source]) <= max(r.size for r in own) / 2 + 1e-6
        # Whole repetitions for all, one more for some.
        assert max(r._times for r in own) <= min(3, min(r._times for r in own) + 1)
    again = sorted(map(str, mixing.mix(docs.coalesce(1)).collect()))
    assert again == sorted(map(str, mixing.mix(docs.repartition(11)).collect()))


def test_copies_of_equal_rows_keep_their_other_columns(spark):
    docs = docs_of(spark, REPEATED).withColumn("a.b", F.monotonically_increasing_id())
    copies = mixing.mixed(docs)
    assert copies.columns == docs.columns
    times = [r["count"] for r in copies.filter("source = 'a'").groupBy("`a.b`").count().collect()]
    taken = sum(r.taken for r in mixing.mix(docs).filter("source_size = 10000").collect()) // 10
    assert sum(times) == taken and max(times) == 1
