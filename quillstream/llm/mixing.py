"""Mixing sources to target weights by capped water-filling.

Every source has a weight and as many words as its documents together.  The targets share
the total by weight, but no source is repeated more than ``MAX_EPOCHS`` times: sources above
that are clamped and their excess is shared by the others in proportion, until none is above.
Clamping in order of cap / weight reaches that fixed point: with all sources before it
clamped, the level ``(total - clamped caps) / remaining weight`` either stays below the
next ratio, and is the final one, or the next source is clamped as well.

A source's target is met by whole repetitions of all its documents and a seeded sample for
the fraction: documents in the order of a seeded digest of id and text, up to the wanted
words.  The digest's first digits form buckets whose sums are known from one aggregation, so
only the one bucket in which a source's sample ends is put in order, and there one row stands
for all rows with the same digest.  If the sample ends among such rows, as many of them are
taken as are wanted, numbered in parts with offsets, so no task sees them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.common import Written, set_aside, small_or_shuffled, word_count

MAX_EPOCHS = 3
SEED = "mix-1"
# Hexadecimal digits of the digest that name a bucket: 65,536 buckets for each source, searched
# in two steps of 256.
BUCKET_DIGITS = 4


def source_weights(sources: DataFrame) -> DataFrame:
    """``sources`` (one row each) with ``weight``: 1, 2, 3 repeating by code point, null last.

    Ranks are counted within range partitions and offset by the sizes of those before, so
    no task sees all sources.
    """
    order = F.col("source").asc_nulls_last()
    parts = sources.repartitionByRange(order).withColumn("_part", F.spark_partition_id())
    parts = Written(parts, "sources").df
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each partition, not for each source.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_part").orderBy(order)
    return parts.join(F.broadcast(sizes), "_part").select(
        *sources.columns,
        ((F.row_number().over(own) + F.col("_before") - 1) % 3 + 1).cast("bigint").alias("weight"))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``; their targets sum to the sizes.

    Each round clamps all sources above the level and computes the next level from two
    sums; rounds end when nothing new is clamped.  Only those sums reach the driver.
    """
    sources = Written(sources, "weights").df
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    clamped, level = None, None
    while True:
        above = F.lit(False) if level is None else cap < F.col("weight") * F.lit(level)
        row = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count_if(above)).first()
        if row[2] == clamped or not row[1]:
            break
        clamped, level = row[2], (total - row[0]) / row[1]
    share = F.col("weight") * F.lit(level or 0.0)
    return sources.withColumn("target", F.least(cap.cast("double"), share))


def digest(doc_id: str | Column = "doc_id", text: str | Column = "text", seed: str = SEED) -> Column:
    """The place of a row in the sample: rows equal in id and text share it."""
    id_, body = (F.col(c) if isinstance(c, str) else c for c in (doc_id, text))
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(F.md5(body.cast("binary")), F.lit(""))).cast("binary"))


def _end(sums: DataFrame, targets: DataFrame) -> DataFrame:
    """(_s, _end, _below): the bucket in which each source's sample ends, and the words of those
    before it.  Buckets are found by half their digits first, then by all, so a source has at
    most 256 rows to add up in each step."""
    found = targets.select(F.col("source").alias("_s"), "_need", F.lit("").alias("_end"), F.lit(0).cast("bigint").alias("_below"))
    for digits in (BUCKET_DIGITS // 2, BUCKET_DIGITS):
        within = sums.join(small_or_shuffled(Written(found, "ends").df), F.col("source").eqNullSafe(F.col("_s"))
                           & F.startswith(F.col("_bucket"), F.col("_end")))
        steps = within.groupBy("_s", "_need", "_below", F.substring("_bucket", 1, digits).alias("_b")).agg(F.sum("_sum").alias("_n"))
        upto = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        filled = steps.withColumn("_upto", F.col("_below") + F.sum("_n").over(upto))
        found = filled.filter("_upto > _need").groupBy("_s", "_need").agg(
            F.min_by(F.struct("_b", (F.col("_upto") - F.col("_n")).alias("_under")), "_b").alias("_first")).select(
            "_s", "_need", F.col("_first._b").alias("_end"), F.col("_first._under").alias("_below"))
    return found.drop("_need")


def _plan(rows: DataFrame, max_epochs: int) -> tuple[DataFrame, DataFrame]:
    """Per source: target, whole repetitions and where its sample ends; and for that last
    bucket how many (``_k``) of the ``_m`` rows of each (source, key, size) are taken."""
    rows = Written(rows.select("source", "_key", "_size"), "sizes").df
    bucket = F.substring("_key", 1, BUCKET_DIGITS)
    sums = Written(rows.groupBy("source", bucket.alias("_bucket")).agg(F.sum("_size").alias("_sum")), "sums").df
    sources = sums.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    targets = water_fill(source_weights(sources), max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.withColumn("_whole", whole.cast("bigint")) \
        .withColumn("_need", F.col("target") - F.col("_whole") * F.col("source_size"))
    targets = Written(targets, "targets").df
    last = _end(sums, targets)
    plan = Written(targets.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_s"), "source_size", "target", "_whole", "_need", "_end", "_below"), "plan").df
    at_end = rows.join(small_or_shuffled(plan), F.col("source").eqNullSafe(F.col("_s")) & (bucket == F.col("_end")))
    # One row for all rows with the same digest, however many they are.
    tied = at_end.groupBy("_s", "_key", "_size", "_need", "_below").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.partitionBy("_s").orderBy("_key", "_size").rowsBetween(Window.unboundedPreceding, -1)
    under = F.col("_below") + F.coalesce(F.sum(F.col("_m") * F.col("_size")).over(before), F.lit(0))
    # Nearest end: a document is in while half of it is still wanted.
    wanted = F.floor((F.col("_need") - F.col("_under")) / F.col("_size") + F.lit(0.5))
    some = F.when(F.col("_size") == 0, F.when(F.col("_under") <= F.col("_need"), F.col("_m")).otherwise(F.lit(0))) \
        .otherwise(F.greatest(F.lit(0), F.least(F.col("_m"), wanted)))
    ends = tied.withColumn("_under", under).select(
        F.col("_s").alias("_es"), F.col("_key").alias("_ek"), F.col("_size").alias("_ez"), "_m", some.cast("bigint").alias("_k"))
    return plan, Written(ends, "tied").df


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_extra``: 1 for the first ``_k`` of each source, in any fixed order of
    equal rows; counted in the parts in which they are stored, and offset by the parts before."""
    names = rows.columns
    parts = Written(rows.withColumn("_part", F.spark_partition_id()), "equal-rows")
    before = Window.partitionBy("_es").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.df.groupBy("_es", "_part").agg(F.count(F.lit(1)).alias("_n"))
    sizes = Written(sizes.select(F.col("_es").alias("_os"), F.col("_part").alias("_op"),
                                 F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")), "offsets").df
    own = Window.partitionBy("_es", "_part").orderBy(F.xxhash64(*names))
    placed = parts.fresh().join(small_or_shuffled(sizes), F.col("_es").eqNullSafe(F.col("_os")) & (F.col("_part") == F.col("_op")))
    return placed.withColumn("_extra", (F.row_number().over(own) + F.col("_offset") <= F.col("_k")).cast("bigint")) \
        .select(*names, "_extra")


def _decided(docs: DataFrame, max_epochs: int, seed: str) -> DataFrame:
    rows = docs.withColumns({"_size": word_count("text"), "_key": digest("doc_id", "text", seed)})
    plan, ends = _plan(rows, max_epochs)
    joined = rows.join(small_or_shuffled(plan), F.col("source").eqNullSafe(F.col("_s"))).join(
        small_or_shuffled(ends), F.col("source").eqNullSafe(F.col("_es")) & (F.col("_key") == F.col("_ek"))
        & (F.col("_size") == F.col("_ez")), "left")
    before_end = F.col("_end").isNull() | (F.substring("_key", 1, BUCKET_DIGITS) < F.col("_end"))
    split = (F.col("_k") > 0) & (F.col("_k") < F.col("_m"))
    decided = joined.withColumn("_extra", F.coalesce(F.col("_k") >= F.col("_m"), before_end).cast("bigint"))
    if not ends.filter(split).isEmpty():
        # At most one digest of each source has rows on both sides of the end.
        undecided = F.coalesce(split, F.lit(False))
        decided = decided.filter(~undecided).unionByName(_numbered(joined.filter(undecided)))
    times = F.least(F.col("_whole") + F.col("_extra"), F.lit(max_epochs).cast("bigint"))
    return decided.withColumn("_times", times)


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, times) for every row of ``docs``.

    ``times`` is how often the mix holds the document: the whole repetitions of its source,
    plus one if it is in the sample; ``taken`` counts its words so often.  A source's
    taken words differ from its target by at most one document.  Null texts and texts
    without words have size 0; a null source is a source of its own.  Rows with null or
    repeated ids are told apart by their texts; of rows equal in both, as many are taken as
    are wanted, and since they are equal, reruns agree, however rows are laid out.  An empty
    table gives no rows.
    """
    return _decided(docs.select("doc_id", "source", "text"), max_epochs, seed).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        (F.col("_size") * F.col("_times")).alias("taken"), F.col("_times").alias("times"))


def mixed(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``.

    Texts are not shuffled: plan and last bucket are joined to them.
    """
    copies = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    apart, back = set_aside(docs, "doc_id", "source", "text")
    return _decided(apart, max_epochs, seed).filter("_times > 0").withColumn("_copy", copies).select(*back)
