"""Tables of mergeable rows, stored as segments of consecutive batches.

A segment is a folder named after the first and last batch whose rows it holds.  After a batch
has been written, neighbouring segments of equal length are merged, as a binary counter
carries, so n batches lie in at most log2(n) + 1 segments and a row is rewritten at most
log2(n) times.  A merge writes a longer segment beside its parts; readers take the longest
complete segments, so they see either the parts or the merged rows, never both, and a crash
between any two steps loses and doubles nothing.  Parts are deleted one batch after their
merge, when readers that listed them before are done; a reader must not take longer than
that.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Span = tuple[int, int]


def _path(root: str, span: Span) -> str:
    return f"{root}/batches-{span[0]}-{span[1]}"


def complete(spark: SparkSession, root: str) -> list[Span]:
    """Every finished segment, in order of its first batch, longer ones first."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    spans = []
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("batches-") and fs.exists(jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")):
            _, first, last = name.split("-")
            spans.append((int(first), int(last)))
    return sorted(spans, key=lambda s: (s[0], -s[1]))


def chosen(spans: list[Span]) -> list[Span]:
    """The longest segments that cover all batches, each batch once."""
    out: list[Span] = []
    for span in spans:
        if not out or span[0] > out[-1][1]:
            out.append(span)
    return out


def read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of all batches, as merged so far."""
    paths = [_path(root, s) for s in chosen(complete(spark, root))]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def count(spark: SparkSession, root: str) -> int:
    """Number of segments that ``read`` takes."""
    return len(chosen(complete(spark, root)))


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write(rows: DataFrame, root: str, batch: int, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Store a batch, replacing an earlier attempt at it, and merge what has added up.

    ``merge`` turns the rows of two segments into those of one.
    """
    spark = rows.sparkSession
    before = complete(spark, root)
    # What an earlier batch has merged is no longer read by anyone.
    kept = chosen(before)
    for span in before:
        if span not in kept and span[1] < batch:
            _delete(spark, _path(root, span))
    rows.write.mode("overwrite").parquet(_path(root, (batch, batch)))
    while True:
        now = chosen(complete(spark, root))
        pair = now[-2:]
        # Neighbours of equal length, the first of them where a segment of both may begin.
        size = pair[-1][1] - pair[-1][0] + 1
        if len(pair) < 2 or pair[0][1] + 1 != pair[1][0] or pair[0][1] - pair[0][0] + 1 != size or pair[0][0] % (2 * size):
            return
        both = spark.read.schema(rows.schema).parquet(*[_path(root, s) for s in pair])
        merge(both).write.mode("overwrite").parquet(_path(root, (pair[0][0], pair[1][1])))
