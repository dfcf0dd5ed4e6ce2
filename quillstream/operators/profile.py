"""Table profiling: size, summaries, duplicates, nulls, class balance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from quillstream.operators.sizes import stored


def shape(df: DataFrame, name: str) -> DataFrame:
    """One row: table name, row count, column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


def shapes(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [shape(df, name) for name, df in tables.items()])


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a fixed order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min and max: one row per numeric column, one pass."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    stats = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count(name).alias("n"),
            F.avg(name).alias("mean"),
            F.stddev_samp(name).alias("stddev"),
            F.min(name).cast("double").alias("min"),
            F.max(name).cast("double").alias("max"),
        )
        for name in columns
    ]
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, least and greatest value (by code point): one row per text column, one pass."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    stats = [F.struct(F.lit(name).alias("column_name"), F.count(name).alias("n"),
                      F.min(name).alias("min"), F.max(name).alias("max")) for name in columns]
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


# Most repeated hashes that are broadcast (8 bytes each).
MAX_HASHES = 4_000_000


def _repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored 8-byte hashes (``_hash``) of key combinations seen twice, run at once."""
    return stored(
        df.groupBy(_hash(keys).alias("_hash"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select("_hash"),
        "hashes",
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their counts.

    Texts are long and mostly unique, so they are not shuffled to be counted.  A
    first pass, run at once, stores the 8-byte hashes seen twice.  When they are
    few enough to broadcast, only rows with such a hash go on; otherwise all do.
    The count by the real keys then undoes any hash collision.  Both counts
    merge a hot group inside each task.
    """
    keys = list(keys)
    repeated = _repeated(df, keys)
    rows = df.select(_hash(keys).alias("_hash"), *keys)
    if repeated.count() <= MAX_HASHES:
        rows = rows.join(F.broadcast(repeated), "_hash", "left_semi")
    return (
        rows.groupBy("_hash", *keys)
        .agg(F.count(F.lit(1)).alias("count"))
        .filter("count > 1")
        .drop("_hash")
    )


def duplicate_total(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows inside duplicate groups; 0 when there are none.

    Only the size of a group matters here, so each text is stood for by its
    256-bit digest and one pass with a narrow shuffle does.
    """
    narrow = [
        F.unhex(F.sha2(F.col(k), 256)).alias(k)
        if isinstance(df.schema[k].dataType, StringType) else F.col(k)
        for k in keys
    ]
    groups = df.select(*narrow).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.filter("n > 1").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows")
    )


def drop_duplicates(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """One row per key combination: the one with the lowest id.

    Plain ``dropDuplicates`` keeps whichever row arrives first.  As for ``duplicate_groups``,
    a first pass stores the hashes seen twice: rows without such a hash are kept where they
    lie, and only the others are shuffled, so unique texts never are.  With too many hashes to
    broadcast all rows are grouped.
    """
    keys = list(keys)
    repeated = _repeated(df, keys)
    if repeated.count() > MAX_HASHES:
        return _lowest(df, keys, id_col)
    many = F.broadcast(repeated)
    rows = df.withColumn("_hash", _hash(keys))
    alone = rows.join(many, "_hash", "left_anti").select(*df.columns)
    return alone.unionByName(_lowest(rows.join(many, "_hash", "left_semi").select(*df.columns), keys, id_col))


def _lowest(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """The row with the lowest id of each key combination.

    Copies are merged inside each task before the one shuffle, so a group of copies of any
    size reaches its reducer as one row per task.  The leading hash decides almost every
    comparison when Spark groups by sorting; the keys behind it keep the result exact.
    """
    rest = [c for c in df.columns if c not in keys and c != id_col]
    groups = df.groupBy(_hash(keys).alias("_hash"), *keys)
    if rest:
        kept = groups.agg(F.min(F.struct(id_col, *rest)).alias("_row")).select(*keys, "_row.*")
    else:
        kept = groups.agg(F.min(id_col).alias(id_col))
    return kept.select(*df.columns)


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows with every named column present."""
    return df.na.drop("any", subset=list(subset))


def class_share(df: DataFrame, label: str = "label", classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Rows and percentage of all rows per class, in one pass.

    Rows outside ``classes`` (null too) count in the total only.
    """
    total = F.count(F.lit(1))
    shares = [
        F.struct(
            F.lit(value).alias("label"),
            F.count_if(F.col(label) == value).alias("n"),
            F.when(total > 0, F.count_if(F.col(label) == value) * 100.0 / total).alias("percent"),
        )
        for value in classes
    ]
    return df.agg(F.array(*shares).alias("shares")).select(F.inline("shares"))


def of_class(df: DataFrame, value: int, label: str = "label") -> DataFrame:
    return df.filter(F.col(label) == value)
