"""Shared pieces of the operators: written tables, word bytes, held-out rows."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.scratch import scratch_dir

# The six bytes that separate words: tab to carriage return, and space.
SPACES = r"[\x20\x09-\x0D]+"
# Rows and bytes that may be broadcast: with some 40 bytes a row for the hashed relation at most
# 100 MB in every executor, whatever the columns hold.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 60 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Written:
    """A table in the shared scratch folder: computed once, safe from lost executors."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = scratch_dir(self.spark, name)
        self.schema = df.schema
        df.write.parquet(self.path)
        self.df = self.fresh()

    def fresh(self) -> DataFrame:
        """The table with column identities of its own, for joins with itself."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files.  Only for tables that no later plan reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _bytes_of(column: Column, kind: T.DataType) -> Column:
    """Bytes of one value, nested ones included; fixed widths count as 8."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column) + 16
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)):
            size = F.aggregate(column, F.lit(24), lambda sum_, x: sum_ + _bytes_of(x, kind.elementType))
        else:
            size = F.size(column) * 8 + 24
    elif isinstance(kind, T.MapType):
        size = _bytes_of(F.map_keys(column), T.ArrayType(kind.keyType)) \
            + _bytes_of(F.map_values(column), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.StructType):
        size = sum((_bytes_of(column[f.name], f.dataType) for f in kind.fields), F.lit(16))
    else:
        return F.lit(8)
    return F.coalesce(size, F.lit(8))


def small_or_shuffled(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` (a written table) if its counted rows and their summed bytes are few."""
    size = sum((_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0))
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS and total <= MAX_BROADCAST_BYTES else df


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but the used ones under names that clash with nothing, and
    the columns that give the old names and order back."""
    names = [c if c in used else f"_kept{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def ascii_lower(column: str | Column) -> Column:
    """The text with A-Z, and nothing else, in lower case.  ``lower`` is the faster way, and the
    same one where all characters are ASCII."""
    text = F.col(column) if isinstance(column, str) else column
    upper = string.ascii_uppercase
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def word_count(text: str | Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACES), lambda w: w != "")), F.lit(0)) \
        .cast("bigint")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))
