"""Keys and samples that depend on row content only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(*parts: Column) -> Column:
    """Stable row id: a retried or redelivered row gets the same one.

    Every part is preceded by its length, and a null differs from an empty part, so
    different rows never hash the same text.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    framed = [
        F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns
    ]
    return F.sha2(F.concat(*framed), 256)


def hash_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a key in 0..buckets-1, the same under any partitioning."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % buckets
