"""Time stamps and day keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only time-stamp form on the queue.
STAMP = "yyyy-MM-dd'T'HH:mm:ss'.000Z'"


def parse_stamp(text: Column) -> Column:
    """Time stamp, or null for any other form (routed to quarantine by callers)."""
    return F.try_to_timestamp(text, F.lit(STAMP))


def format_stamp(moment: Column) -> Column:
    return F.date_format(moment, STAMP)


def now_stamp() -> Column:
    return format_stamp(F.current_timestamp())


def day_key(moment: Column) -> Column:
    """Unpadded year+month+day.  Ambiguous (2022111); kept beside a real date."""
    return F.concat(*[part(moment).cast("string") for part in (F.year, F.month, F.dayofmonth)])
