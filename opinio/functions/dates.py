"""Date/time column builders (D1-D4, D7). Session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts used by the source files and partitions.
SLASH_DATE = "M/d/yyyy"
MIDNIGHT_TEXT = "yyyy-MM-dd 00:00:00"
PARTITION_ID = "yyyyMMdd"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_slash_date(c) -> Column:
    """``M/d/yyyy`` (one- or two-digit month/day) -> timestamp at midnight;
    null where the text is no such date."""
    return F.try_to_timestamp(_col(c), F.lit(SLASH_DATE))


def to_epoch_seconds(ts) -> Column:
    """Timestamp -> epoch seconds (bigint) under the session zone."""
    return F.unix_timestamp(_col(ts))


def epoch_to_midnight_text(epoch) -> Column:
    """D3: epoch seconds -> ``yyyy-MM-dd 00:00:00`` text of that UTC day."""
    return F.date_format(F.timestamp_seconds(_col(epoch)), MIDNIGHT_TEXT)


def partition_id(c) -> Column:
    """A date/timestamp as ``yyyyMMdd`` (the day-partition decorator)."""
    return F.date_format(_col(c), PARTITION_ID)


def strip_leading_newline(c) -> Column:
    """Remove one leading newline."""
    return F.regexp_replace(_col(c), r"^\n", "")
