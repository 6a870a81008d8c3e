"""Epoch values to formatted strings (session time zone, UTC by default)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_millis(ms: str | Column, pattern: str) -> Column:
    """Epoch milliseconds (BIGINT) -> string in a datetime pattern such as yyyyMM."""
    m = F.col(ms) if isinstance(ms, str) else ms
    return F.date_format(F.timestamp_millis(m), pattern)


def format_seconds(seconds: str | Column, pattern: str) -> Column:
    """Epoch seconds held as a string -> formatted string; bad input -> NULL."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.date_format(F.timestamp_seconds(s.try_cast("bigint")), pattern)


def epoch_millis(ts: str | Column) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ -> epoch milliseconds."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(t.cast("timestamp"))
