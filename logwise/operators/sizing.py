"""Size checks that guard every broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dictionary is broadcast only below both limits; above them the join
# shuffles on the word after the other side has been aggregated.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes


def measure(df: DataFrame, column: str = "word") -> Size:
    """Exact row count and UTF-8 bytes of one string column.

    One distributed aggregate (a partial count per task, one row each to the
    final step); nothing but two numbers reaches the driver.
    """
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0)).alias("bytes"),
    ).first()
    return Size(int(row["rows"]), int(row["bytes"]))


def broadcast_if_small(
    df: DataFrame,
    column: str = "word",
    size: Size | None = None,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when the measured size fits, else ``(df, False)``."""
    s = size if size is not None else measure(df, column)
    if s.fits(max_rows, max_bytes):
        return F.broadcast(df), True
    return df, False
