"""Additive accumulation of counts by key ("insert, or add to the existing")."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accumulate(
    base: DataFrame,
    delta: DataFrame,
    keys: Sequence[str] = ("word", "date"),
    value: str = "count",
) -> DataFrame:
    """New totals = base + delta per key; keys of either side are kept.

    Same result as a full outer join with coalesced sums, planned as
    union + one aggregation: a single shuffle with partial sums, no sort-merge
    join, and a key hot on both sides still costs one row per map task.
    """
    cols = [*keys, value]
    both = base.select(*cols).unionByName(delta.select(*cols))
    return both.groupBy(*keys).agg(F.sum(F.col(value).cast("bigint")).alias(value))
