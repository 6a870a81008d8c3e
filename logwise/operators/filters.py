"""Row filters and SQL over one batch."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the level the log sink keeps. Brackets are part of the value.
ERROR_LEVEL = "[error]"


def filter_levels(
    df: DataFrame, levels: Sequence[str] = (ERROR_LEVEL,), column: str = "log_level"
) -> DataFrame:
    """Keep rows whose level is one of ``levels`` (pushed to the scan when it can be)."""
    return df.where(F.col(column).isin(*levels))


def non_empty(df: DataFrame, column: str = "value") -> DataFrame:
    """Drop NULL and empty strings (an empty comment has no words)."""
    return df.where(F.coalesce(F.length(F.col(column)), F.lit(0)) > 0)


def sql_over_batch(df: DataFrame, query: str, view: str = "batch_rows") -> DataFrame:
    """Run ``query`` with ``view`` as the name of ``df``, for example
    ``select * from batch_rows``.

    The rows are a common table expression of that name around the query, so
    its text stays as it is: literals and columns may be called like the view.
    What the expression reads is registered under a name of its own while the
    query is analysed, then dropped: the caller's views stay as they are, and
    two threads cannot swap each other's rows. A table or view called like
    ``view`` is hidden inside the query.
    """
    own = f"_rows_{uuid.uuid4().hex}"
    named = view.replace("`", "``")
    df.createTempView(own)
    try:
        return df.sparkSession.sql(f"WITH `{named}` AS (SELECT * FROM {own}) SELECT * FROM (\n{query}\n)")
    finally:
        df.sparkSession.catalog.dropTempView(own)
