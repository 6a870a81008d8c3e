"""Monthly word counts kept as a ledger of per-batch contributions.

An additive upsert ("insert, or add to the count") is not idempotent: a
replayed micro-batch would be added twice. Instead every batch writes its own
partition ``month=<yyyyMM>/batch_id=<id>`` with dynamic partition overwrite,
so writing the same batch again replaces it. Totals are a sum over the ledger
(partition pruning on ``month`` comes free).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwise.schemas import CONTRIBUTION
from logwise.sinks.fold import Ledger, fold, totals
from logwise.sinks.tables import read_batches
from logwise.sources.storage import matching_folders, remove_folder

# Fixed value: the month a count belongs to, as in the per-month table names.
MONTH_FORMAT = "yyyyMM"


def contributions(
    counts: DataFrame, batch_id: int | Column | None = None, date: str = "date"
) -> DataFrame:
    """(word, date, count) -> ledger rows with ``month`` and ``batch_id``."""
    bid = F.col("batch_id") if batch_id is None else (
        batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    )
    return counts.select(
        F.col("word"),
        F.col(date).cast("date").alias("date"),
        F.col("count").cast("bigint").alias("count"),
        F.date_format(F.col(date), MONTH_FORMAT).alias("month"),
        bid.cast("bigint").alias("batch_id"),
    )


def write_contributions(rows: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Write ledger rows; partitions already there for the same (month, batch)
    are replaced.

    With ``batch_id`` (rows of one batch) months that an earlier attempt of
    the batch wrote and this one does not touch are removed first. Rows are
    rebalanced by (month, batch), so a small batch writes one file a month and
    the adaptive planner splits a large one over tasks.
    """
    spark = rows.sparkSession
    if batch_id is not None:
        for folder in matching_folders(spark, f"{path.rstrip('/')}/month=*/batch_id={int(batch_id)}"):
            remove_folder(spark, folder)
    (
        rows.hint("rebalance", "month", "batch_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month", "batch_id")
        .parquet(path)
    )


def read_contributions(spark: SparkSession, path: str) -> DataFrame:
    """The ledger with its fixed schema (inference would make ``month`` an
    INT); no rows if nothing has been written yet."""
    return read_batches(spark, path, CONTRIBUTION)


def monthly_ledger(path: str) -> Ledger:
    """The contributions at ``path`` as an additive ledger, folded by month."""
    return Ledger(path, CONTRIBUTION, ("month", "date", "word"), "count", "month", "month")


def compact_months(
    spark: SparkSession, path: str, compacted_path: str, months: list[str] | None = None
) -> None:
    """Fold the contributions of (closed) months into totals below
    ``compacted_path``; see :mod:`logwise.sinks.fold`.

    Only months with batches that are not folded yet are rewritten. Folded
    ledger partitions may be removed afterwards
    (:func:`logwise.sinks.fold.drop_folded`); compacting again keeps what they
    held. ``months=None`` compacts every month in the ledger.
    """
    fold(spark, monthly_ledger(path), compacted_path, months)


def monthly_totals(
    spark: SparkSession, path: str, months: list[str] | None = None, compacted_path: str | None = None
) -> DataFrame:
    """``(month, date, word, count)``: the sum of all contributions per key.

    With ``compacted_path``, folded batches come from there and the ledger
    adds only the later batches of each month.
    """
    return totals(spark, monthly_ledger(path), compacted_path, months or None)
