"""Spread CPU-heavy row work over the cluster when the scan is too narrow."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Hash-repartition on ``key`` only if ``df`` has fewer partitions than
    the cluster runs tasks at once (``defaultParallelism``).

    A large input already comes in many splits, and the call is a no-op; a
    small one (say, a single parquet row group of long texts) would otherwise
    be tokenized by one task. Hashing on a unique id keeps the partitioning
    deterministic for task retries; without a key it is round-robin.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming:
        # a stream has no partition count until a batch runs; spread inside
        # foreachBatch (each batch is a plain DataFrame) instead
        return df
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)
